"""Access tiers: who sees clear, generalised or fully masked values."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tier names and the account groups that grant them.
FULL = "full"
PARTIAL = "partial"
NONE = "none"
FULL_GROUP = "phi_full_access"
PARTIAL_GROUP = "phi_partial_access"

TIERS = (FULL, PARTIAL, NONE)


def tier_of_groups(groups: Iterable[str]) -> str:
    """Tier granted by a set of group names; the strongest grant wins."""
    held = set(groups)
    if FULL_GROUP in held:
        return FULL
    return PARTIAL if PARTIAL_GROUP in held else NONE


def group_tiers(principal_groups: DataFrame) -> DataFrame:
    """One row (principal, tier) for every principal of (principal, group_name).

    Grants are reduced to two flags, so a principal with very many groups is
    combined on the map side before the shuffle.
    """
    grants = principal_groups.groupBy("principal").agg(
        F.coalesce(F.bool_or(F.col("group_name") == FULL_GROUP), F.lit(False)).alias("has_full"),
        F.coalesce(F.bool_or(F.col("group_name") == PARTIAL_GROUP), F.lit(False)).alias(
            "has_partial"
        ),
    )
    tier = F.when(F.col("has_full"), FULL).when(F.col("has_partial"), PARTIAL).otherwise(NONE)
    return grants.select("principal", tier.alias("tier"))


def resolve_tier(principal_groups: DataFrame, principal: str) -> str:
    """Tier of one principal, looked up once on the driver (at most one row)."""
    row = group_tiers(principal_groups.where(F.col("principal") == principal)).first()
    return row["tier"] if row else NONE


Arm = Callable[[], Column]


def pick(tier: str | Column, full: Arm, partial: Arm, none: Arm) -> Column:
    """The arm of a mask for a tier.

    A tier name selects the arm while the plan is built, so the other arms are
    not even made. A tier column keeps all three. Whatever is neither ``full``
    nor ``partial`` gets the most masked arm.
    """
    if isinstance(tier, Column):
        return F.when(tier == FULL, full()).when(tier == PARTIAL, partial()).otherwise(none())
    return {FULL: full, PARTIAL: partial}.get(tier, none)()
