"""Account groups within account groups, and the tiers they grant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.functions.tiers import FULL, FULL_GROUP, NONE, PARTIAL, PARTIAL_GROUP
from veilmark.operators.joins import spread_join
from veilmark.session import kept

MOST_ROUNDS = 100


def granting_groups(nested: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """Every group that grants a tier, itself or by a group it is in: (group_name, tier).

    ``nested`` has ``group_name`` and ``parent_group``, the group it belongs to. The granted
    groups spread to the groups within them, round by round, until a round finds
    no new one; groups that contain each other add nothing twice. A group can have
    both tiers. Rounds are as many as the longest way down; beyond ``most_rounds``
    an error is raised rather than an incomplete answer. A group that a third of the
    rows name as parent is cut into slices.
    """
    spark = nested.sparkSession
    edges = nested.where(F.col("group_name").isNotNull() & F.col("parent_group").isNotNull())
    edges = kept(edges.select("group_name", "parent_group").distinct(), "group-edges")
    granted = spark.createDataFrame(
        [(FULL_GROUP, FULL), (PARTIAL_GROUP, PARTIAL)], "group_name string, tier string"
    )
    known = newest = granted
    for _ in range(most_rounds):
        above = newest.select(F.col("group_name").alias("above"), "tier")
        inside = spread_join(edges, above, "parent_group", "above", ["group_name", "parent_group"])
        found = inside.select("group_name", "tier").distinct()
        newest = kept(found.join(known, ["group_name", "tier"], "left_anti"), "group-round")
        if newest.isEmpty():
            return known
        known = kept(known.unionByName(newest), "group-known")
    raise RuntimeError(f"groups are nested more than {most_rounds} deep")


def nested_group_tiers(
    memberships: DataFrame, nested: DataFrame, most_rounds: int = MOST_ROUNDS
) -> DataFrame:
    """One row (principal, tier) for every principal of (principal, group_name).

    As `group_tiers`, but a membership counts for every group its group is in.
    """
    tiers = granting_groups(nested, most_rounds).groupBy(F.col("group_name").alias("granting")).agg(
        F.bool_or(F.col("tier") == FULL).alias("has_full")
    )
    held = spread_join(
        memberships.select("principal", "group_name"),
        tiers,
        "group_name",
        "granting",
        ["principal", "group_name"],
        "left",
    )
    grants = held.groupBy("principal").agg(
        F.bool_or("has_full").alias("has_full"), F.count("granting").alias("n_granting")
    )
    tier = F.when(F.col("has_full"), FULL).when(F.col("n_granting") > 0, PARTIAL).otherwise(NONE)
    return grants.select("principal", tier.alias("tier"))
