"""What masked tables are for: trends, cohorts, prevalence, verification.

All take clear tables and mask them for the tier first, so a result never
shows more than the tier allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.functions.masks import (
    apply_mask,
    mask_date_of_birth,
    mask_diagnosis_code,
    mask_financial_amount,
    mask_zip_code,
)
from veilmark.sources.model import TABLES


def cost_trend(claims: DataFrame, amount: str = "paid_amount", tier: str = "partial") -> DataFrame:
    """Claims per month of service and amount range."""
    return (
        claims.groupBy(
            mask_date_of_birth("service_date_from", tier).alias("service_month"),
            mask_financial_amount(amount, tier).alias("amount_range"),
        )
        .agg(F.count("*").alias("n_claims"))
    )


def birth_cohorts(members: DataFrame, tier: str = "partial") -> DataFrame:
    """Members per month (partial) or year (none) of birth."""
    cohort = mask_date_of_birth("date_of_birth", tier).alias("cohort")
    return members.groupBy(cohort).agg(F.count("*").alias("n_members"))


def diagnosis_prevalence(claims: DataFrame, tier: str = "partial") -> DataFrame:
    """Claims and different members per diagnosis category.

    Counted over (category, member) first: the members of a category that
    holds a third of all claims never meet in one task.
    """
    per_member = claims.groupBy(
        mask_diagnosis_code("diagnosis_code_primary", tier).alias("diagnosis"), "member_id"
    ).agg(F.count("*").alias("n"))
    return per_member.groupBy("diagnosis").agg(
        F.sum("n").alias("n_claims"), F.count("member_id").alias("n_members")
    )


def zip3_counts(members: DataFrame, tier: str = "partial") -> DataFrame:
    """Members per state and ZIP prefix."""
    region = mask_zip_code("zip_code", tier).alias("zip3")
    return members.groupBy("state_code", region).agg(F.count("*").alias("n_members"))


def deid_cohort(claims: DataFrame, members: DataFrame, tier: str = "partial") -> DataFrame:
    """Claims and members per birth cohort and diagnosis category, across tables.

    Claims shrink to one row per member and category before the join, so a
    member with very many claims adds little to it. The result names nobody,
    so no identifier has to be hashed to join.
    """
    per_member = (
        claims.where(F.col("member_id").isNotNull())
        .groupBy(
            "member_id",
            mask_diagnosis_code("diagnosis_code_primary", tier).alias("diagnosis"),
        )
        .agg(F.count("*").alias("n"))
    )
    cohorts = members.select(
        "member_id", mask_date_of_birth("date_of_birth", tier).alias("cohort")
    )
    return (
        per_member.join(cohorts, "member_id")
        .groupBy("cohort", "diagnosis")
        .agg(F.sum("n").alias("n_claims"), F.count("*").alias("n_members"))
    )


def deid_cost_by_state(
    claims: DataFrame, members: DataFrame, amount: str = "billed_amount", tier: str = "partial"
) -> DataFrame:
    """Claims and members per state and amount range, across tables."""
    per_member = (
        claims.where(F.col("member_id").isNotNull())
        .groupBy("member_id", mask_financial_amount(amount, tier).alias("amount_range"))
        .agg(F.count("*").alias("n"))
    )
    return (
        per_member.join(members.select("member_id", "state_code"), "member_id")
        .groupBy("state_code", "amount_range")
        .agg(F.sum("n").alias("n_claims"), F.count("*").alias("n_members"))
    )


def verify_by_masked_value(
    df: DataFrame,
    table: str,
    column: str,
    shown: str,
    tier: str = "partial",
    salt: str | None = None,
) -> DataFrame:
    """Rows whose masked value is what the caller quotes, e.g. the last four digits."""
    function = TABLES[table].policy[column]
    return df.where(apply_mask(function, column, tier, salt) == shown)
