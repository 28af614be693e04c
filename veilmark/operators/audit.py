"""Reports over tags, bindings and retention."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.operators.tags import SNAKE_CASE
from veilmark.sources.model import SCHEMA_NAME

# Alert limits of the tag reports.
MAX_TAGS_PER_TABLE = 40
MAX_COLUMN_TAGS = 800
MAX_TAG_VALUES = 50

# Sketches of 2 ** SKETCH_LG_K registers.
SKETCH_LG_K = 12


def _in_schema(tags: DataFrame, schema: str | None) -> DataFrame:
    return tags if schema is None else tags.where(F.col("schema_name") == schema)


def tables_near_tag_limit(
    table_tags: DataFrame, schema: str | None, limit: int = MAX_TAGS_PER_TABLE
) -> DataFrame:
    """Tables with more than ``limit`` different table tags."""
    return (
        _in_schema(table_tags, schema)
        .groupBy("table_name")
        .agg(F.count_distinct("tag_name").alias("tag_count"))
        .where(F.col("tag_count") > limit)
        .orderBy(F.desc("tag_count"))
    )


def tables_near_column_tag_limit(
    column_tags: DataFrame, schema: str | None, limit: int = MAX_COLUMN_TAGS
) -> DataFrame:
    """Tables with more than ``limit`` column tags altogether."""
    return (
        _in_schema(column_tags, schema)
        .groupBy("table_name")
        .agg(F.count("*").alias("total_column_tags"))
        .where(F.col("total_column_tags") > limit)
        .orderBy(F.desc("total_column_tags"))
    )


def tags_with_many_values(
    column_tags: DataFrame, schema: str | None, limit: int = MAX_TAG_VALUES
) -> DataFrame:
    """Tags with more than ``limit`` different values, counted exactly."""
    return (
        _in_schema(column_tags, schema)
        .groupBy("tag_name")
        .agg(F.count_distinct("tag_value").alias("distinct_values"))
        .where(F.col("distinct_values") > limit)
        .orderBy(F.desc("distinct_values"))
    )


def bad_tag_names(column_tags: DataFrame, schema: str | None) -> DataFrame:
    """Tag names that are not lowercase snake case."""
    return (
        _in_schema(column_tags, schema)
        .where(~F.col("tag_name").rlike(SNAKE_CASE))
        .select("tag_name")
        .distinct()
    )


def hipaa_inventory(column_tags: DataFrame, schema: str | None) -> DataFrame:
    """Columns with a HIPAA identifier type, PHI and PII alike."""
    return (
        _in_schema(column_tags, schema)
        .where(F.col("tag_name") == "hipaa_type")
        .select("table_name", "column_name", F.col("tag_value").alias("hipaa_identifier_type"))
        .orderBy("table_name", "column_name")
    )


def masking_inventory(column_tags: DataFrame, schema: str | None) -> DataFrame:
    """Masking rule and sensitivity of each tagged column, by name of the level.

    The levels sort as text, descending, so ``high`` comes before ``critical``.
    """

    def value_of(name):
        return F.max(F.when(F.col("tag_name") == name, F.col("tag_value")))

    return (
        _in_schema(column_tags, schema)
        .where(F.col("tag_name").isin("masking_rule", "sensitivity_level"))
        .groupBy("table_name", "column_name")
        .agg(
            value_of("masking_rule").alias("masking_rule"),
            value_of("sensitivity_level").alias("sensitivity"),
        )
        .orderBy(F.desc("sensitivity"), "table_name")
    )


def policy_coverage(
    column_tags: DataFrame, policy: DataFrame, schema: str = SCHEMA_NAME
) -> DataFrame:
    """Tagged columns without a mask and masks on untagged columns.

    A policy with ``schema_name`` is compared schema by schema; one without belongs
    to ``schema``, and tags of other schemas are left out. Both lists are reduced by
    one grouping; neither side is broadcast.
    """
    keys = ["table_name", "column_name"]
    if "schema_name" in policy.columns:
        keys = ["schema_name", *keys]
    else:
        column_tags = _in_schema(column_tags, schema)
    sides = column_tags.select(
        *keys, F.lit(1).alias("tagged"), F.lit(0).alias("bound")
    ).unionByName(policy.select(*keys, F.lit(0).alias("tagged"), F.lit(1).alias("bound")))
    finding = F.when(F.col("bound") == 0, "tagged without mask").otherwise("mask without tag")
    return (
        sides.groupBy(*keys)
        .agg(F.max("tagged").alias("tagged"), F.max("bound").alias("bound"))
        .where(F.col("tagged") != F.col("bound"))
        .select(*keys, finding.alias("finding"))
    )


def tag_value_sketches(column_tags: DataFrame, ts: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Distinct values per schema, tag and day as sketches, to be stored day by day.

    A sketch has a few kilobytes at most, however many values there were, and is
    combined before the shuffle.
    """
    return column_tags.groupBy(
        "schema_name", "tag_name", F.col(ts).cast("date").alias("day")
    ).agg(F.hll_sketch_agg("tag_value", lg_k).alias("sketch"))


def tags_with_many_values_sketched(
    sketches: DataFrame, schema: str = SCHEMA_NAME, limit: int = MAX_TAG_VALUES
) -> DataFrame:
    """`tags_with_many_values` over all stored days, without reading a tag again.

    Up to some hundred values the count is exact; beyond that its standard error is
    1.04 / sqrt(2 ** lg_k), 1.6% with the sketches made by default.
    """
    merged = (
        _in_schema(sketches, schema)
        .groupBy("tag_name")
        .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
    )
    return merged.where(F.col("distinct_values") > limit)


def retention_report(
    tables: Mapping[str, tuple[DataFrame, str]],
    table_tags: DataFrame,
    as_of: date,
    schema: str = SCHEMA_NAME,
) -> DataFrame:
    """Rows per table and how many are older than its ``retention`` tag allows.

    ``tables`` maps a name to the rows and their date column; their tags are those
    of ``schema``. Of several retentions the longest holds. Rows are counted
    per table and day before anything is shuffled, so the join with the tags
    sees days, not rows. ``indefinite`` and a missing tag never expire; a row
    without a date counts as kept.
    """
    daily = None
    for name, (df, day) in tables.items():
        days = (
            df.groupBy(F.col(day).cast("date").alias("day"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(name).alias("table_name"), "day", "n")
        )
        daily = days if daily is None else daily.unionByName(days)
    if daily is None:
        raise ValueError("retention_report needs at least one table")
    years = F.regexp_extract("tag_value", r"^([0-9]+)_year$", 1).try_cast("int")
    rules = (
        table_tags.where((F.col("tag_name") == "retention") & (F.col("schema_name") == schema))
        .groupBy("table_name")
        .agg(F.max_by("tag_value", F.struct(years.isNull(), years, "tag_value")).alias("tag_value"))
        .select(
            "table_name",
            F.col("tag_value").alias("retention"),
            F.add_months(F.lit(as_of), -12 * years).alias("keep_from"),
        )
    )
    expired = F.when(F.col("day") < F.col("keep_from"), F.col("n")).otherwise(0)
    return (
        daily.join(rules, "table_name", "left")
        .groupBy("table_name", "retention", "keep_from")
        .agg(F.sum("n").alias("n_rows"), F.sum(expired).alias("n_expired"))
    )
