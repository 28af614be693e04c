"""Tag tables: assignment, inheritance and checks.

Tags are rows (schema_name, table_name, column_name, tag_name, tag_value);
table and schema tags leave out the finer names. A column without a tag needs
no special handling.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilmark.operators.joins import spread_join
from veilmark.sources.model import (
    ALLOWED_TAG_VALUES,
    NON_SENSITIVE,
    PHI,
    PII,
    SCHEMA_NAME,
    SCHEMA_TAGS,
    SENSITIVE,
    TABLES,
)

SCHEMA_KEYS = ("schema_name", "tag_name")
TABLE_KEYS = ("schema_name", "table_name", "tag_name")
COLUMN_KEYS = ("schema_name", "table_name", "column_name", "tag_name")
SNAKE_CASE = "^[a-z0-9_]+$"


def _tag_rows(spark: SparkSession, rows: Iterable[tuple], names: Sequence[str]) -> DataFrame:
    """Rows whose last field is a {tag: value} map, one output row per tag."""
    fields = ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame(list(rows), f"{fields}, tags map<string,string>")
    return df.select(*names, F.explode("tags").alias("tag_name", "tag_value"))


def schema_tags(spark: SparkSession) -> DataFrame:
    return _tag_rows(spark, [(SCHEMA_NAME, SCHEMA_TAGS)], ["schema_name"])


def table_tags(spark: SparkSession) -> DataFrame:
    rows = [(SCHEMA_NAME, t.name, t.tags) for t in TABLES.values()]
    return _tag_rows(spark, rows, ["schema_name", "table_name"])


def column_tags(spark: SparkSession) -> DataFrame:
    rows = [
        (SCHEMA_NAME, t.name, c.name, c.tags) for t in TABLES.values() for c in t.columns if c.tags
    ]
    return _tag_rows(spark, rows, ["schema_name", "table_name", "column_name"])


def latest_tags(log: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """State after a log of assignments: per object and tag the last one wins.

    Equal positions in the log fall back to the greater value, so the result
    does not depend on the order in which rows arrive.
    """
    last = F.max(F.struct(*[F.col(c) for c in order], F.col("tag_value")))
    return (
        log.groupBy(*keys)
        .agg(last.alias("last"))
        .select(*keys, F.col("last.tag_value").alias("tag_value"))
    )


def set_tags(current: DataFrame, assignments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current tags with new assignments put over them."""
    both = current.withColumn("seq", F.lit(0)).unionByName(assignments.withColumn("seq", F.lit(1)))
    return latest_tags(both, ["seq"], keys)


def append_assignments(
    assignments: DataFrame, log: str, assigned_at: datetime | None = None
) -> None:
    """Add assignments to a log table of the catalog.

    The log only grows: readers never meet a half-written state, and `latest_tags`
    over ``assigned_at`` gives the tags as of any time.
    """
    at = F.lit(assigned_at).cast("timestamp") if assigned_at else F.current_timestamp()
    stamped = assignments.withColumn("assigned_at", at)
    stamped.write.mode("append").format("parquet").saveAsTable(log)


def set_schema_tags(current: DataFrame, schema: str, tags: Mapping[str, str]) -> DataFrame:
    new = _tag_rows(current.sparkSession, [(schema, dict(tags))], ["schema_name"])
    return set_tags(current, new, SCHEMA_KEYS)


def set_table_tags(
    current: DataFrame, schema: str, table: str, tags: Mapping[str, str]
) -> DataFrame:
    rows = [(schema, table, dict(tags))]
    new = _tag_rows(current.sparkSession, rows, ["schema_name", "table_name"])
    return set_tags(current, new, TABLE_KEYS)


def set_column_tags(
    current: DataFrame, schema: str, table: str, column: str, tags: Mapping[str, str]
) -> DataFrame:
    rows = [(schema, table, column, dict(tags))]
    new = _tag_rows(current.sparkSession, rows, ["schema_name", "table_name", "column_name"])
    return set_tags(current, new, COLUMN_KEYS)


def tag_value_violations(
    tags: DataFrame, allowed: Mapping[str, Sequence[str]] = ALLOWED_TAG_VALUES
) -> DataFrame:
    """Tags of a governed name whose value is not allowed.

    The rule is configuration, so it becomes one predicate in the scan; there
    is no join. Names without a list are not governed.
    """
    broken = F.lit(False)
    for name, values in allowed.items():
        wrong = ~F.col("tag_value").isin(*values) | F.col("tag_value").isNull()
        broken = broken | ((F.col("tag_name") == name) & wrong)
    return tags.where(broken)


def naming_violations(tags: DataFrame) -> DataFrame:
    """Tags whose name or value is not lowercase snake case."""
    return tags.where(~F.col("tag_name").rlike(SNAKE_CASE) | ~F.col("tag_value").rlike(SNAKE_CASE))


def effective_table_tags(
    tables: DataFrame, own_tags: DataFrame, inherited: DataFrame
) -> DataFrame:
    """Tags of every table, its own and those of its schema.

    A schema tag holds for all tables of the schema, also for one created
    later. Where both levels set a tag, the table's own value counts.
    """
    from_schema = spread_join(
        tables.select("schema_name", "table_name"),
        inherited.select(F.col("schema_name").alias("tagged_schema"), "tag_name", "tag_value"),
        "schema_name",
        "tagged_schema",
        ["schema_name", "table_name"],
    ).drop("tagged_schema")
    level = from_schema.withColumn("level", F.lit(0)).unionByName(
        own_tags.withColumn("level", F.lit(1))
    )
    nearest = F.max(F.struct("level", "tag_value"))
    return (
        level.groupBy(*TABLE_KEYS)
        .agg(nearest.alias("nearest"))
        .select(
            *TABLE_KEYS,
            F.col("nearest.tag_value").alias("tag_value"),
            (F.col("nearest.level") == 0).alias("is_inherited"),
        )
    )


def _tag(name: str) -> Column:
    return F.max(F.when(F.col("tag_name") == name, F.col("tag_value"))).alias(name)


def _columns_with_tags(dictionary: DataFrame, tags: DataFrame, *names: str) -> DataFrame:
    """Dictionary and tags side by side, one row per column of either.

    A union and one grouping instead of a full outer join: one shuffle, and
    both sides are combined before it.
    """
    keys = ["schema_name", "table_name", "column_name"]
    both = (
        dictionary.select(
            *keys,
            "column_class",
            F.lit(True).alias("in_dictionary"),
            F.lit(None).cast("string").alias("tag_name"),
            F.lit(None).cast("string").alias("tag_value"),
        )
    ).unionByName(
        tags.select(
            *keys,
            F.lit(None).cast("string").alias("column_class"),
            F.lit(False).alias("in_dictionary"),
            "tag_name",
            "tag_value",
        )
    )
    return both.groupBy(*keys).agg(
        F.max("column_class").alias("column_class"),
        F.bool_or("in_dictionary").alias("in_dictionary"),
        (F.count("tag_name") > 0).alias("is_tagged"),
        *[_tag(n) for n in names],
    )


def masking_rules(dictionary: DataFrame, tags: DataFrame) -> DataFrame:
    """Masking rule of every column; ``none`` where no tag asks for one."""
    return _columns_with_tags(dictionary, tags, "masking_rule").select(
        "schema_name",
        "table_name",
        "column_name",
        F.coalesce("masking_rule", F.lit("none")).alias("masking_rule"),
    )


def class_tag_mismatches(dictionary: DataFrame, tags: DataFrame) -> DataFrame:
    """Columns whose comment class and tags do not agree.

    PHI and PII need their flag and no other, sensitive columns need tags but
    no flag, non-sensitive ones no tag at all. Tags of unknown columns and
    columns without a class are mismatches too.
    """
    both = _columns_with_tags(dictionary, tags, "contains_phi", "contains_pii")
    phi = F.col("contains_phi").eqNullSafe("true")
    pii = F.col("contains_pii").eqNullSafe("true")
    implied = (
        F.when(phi & pii, F.lit("PHI and PII"))
        .when(phi, F.lit(PHI))
        .when(pii, F.lit(PII))
        .when(F.col("is_tagged"), F.lit(SENSITIVE))
        .otherwise(F.lit(NON_SENSITIVE))
    )
    named = both.withColumn("tag_class", implied)
    return named.where(
        ~F.col("in_dictionary") | ~F.col("column_class").eqNullSafe(F.col("tag_class"))
    ).select(
        "schema_name", "table_name", "column_name", "in_dictionary", "column_class", "tag_class"
    )
