"""What the catalog says about the tables of the model, against the model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilmark.sources.model import SCHEMA_NAME, TABLES

COLUMNS = "table_name string, position int, column_name string, data_type string, comment string"
PROPERTIES = "table_name string, property string, value string"


def live_tables(spark: SparkSession, schema: str = SCHEMA_NAME) -> list[str]:
    """Tables of the model that the schema has."""
    there = {t.name for t in spark.catalog.listTables(schema) if t.tableType != "VIEW"}
    return [t for t in TABLES if t in there]


def live_columns(spark: SparkSession, schema: str = SCHEMA_NAME) -> DataFrame:
    """One row per column of the model's tables, as the catalog has them now."""
    rows = [
        (table, i, f.name, f.dataType.simpleString(), f.metadata.get("comment"))
        for table in live_tables(spark, schema)
        for i, f in enumerate(spark.table(f"`{schema}`.`{table}`").schema, 1)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def live_properties(spark: SparkSession, schema: str = SCHEMA_NAME) -> DataFrame:
    """Properties of the model's tables, their comment as property ``comment``."""
    found = spark.createDataFrame([], PROPERTIES)
    for table in live_tables(spark, schema):
        name = f"`{schema}`.`{table}`"
        shown = spark.sql(f"SHOW TBLPROPERTIES {name}")
        comment = spark.createDataFrame(
            [(table, "comment", spark.catalog.getTable(name).description)], PROPERTIES
        )
        found = found.unionByName(
            shown.select(F.lit(table).alias("table_name"), F.col("key").alias("property"), "value")
        ).unionByName(comment)
    return found


def _expected_columns(spark: SparkSession) -> DataFrame:
    rows = [
        (t.name, i, f.name, f.dataType.simpleString(), f.metadata["comment"])
        for t in TABLES.values()
        for i, f in enumerate(t.schema, 1)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def _expected_properties(spark: SparkSession) -> DataFrame:
    rows = [
        (t.name, key, value)
        for t in TABLES.values()
        for key, value in {**t.properties, "comment": t.comment}.items()
    ]
    return spark.createDataFrame(rows, PROPERTIES)


def catalog_drift(spark: SparkSession, schema: str = SCHEMA_NAME) -> DataFrame:
    """Where the catalog has left the model: (table_name, item, fact, expected, found).

    ``fact`` is ``table``, ``position``, ``type`` or ``comment`` of a column, ``column``
    for one that only one side has, or ``property``. Properties the model does not
    know are nobody's concern. A table that is not there is one row.
    """
    there = live_tables(spark, schema)
    absent = spark.createDataFrame(
        [(t, None, "table", t, None) for t in TABLES if t not in there],
        "table_name string, item string, fact string, expected string, found string",
    )
    has_table = F.col("table_name").isin(there) if there else F.lit(False)
    sides = [
        df.where(has_table).select(
            "table_name",
            F.col("column_name").alias("item"),
            F.struct(
                F.col("position").cast("string").alias("position"), "data_type", "comment"
            ).alias(side),
        )
        for df, side in ((_expected_columns(spark), "want"), (live_columns(spark, schema), "got"))
    ]
    both = sides[0].join(sides[1], ["table_name", "item"], "full")
    facts = F.when(
        F.col("want").isNull() | F.col("got").isNull(),
        F.array(
            F.struct(
                F.lit("column").alias("fact"),
                F.when(F.col("want").isNotNull(), F.col("item")).alias("expected"),
                F.when(F.col("got").isNotNull(), F.col("item")).alias("found"),
            )
        ),
    ).otherwise(
        F.array(
            *[
                F.struct(
                    F.lit(fact).alias("fact"),
                    F.col(f"want.{field}").alias("expected"),
                    F.col(f"got.{field}").alias("found"),
                )
                for fact, field in (
                    ("position", "position"),
                    ("type", "data_type"),
                    ("comment", "comment"),
                )
            ]
        )
    )
    columns = both.select("table_name", "item", F.inline(facts))
    wanted = _expected_properties(spark).where(has_table)
    live = live_properties(spark, schema).withColumnRenamed("value", "found")
    properties = wanted.join(live, ["table_name", "property"], "left").select(
        "table_name",
        F.col("property").alias("item"),
        F.lit("property").alias("fact"),
        F.col("value").alias("expected"),
        "found",
    )
    # A column on one side only has the same text nowhere, so one test serves all.
    differs = ~F.col("expected").eqNullSafe(F.col("found"))
    return absent.unionByName(columns.unionByName(properties).where(differs))
