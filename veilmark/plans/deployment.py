"""From raw rows to typed tables, tag tables, policy and masked copies."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veilmark.operators import tags
from veilmark.sources import ingest, model

REJECTS = f"table_name string, {ingest.REASONS} string, {ingest.RECORD} string"


def deploy(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    schema: str = model.SCHEMA_NAME,
    stamp: datetime | None = None,
    rejects: str | None = None,
) -> dict[str, str]:
    """Create the schema, load every table given, store tags and policy.

    Each load replaces its table, so running it again changes nothing. Rows and
    rejects are counted while the table is written and stored as `load_report`.
    Every reject is kept in `load_rejects` with its reasons and raw text; the raw
    rows are read a second time only if there are any. ``rejects`` names a path
    for another copy that has the typed columns as well.
    """
    ingest.create_schema(spark, schema)
    names, report = {}, []
    kept = spark.createDataFrame([], REJECTS)
    for table, rows in raw.items():
        typed = ingest.checked(rows, table, stamp)
        seen = Observation(f"load_{table}")
        is_reject = F.col(ingest.REASONS) != ""
        counted = typed.observe(
            seen, F.count("*").alias("n_rows"), F.count_if(is_reject).alias("n_rejected")
        )
        names[table] = ingest.replace_table(spark, table, ingest.accepted(counted), schema)
        report.append((table, seen.get["n_rows"], seen.get["n_rejected"]))
        if seen.get["n_rejected"]:
            refused = ingest.rejected(typed)
            kept = kept.unionByName(
                refused.select(F.lit(table).alias("table_name"), ingest.REASONS, ingest.RECORD)
            )
            if rejects:
                refused.write.mode("overwrite").parquet(f"{rejects}/{table}")
    catalog = {
        "schema_tags": tags.schema_tags(spark),
        "table_tags": tags.table_tags(spark),
        "column_tags": tags.column_tags(spark),
        "masking_policy": model.masking_policy(spark),
        "data_dictionary": model.data_dictionary(spark),
        "table_properties": model.table_properties(spark),
        "load_rejects": kept,
        "load_report": spark.createDataFrame(
            report, "table_name string, n_rows long, n_rejected long"
        ),
    }
    for name, df in catalog.items():
        names[name] = f"`{schema}`.`{name}`"
        df.write.mode("overwrite").format("parquet").saveAsTable(names[name])
    return names
