"""Typed loading of loosely typed rows, and the tables they go to."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.sources.model import SCHEMA_COMMENT, SCHEMA_NAME, TABLES, TableSpec

STAMPS = ("created_at", "updated_at")
REASONS = "reject_reasons"
RECORD = "raw_record"
FAULT = "record_fault"
FIELD_COUNT = "number of fields"
OPEN_QUOTE = "open quote"
UNPARSEABLE = "not one object"
UNKNOWN_FIELDS = "unknown fields"

# Lines a CSV record may have.
MOST_LINES = 10_000


def text_schema(table: str) -> T.StructType:
    """The table's columns in order, all STRING: how raw rows are read."""
    return T.StructType([T.StructField(c.name, T.StringType()) for c in TABLES[table].columns])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files that are not blank."""
    return spark.read.text(path).select(F.col("value").alias(RECORD)).where(F.trim(RECORD) != "")


def _records(spark: SparkSession, path: str) -> DataFrame:
    """CSV records of text files, whose quoted values may hold line breaks.

    Returns the record and whether a quote stays open. Files are cut into splits as for
    any text: every split counts the quotes of its lines, the sums over the
    splits above tell whether it begins within quotes, and the lines of a record
    that goes on, also into the next split, are put together. Only these lines meet by
    record; all others are records as they are. A record of more than `MOST_LINES`
    lines is a quote that nobody closed: each of its lines is returned by itself.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    upto = Window.partitionBy("file", "block").orderBy("place")
    above = upto.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("odd", quotes % 2).withColumn(
        "odd_above", F.coalesce(F.sum("odd").over(above), F.lit(0))
    )
    # A line begins a record if the quotes before it are closed; how many there are
    # before the split is not known yet, so both cases are counted.
    evenly = F.when(F.col("odd_above") % 2 == 0, 1).otherwise(0)
    lines = lines.withColumn("n_if_closed", F.sum(evenly).over(upto)).withColumn(
        "n_if_open", F.sum(1 - evenly).over(upto)
    )
    # One row per split.
    over_file = Window.partitionBy("file").orderBy("block")
    before = over_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("file", "block")
        .agg(F.sum("odd").alias("n_odd"), F.max("n_if_closed").alias("c"), F.max("n_if_open").alias("o"))
        .withColumn("in_quotes", F.coalesce(F.sum("n_odd").over(before), F.lit(0)) % 2 == 1)
        .withColumn("n", F.when(F.col("in_quotes"), F.col("o")).otherwise(F.col("c")))
        .withColumn("n_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("file", "block", "in_quotes", "n_before")
    )
    begins_even = F.when(F.col("in_quotes"), 1).otherwise(0)
    begins = (F.col("odd_above") + begins_even) % 2 == 0
    n_upto = F.when(F.col("in_quotes"), F.col("n_if_open")).otherwise(F.col("n_if_closed"))
    lines = lines.join(splits, ["file", "block"]).select(
        "file",
        "block",
        "place",
        "line",
        (begins & (F.col("odd") == 0)).alias("is_whole"),
        (n_upto + F.col("n_before")).alias("record"),
    )
    parts = lines.where("NOT is_whole")
    sizes = parts.groupBy("file", "record").agg(F.count("*").alias("n_lines"))
    parts = parts.join(sizes, ["file", "record"])
    text = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("block", "place", "line"))), lambda p: p["line"]
        ),
        "\n",
    )
    joined = parts.where(F.col("n_lines") <= MOST_LINES).groupBy("file", "record").agg(text.alias("line"))
    closed = lines.where("is_whole").select("line", F.lit(False).alias("is_open")).unionByName(
        joined.select("line", (quotes % 2 == 1).alias("is_open"))
    )
    found = closed.unionByName(
        parts.where(F.col("n_lines") > MOST_LINES).select("line", F.lit(True).alias("is_open"))
    )
    record = F.regexp_replace("line", "\\r$", "").alias(RECORD)
    return found.select(record, "is_open").where(F.trim(RECORD) != "")


def read_csv(
    spark: SparkSession,
    table: str,
    path: str,
    header: bool = False,
    null_value: str = "",
    quoted_newlines: bool = False,
) -> DataFrame:
    """Raw rows of a CSV file or folder, columns by position, none cut or padded.

    A record with another number of fields, or whose quotes do not close, carries its
    whole text and a fault, so `checked` makes it a reject. Without
    ``quoted_newlines`` quotes have to close on their line; with it a quoted value may
    hold line breaks and quotes have to close within the file. Either way a file
    is read by many tasks. ``header`` drops the line of column names and fails on
    names out of order.
    """
    names = text_schema(table).names
    options = {"nullValue": null_value, "escape": '"', "columnNameOfCorruptRecord": "corrupt_record"}
    schema = text_schema(table).add("corrupt_record", "string").simpleString()[len("struct<") : -1]
    parsed = F.from_csv(RECORD, schema.replace(":", " "), options)
    if quoted_newlines:
        records = _records(spark, path)
    else:
        n_quotes = F.length(RECORD) - F.length(F.replace(F.col(RECORD), F.lit('"'), F.lit("")))
        records = _lines(spark, path).withColumn("is_open", n_quotes % 2 == 1)
    # A generator, so that filters on the columns do not parse the record again.
    rows = records.select(RECORD, "is_open", F.explode(F.array(parsed)).alias("fields"))
    fault = F.when(F.col("is_open"), OPEN_QUOTE).when(
        F.col("corrupt_record").isNotNull(), FIELD_COUNT
    )
    rows = rows.select("fields.*", RECORD, "is_open").withColumn(FAULT, fault)
    rows = rows.drop("corrupt_record", "is_open")
    if header:
        found = F.array(*[F.lower(F.trim(n)) for n in names])
        is_header = F.array_sort(found) == F.array(*[F.lit(n) for n in sorted(names)])
        in_order = found == F.array(*[F.lit(n) for n in names])
        wrong = F.raise_error(F.lit(f"the header does not have the columns of {table} in order"))
        is_row = F.when(~F.coalesce(is_header, F.lit(False)), True).when(in_order, False)
        rows = rows.where(is_row.otherwise(wrong.cast("boolean")))
    return rows


def read_json(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Raw rows of JSON lines, columns by name; quoted and bare values alike.

    A line that is not one whole object, or that has fields the table does not
    know, carries its text and a fault, so `checked` makes it a reject.
    """
    schema = text_schema(table)
    # Read as a list, so that text behind the object is an error and not ignored.
    listed = F.concat(F.lit("["), F.col(RECORD), F.lit("]"))
    rows = _lines(spark, path).select(
        RECORD, F.posexplode_outer(F.from_json(listed, T.ArrayType(schema))).alias("nth", "fields")
    )
    keys = F.json_object_keys(RECORD)
    unknown = F.array_except(keys, F.array(*[F.lit(n) for n in schema.names]))
    fault = F.when(F.col("fields").isNull() | keys.isNull(), UNPARSEABLE).when(
        F.size(unknown) > 0, UNKNOWN_FIELDS
    )
    return rows.select("fields.*", RECORD, fault.alias(FAULT))


def checked(
    raw: DataFrame, table: str, stamp: datetime | None = None, positional: bool = False
) -> DataFrame:
    """Raw rows cast to the table's types, with the columns that would not cast.

    Values are cast by the declared type, whether quoted or not. A value that
    does not fit leaves NULL and its column name in ``reject_reasons``, a list
    with commas in the order of the columns; a record the reader found faulty has
    its fault there. ``raw_record`` is the text of every row that has a reason: its
    line, or its raw values as JSON. Decimals with more digits behind the point than
    their column are rounded half up, as an insert does. Missing audit stamps get
    one time for the whole load: ``stamp`` or now.
    """
    spec = TABLES[table]
    names = [c.name for c in spec.columns]
    if positional:
        given = [c for c in raw.columns if c not in (RECORD, FAULT)]
        if len(given) != len(names):
            raise ValueError(f"{table} has {len(names)} columns, not {len(given)}")
        raw = raw.withColumnsRenamed(dict(zip(given, names, strict=True)))
    present = {c.lower() for c in raw.columns}
    required = [n for n in names if n not in STAMPS]
    missing = [n for n in required if n not in present]
    if missing:
        raise ValueError(f"columns missing for {table}: {', '.join(missing)}")
    now = F.lit(stamp).cast("timestamp") if stamp else F.current_timestamp()

    values, misfits = [], []
    for f in spec.schema.fields:
        if f.name in present:
            typed = f"try_cast({f.name} AS {f.dataType.simpleString()})"
            value = F.expr(typed)
            if f.dataType != T.StringType():
                misfit = f"{f.name} IS NOT NULL AND {typed} IS NULL"
                misfits.append(F.expr(f"CASE WHEN {misfit} THEN '{f.name}' END"))
        else:
            value = F.lit(None).cast(f.dataType)
        if f.name in STAMPS:
            value = F.coalesce(value, now)
        values.append(value.alias(f.name, metadata=f.metadata))
    reasons = F.concat_ws(",", *misfits)
    if FAULT in raw.columns:
        reasons = F.coalesce(FAULT, reasons)
    shown = [F.col(c) for c in raw.columns if c not in (RECORD, FAULT)]
    text = F.to_json(F.struct(*shown))
    if RECORD in raw.columns:
        text = F.coalesce(RECORD, text)
    return raw.select(
        *values, F.when(reasons != "", text).alias(RECORD), reasons.alias(REASONS)
    )


def accepted(checked_rows: DataFrame) -> DataFrame:
    """Rows in which every value fits its column."""
    return checked_rows.where(F.col(REASONS) == "").drop(REASONS, RECORD)


def rejected(checked_rows: DataFrame) -> DataFrame:
    """Faulty records and rows with a value that does not fit: reasons and raw text."""
    return checked_rows.where(F.col(REASONS) != "")


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(
    spark: SparkSession, schema: str = SCHEMA_NAME, location: str | None = None
) -> None:
    """Create the schema unless it is there; ``location`` is where its tables go."""
    place = f" LOCATION {quoted(location)}" if location else ""
    comment = quoted(SCHEMA_COMMENT)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}` COMMENT {comment}{place}")


def _describe(spark: SparkSession, name: str, spec: TableSpec) -> None:
    properties = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in spec.properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({properties})")
    spark.sql(f"COMMENT ON TABLE {name} IS {quoted(spec.comment)}")


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    """Everything the catalog says about a table, name by name."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"]}


def _layout(spark: SparkSession, name: str) -> tuple:
    """What the files of a table have to fit: columns, types and buckets."""
    facts = _facts(spark, name)
    columns = [(f.name, f.dataType) for f in spark.table(name).schema]
    return columns, facts.get("Num Buckets"), facts.get("Bucket Columns")


def replace_table(
    spark: SparkSession,
    table: str,
    rows: DataFrame | None = None,
    schema: str = SCHEMA_NAME,
    bucket_by: str | None = None,
    buckets: int = 0,
) -> str:
    """Create a table or replace it with ``rows`` (none: empty); return its name.

    Column comments, table comment and properties come from the model. Running
    a load twice therefore leaves one copy. With ``bucket_by`` the files are
    laid out by that column, so joins on it need no shuffle; leave it off where
    one key may hold a large part of the rows, as a bucket cannot be split.

    The rows go to a folder of their own, under a table name of their own. Only when
    they are complete, one catalog call points the table at the new folder, so
    a reader sees the old rows or the new ones, and the old ones after a failed load.
    The old folder stays, for readers that have begun; whoever keeps the schema's
    files removes it. Only where columns or buckets change, the new table takes the old
    one's name in two calls, between which there is no table of that name.
    """
    spec = TABLES[table]
    name = f"`{schema}`.`{table}`"
    version = f"{table}__{uuid.uuid4().hex}"
    fresh = f"`{schema}`.`{version}`"
    folder = f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{version}"
    rows = spark.createDataFrame([], spec.schema) if rows is None else rows
    typed = rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in spec.schema]
    )
    writer = typed.write.mode("errorifexists").format("parquet").option("path", folder)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by)
    try:
        writer.saveAsTable(fresh)
        _describe(spark, fresh, spec)
        if not spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        elif _layout(spark, name) == _layout(spark, fresh):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(folder)}")
            _describe_again(spark, name, spec)
        else:
            spark.sql(f"ALTER TABLE {name} RENAME TO `{schema}`.`{version}_old`")
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
            spark.sql(f"DROP TABLE `{schema}`.`{version}_old`")
    finally:
        # The files of an external table stay.
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    return name


def _describe_again(spark: SparkSession, name: str, spec: TableSpec) -> None:
    """Bring comments and properties up to the model where they differ from it."""
    for field in spark.table(name).schema:
        wanted = spec.schema[field.name].metadata["comment"]
        if field.metadata.get("comment") != wanted:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{field.name}` COMMENT {quoted(wanted)}")
    facts = _facts(spark, name)
    shown = facts.get("Table Properties", "")
    if facts.get("Comment") != spec.comment or any(
        f"{k}={v}" not in shown for k, v in spec.properties.items()
    ):
        _describe(spark, name, spec)


def append_rows(
    spark: SparkSession, table: str, rows: DataFrame, schema: str = SCHEMA_NAME
) -> None:
    """Append typed rows by position, as an insert without column list does."""
    rows.write.mode("append").insertInto(f"`{schema}`.`{table}`")
