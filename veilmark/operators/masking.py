"""Binding masks to columns, masked tables and their export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark.functions.masks import apply_mask
from veilmark.sources.model import TABLES



def _same(column: str, name: str) -> Column:
    return F.lower(column) == name.lower()


def _of_table(policy: DataFrame, table: str, schema: str | None) -> Column:
    """Rows of one table; a policy that names schemas has to be asked for one."""
    has_schema = "schema_name" in policy.columns
    if has_schema != (schema is not None):
        raise ValueError(
            "the policy has schemas: name one" if has_schema else "the policy names no schemas"
        )
    found = _same("table_name", table)
    return found & _same("schema_name", schema) if has_schema else found


def policy_of(policy: DataFrame, table: str, schema: str | None = None) -> dict[str, str]:
    """Bindings of one table, read on the driver: at most one row per column.

    Names are matched without case. A table without any binding is refused, as a
    misspelled name would show it in clear, and so are two bindings of one column. If
    the policy has ``schema_name``, tables of one name in two schemas are two tables.
    """
    rows = policy.where(_of_table(policy, table, schema))
    bindings: dict[str, str] = {}
    for row in rows.select(F.lower("column_name"), "function_name").distinct().collect():
        column, function = row
        if column in bindings:
            raise ValueError(f"column {column} of {table} is bound to several functions")
        bindings[column] = function
    if not bindings:
        raise ValueError(f"the policy binds no column of {table}")
    return bindings


def bind_mask(
    policy: DataFrame, table: str, column: str, function: str, schema: str | None = None
) -> DataFrame:
    """The policy with a column bound to a function, replacing an older binding."""
    same = _of_table(policy, table, schema) & _same("column_name", column)
    values = {
        "schema_name": schema,
        "table_name": table,
        "column_name": column,
        "function_name": function,
    }
    row = policy.sparkSession.createDataFrame([tuple(values[c] for c in policy.columns)], policy.schema)
    return policy.where(~same).unionByName(row)


def masked(
    df: DataFrame,
    table: str | Mapping[str, str],
    tier: str | Column,
    salt: str | None = None,
    projected: bool = False,
) -> DataFrame:
    """A table as a reader of the tier sees it: one projection, no shuffle.

    ``table`` names a table of the model or gives the binding of columns to
    functions. Unbound columns pass through. Bound columns are STRING in every
    tier, so all tiers share a schema. Names are matched without case, as
    Spark resolves them, so a binding cannot be dodged by spelling. Rows that
    lack a bound column are refused, as the column it was meant for may go by
    another name and would pass in clear; ``projected`` says that columns were left out
    on purpose.
    """
    policy = TABLES[table].policy if isinstance(table, str) else table
    functions = {column.lower(): function for column, function in policy.items()}
    lacking = functions.keys() - {c.lower() for c in df.columns}
    if lacking and not projected:
        raise ValueError(f"masks are bound to columns that are not there: {sorted(lacking)}")
    projection = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        function = functions.get(f.name.lower())
        if function:
            value = apply_mask(function, column, tier, salt)
            column = value.alias(f.name, metadata=f.metadata)
        projection.append(column)
    return df.select(*projection)


def by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition value brought together, in tasks of even size.

    Without this every task writes a file for every value it meets, which at
    many tasks means millions of small files. Adaptive execution cuts a value
    that holds a large part of the rows into several tasks and merges rare ones.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_masked(
    df: DataFrame,
    table: str | Mapping[str, str],
    tier: str,
    path: str,
    salt: str | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    projected: bool = False,
) -> None:
    """Write a masked copy: a map-only job unless it is partitioned."""
    rows = masked(df, table, tier, salt, projected)
    writer = by_partition(rows, partition_by).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_masked(
    df: DataFrame,
    table: str | Mapping[str, str],
    tier: str,
    name: str,
    salt: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 0,
    mode: str = "overwrite",
    projected: bool = False,
) -> None:
    """Write a masked copy as a table of the catalog.

    Copies bucketed by one hashed identifier into equally many buckets join on
    it without a shuffle. A bucket cannot be split later: leave the layout off
    where one identifier may hold a large part of the rows.
    """
    writer = masked(df, table, tier, salt, projected).write.mode(mode).format("parquet")
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by)
    writer.saveAsTable(name)
