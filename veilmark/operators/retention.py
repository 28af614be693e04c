"""Acting on retention: rows past their date are removed from partitioned tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from veilmark.sources.ingest import quoted

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Purge:
    """What a purge did: rows before and removed, partitions dropped and rewritten."""

    n_rows: int
    n_removed: int
    dropped: int
    rewritten: int
    untouched: int


def _is(spec: dict[str, object]) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in spec.items()])


def _clause(spec: dict[str, object]) -> str:
    """A partition as DDL; NULL is a value of its own."""
    items = [f"`{c}` = {'NULL' if v is None else quoted(str(v))}" for c, v in spec.items()]
    return f"PARTITION ({', '.join(items)})"


def purge(spark: SparkSession, name: str, day: str, keep_from: date) -> Purge:
    """Remove the rows of a managed partitioned table whose day is before ``keep_from``.

    Rows are counted per partition; only these counts reach the driver. Partitions in
    which every row has expired are dropped, those in which some have are written
    anew without them, and files of all others are not touched. A rewritten partition
    is exchanged when its new files are complete, and a purge that broke off is
    simply run again. Rows without a day stay, as in `retention_report`.
    """
    table = spark.table(name)
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not keys:
        raise ValueError(f"{name} has no partitions")
    is_expired = F.coalesce(F.col(day).cast("date") < F.lit(keep_from), F.lit(False))
    counts = (
        table.groupBy(*keys)
        .agg(F.count("*").alias("n_rows"), F.count_if(is_expired).alias("n_expired"))
        .collect()
    )
    specs = [({k: r[k] for k in keys}, r["n_rows"], r["n_expired"]) for r in counts]
    gone = [s for s, n, expired in specs if expired == n]
    mixed = [s for s, n, expired in specs if 0 < expired < n]
    if mixed:
        kept = table.where(reduce(Column.__or__, map(_is, mixed)) & ~is_expired)
        before = spark.conf.get(OVERWRITE_MODE)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            by_partition = kept.hint("rebalance", *keys)
            by_partition.write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.set(OVERWRITE_MODE, before)
    for spec in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_clause(spec)}")
    spark.sql(f"REFRESH TABLE {name}")
    return Purge(
        sum(n for _, n, _ in specs),
        sum(expired for _, _, expired in specs),
        len(gone),
        len(mixed),
        len(specs) - len(gone) - len(mixed),
    )
