"""Sharding by sampled splitters.

Size-weighted key samples give quantile boundaries; records are dealt into the
ranges between them; ranges that come out overfull (a hot key cannot be split by
a key boundary) are subdivided by a hash of the record id. The exact sizes of the
ranges then place every record on the line of all bytes, which is cut into
shards of equal length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilmark.llm.common import one_row, parts_for, stored, utf8_crc32

SHARDS = 24
ROWS_PER_RANGE = 1024
MOST_RANGES = 16384
SAMPLES_PER_RANGE = 32
OVERFULL = 2
# Ranges in a partition of ordered records, which one task sorts and writes.
RANGES_TOGETHER = 16
GROUP = 128
HASH_BITS = 31
KEY_BITS = 52
SAMPLE_SEED = 41
SPLIT_SEED = 43
KEY_SEED = 47

RANGE, SUB, START, ROW = "_range", "_sub", "_start", "_row"


def unit_hash(column: Column, seed: int, bits: int = HASH_BITS) -> Column:
    """A hash as a long of so many bits, the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(column, F.lit(seed)), 64 - bits)


def _numbers(joined: Column) -> Column:
    return F.split(joined, ",").cast("array<bigint>")


def splitters(
    records: DataFrame, key: str, size: str, row_id: str, n_ranges: int, total: int
) -> list[int]:
    """At most ``n_ranges - 1`` ascending keys that cut the bytes about evenly.

    A record counts ``size / step`` times on average; what is left of a step is
    decided by a hash of its id, so a run that is repeated draws the same
    sample. The sample has about ``n_ranges * SAMPLES_PER_RANGE`` keys whatever
    the input, and only its quantiles reach the driver. NULL keys sort first.
    """
    if n_ranges < 2:
        return []
    step = max(1, total // (n_ranges * SAMPLES_PER_RANGE))
    draw = F.shiftright(unit_hash(F.col(row_id), SAMPLE_SEED) * F.lit(step), HASH_BITS)
    hits = F.floor((F.col(size) + draw) / F.lit(step)).cast("long")
    sample = records.select(F.col(key).alias("k"), hits.alias("hits")).where("hits > 0")
    shares = ",".join(f"{i / n_ranges!r}D" for i in range(1, n_ranges))
    got = sample.agg(F.expr(f"percentile(k, array({shares}), hits)").alias("q")).first()["q"]
    return sorted({int(q) for q in got or []})


def range_of(key: Column, cuts: Sequence[int]) -> Column:
    """Index of the range a key falls into: how many cuts are at or below it.

    Looked up in two steps, heads of groups first. NULL falls into range 0.
    """
    if not cuts:  # not a literal, so that joins on it stay equi-joins
        return (F.hash(key) * 0).cast("long")
    groups = [cuts[i : i + GROUP] for i in range(0, len(cuts), GROUP)]
    heads = _numbers(F.lit(",".join(str(g[0]) for g in groups)))
    inner = F.array(*[_numbers(F.lit(",".join(map(str, g)))) for g in groups])
    group = F.greatest(F.size(F.filter(heads, lambda c: c <= key)) - 1, F.lit(0))
    within = F.size(F.filter(F.get(inner, group), lambda c: c <= key))
    return (group * GROUP + within).cast("long")


def positions(
    records: DataFrame,
    key: str,
    size: str,
    row_id: str,
    order: Sequence[str],
    split_hot: bool = True,
    in_order: bool = False,
) -> tuple[DataFrame, dict]:
    """Every record with its place on the line of all bytes, and the totals.

    Adds ``_range``, ``_sub``, ``_start`` (bytes before it) and ``_row`` (records
    before it). Records are ordered by range, then ``order``; with ``split_hot``
    overfull ranges are cut into ``_sub`` parts first. ``size`` must not be NULL.
    No task sorts more than a few ranges' worth of records unless ``split_hot``
    is off and one key is hot. With ``in_order`` the result's partitions follow
    one another as the ranges do, a bounded number of ranges in each. Input columns
    of the added names are replaced.
    """
    records = records.drop(RANGE, SUB, START, ROW)
    totals = one_row(
        records.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
    )
    n_ranges = parts_for(totals["rows"], ROWS_PER_RANGE, MOST_RANGES)
    cuts = splitters(records, key, size, row_id, n_ranges, totals["bytes"])
    placed = records.withColumn(RANGE, range_of(F.col(key), cuts))
    if split_hot:
        fair = max(1, totals["rows"] // n_ranges)
        counts = placed.groupBy(F.col(RANGE).alias("_r")).agg(F.count("*").alias("_n"))
        folds = stored(counts, "range-counts").select(
            "_r", F.when(F.col("_n") > OVERFULL * fair, F.ceil(F.col("_n") / fair)).otherwise(1).alias("_f")
        )
        sub = F.shiftright(unit_hash(F.col(row_id), SPLIT_SEED) * F.col("_f"), HASH_BITS)
        placed = (
            placed.join(folds, F.col(RANGE) == F.col("_r")).withColumn(SUB, sub).drop("_r", "_f")
        )
    else:
        placed = placed.withColumn(SUB, F.lit(0).cast("long"))
    tallies = placed.groupBy(F.col(RANGE).alias("_r"), F.col(SUB).alias("_s")).agg(
        F.count("*").alias("_n"), F.sum(size).alias("_b")
    )
    # One row per range: at most a few times MOST_RANGES of them.
    before = Window.orderBy("_r", "_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tallies.select(
        "_r",
        "_s",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b0"),
    )
    # A row per range or part of one, a few times MOST_RANGES at most. Without the
    # hint Spark learns that too late, after the records have moved for the join.
    on = (F.col(RANGE) == F.col("_r")) & (F.col(SUB) == F.col("_s"))
    placed = placed.join(F.broadcast(offsets), on).drop("_r", "_s")
    if in_order:
        # Two at least, so that a small table too is placed by more than one task.
        placed = placed.repartitionByRange(max(2, -(-n_ranges // RANGES_TOGETHER)), RANGE)
    inside = Window.partitionBy(RANGE, SUB).orderBy(*order)
    prior = inside.rowsBetween(Window.unboundedPreceding, -1)
    lined = placed.select(
        "*",
        (F.row_number().over(inside) - 1 + F.col("_n0")).cast("long").alias(ROW),
        (F.coalesce(F.sum(size).over(prior), F.lit(0)) + F.col("_b0")).alias(START),
    ).drop("_n0", "_b0")
    return lined, totals


def shard(
    records: DataFrame,
    key: str,
    size: str,
    row_id: str,
    order: Sequence[str],
    shards: int = SHARDS,
) -> DataFrame:
    """Records with ``shard`` (int) and ``slot`` (long, gapless from 0 per shard).

    The shards' bytes differ by less than one record at either end: a record
    goes where its first byte falls when the line of all bytes is cut evenly.
    ``size`` must be positive. An empty table gives no rows; columns named
    ``shard`` or ``slot`` are replaced.
    """
    lined, totals = positions(records.drop("shard", "slot"), key, size, row_id, order)
    number = F.floor(F.col(START) * shards / F.lit(max(1, totals["bytes"]))).cast("int")
    lined = lined.withColumn("shard", F.least(number, F.lit(shards - 1)))
    lined = stored(lined, "sharded")
    firsts = lined.groupBy(F.col("shard").alias("_sh")).agg(F.min(ROW).alias("_first"))
    return (
        lined.join(firsts, F.col("shard") == F.col("_sh"))
        .withColumn("slot", F.col(ROW) - F.col("_first"))
        .drop("_sh", "_first", RANGE, SUB, START, ROW)
    )


def sharded_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard, slot, size and checksum per document, by the law ``bytes``.

    The key is a hash of the text, so equal texts lie side by side unless their
    range is overfull. NULL texts count as empty: size 8, checksum 0. Rows that
    repeat are all placed; ties in every column share a place in any order.
    """
    text = F.coalesce("text", F.lit(""))
    records = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        utf8_crc32("text").alias("text_crc32"),
        unit_hash(text, KEY_SEED, KEY_BITS).alias("text_key"),
    )
    placed = shard(
        stored(records, "shard-records"),
        "text_key",
        "size",
        "doc_id",
        ("text_key", "doc_id", "text_crc32"),
        shards,
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
