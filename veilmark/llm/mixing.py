"""Mixing sources to target weights by Pfair scheduling.

Documents of a source are shuffled by a hash and cut into blocks; every slot of
the mix takes one block. In the fluid mix all sources advance by their weights
until they run out, and the rest share the time. A block's window runs from the
slot in which its fluid part begins (its release) to the one in which it ends (its
deadline). Earliest-deadline-first over the released blocks of the whole mix keeps
every source less than one block from the fluid mix of the unrounded weights at
every slot, and places every document once.

Which block comes next depends on all before it, so the slots are dealt in one
loop, on the driver. It sees a number of blocks per source and no documents, holds
two entries per source and writes the slots out in pieces.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator, Mapping, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilmark.llm.common import PACKED, packed, stored, unpacked
from veilmark.llm.sharding import HASH_BITS, unit_hash
from veilmark.session import scratch_path

BLOCK_DOCS = 16
SLOTS_PER_PIECE = 1 << 19
# A window opens this much late rather than early, for the rounding of doubles.
LATE = 1 - 1e-12
ROWS_PER_BUCKET = 1024
MOST_BUCKETS = 65536
ORDER_SEED = 59


def source_key(source: str) -> Column:
    """NULL is a source of its own, apart from the empty name."""
    name = F.col(source).cast("string")
    return F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), name))


def _weights(
    names: Sequence[str], docs: Sequence[int], weights: Mapping[str | None, float] | None, period
) -> list[float]:
    """Weight of every source; blocks per period if there is one."""
    if weights is None:
        found = [math.sqrt(n) for n in docs]
    else:
        if not all(0 < w < math.inf for w in weights.values()):
            raise ValueError("weights must be positive")
        by_key = {"-" if name is None else "=" + name: float(w) for name, w in weights.items()}
        found = [by_key.get(name, 1.0) for name in names]
    if period is None:
        return found
    total = math.fsum(found)
    return [float(max(1, math.floor(w / total * period + 0.5))) for w in found]


def served(blocks: Sequence[int], weights: Sequence[float]) -> Iterator[int]:
    """Index of the source served in each slot, by earliest deadline.

    Times are levels of the fluid mix: at level v a source has got
    min(weight * v, blocks), so its block k has the window k / weight to
    (k + 1) / weight. A block is released in the first slot that ends above the
    level at which its window begins; equal deadlines go to the first source.
    """
    n = len(blocks)
    ends = sorted((blocks[i] / weights[i], i) for i in range(n))
    speeds = [0.0] * (n + 1)
    for j in range(n - 1, -1, -1):
        speeds[j] = speeds[j + 1] + weights[ends[j][1]]
    pending = [(0.0, i, 0) for i in range(n)]
    ready: list[tuple[float, int, int]] = []
    gone, level, reached = 0, 0.0, 0.0
    for slot in range(sum(blocks)):
        while gone < n:
            after = reached + (ends[gone][0] - level) * speeds[gone]
            if after > slot + 1:
                break
            level, reached, gone = ends[gone][0], after, gone + 1
        if gone < n:
            now = (level + (slot + 1 - reached) / speeds[gone]) * LATE
        else:
            now = math.inf
        while pending and (pending[0][0] < now or not ready):
            _, i, k = heapq.heappop(pending)
            heapq.heappush(ready, ((k + 1) / weights[i], i, k))
        due, i, k = heapq.heappop(ready)
        if k + 1 < blocks[i]:
            heapq.heappush(pending, (due, i, k + 1))
        yield i


def schedule(
    spark: SparkSession, names: Sequence[str], blocks: Sequence[int], weights: Sequence[float]
) -> DataFrame:
    """``src``, ``mix_block`` and ``mix_slot`` of every block, stored piece by piece."""
    path = scratch_path(spark, "mix-schedule")
    schema = "src string, mix_block long, mix_slot long"
    spark.createDataFrame([], schema).write.parquet(path)
    sources = served(blocks, weights)
    done = np.zeros(len(blocks), np.int64)
    first = 0
    while piece := array("q", islice(sources, SLOTS_PER_PIECE)):
        chosen = np.frombuffer(piece, np.int64)
        # Blocks of a source follow one another: its place among its own, after those done.
        order = np.argsort(chosen, kind="stable")
        counts = np.bincount(chosen, minlength=len(blocks))
        before = np.cumsum(counts) - counts
        block = np.empty(len(chosen), np.int64)
        block[order] = np.arange(len(chosen)) - before[chosen[order]] + done[chosen[order]]
        done += counts
        slots = np.arange(first, first + len(chosen))
        rows = pa.table(
            [pa.array(names, pa.string()).take(pa.array(chosen)), pa.array(block), pa.array(slots)],
            ["src", "mix_block", "mix_slot"],
        )
        spark.createDataFrame(rows).write.mode("append").parquet(path)
        first += len(chosen)
    return spark.read.schema(schema).parquet(path)


def mix(
    docs: DataFrame,
    source: str = "source",
    row_id: str = "doc_id",
    weights: Mapping[str | None, float] | None = None,
    block_docs: int = BLOCK_DOCS,
    period: int | None = None,
    seed: int = ORDER_SEED,
) -> DataFrame:
    """All rows with their place in the mix.

    Adds ``mix_block`` (the block of its source), ``mix_slot`` (the block's place
    among all) and ``mix_pos`` (place in the block), replacing columns of these
    names and no others. ``weights`` are relative and positive; sources that it does not name
    have weight 1; without it a source's weight is the square root of its rows.
    Weights count as they are; with ``period`` they are first rounded to whole
    blocks, at least one, in so many.
    NULL is a source of its own; every row is placed, repeated rows too, and an
    empty table gives no rows. Rows of one source are ordered by a hash of
    ``row_id``, then by it.
    """
    rows = packed(docs).withColumns(
        {"_source": F.col(PACKED)[source], "_id": F.col(PACKED)[row_id]}
    )
    keyed = rows.withColumn("_src", source_key("_source"))
    counts = stored(
        keyed.groupBy(F.col("_src").alias("src")).agg(F.count("*").alias("n_docs")), "mix-counts"
    )
    sources = sorted((r["src"], r["n_docs"]) for r in counts.collect())
    names, n_docs = [s for s, _ in sources], [n for _, n in sources]
    n_rows = sum(n_docs)
    plan = schedule(
        docs.sparkSession,
        names,
        [-(-n // block_docs) for n in n_docs],
        _weights(names, n_docs, weights, period),
    )

    # Ranks within a source: buckets by hash, so that a hot source has many.
    per_bucket = max(ROWS_PER_BUCKET, n_rows // MOST_BUCKETS)
    folds = counts.select("src", F.ceil(F.col("n_docs") / per_bucket).alias("_k"))
    hashed = (
        keyed.withColumn("_h", unit_hash(F.col("_id"), seed))
        .join(folds, F.col("_src") == F.col("src"))
        .withColumn("_b", F.shiftright(F.col("_h") * F.col("_k"), HASH_BITS))
        .drop("src", "_k")
    )
    tallies = hashed.groupBy(F.col("_src").alias("s"), F.col("_b").alias("b")).agg(
        F.count("*").alias("n")
    )
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tallies.select(
        "s", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n0")
    )
    inside = Window.partitionBy("_src", "_b").orderBy("_h", "_id")
    ranked = hashed.withColumn("_rank", F.row_number().over(inside) - 1)
    ranked = ranked.join(
        offsets, (F.col("_src") == F.col("s")) & (F.col("_b") == F.col("b"))
    ).withColumn("_rank", F.col("_rank") + F.col("_n0"))

    placed = ranked.withColumn("_k", F.floor(F.col("_rank") / block_docs)).join(
        plan, (F.col("_src") == F.col("src")) & (F.col("_k") == F.col("mix_block"))
    )
    return placed.select(
        *unpacked(placed, ("mix_block", "mix_slot", "mix_pos")),
        "mix_block",
        "mix_slot",
        (F.col("_rank") - F.col("_k") * block_docs).cast("int").alias("mix_pos"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source")).select(
        "doc_id", "source", "mix_block", "mix_slot", "mix_pos"
    )


def in_mix_order(mixed: DataFrame, parts: int) -> DataFrame:
    """Rows laid out in files by slot, each file sorted.

    The mix is the files in order of their names, row by row. Spark's reader packs
    files by size instead; `mix` over the same rows gives their places again.
    """
    ordered = mixed.repartitionByRange(parts, "mix_slot")
    return ordered.sortWithinPartitions("mix_slot", "mix_pos").drop(
        "mix_block", "mix_slot", "mix_pos"
    )
