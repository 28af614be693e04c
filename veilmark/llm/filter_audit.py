"""What filters remove in every order, counted by a stream that takes back.

All files arrive as available-now micro-batches. A document fails the filter for
copies if its text occurs with a smaller id anywhere, so what a document counts as
may change when a smaller id arrives later. The stream keeps, per text, the least
id so far and what its holders were counted as; when a smaller one comes, the
earlier holders are taken back from the counters of their part and counted again as
copies. From the counters of which filters a document fails, every order of the
filters follows by arithmetic.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from veilmark.llm.common import importable, map_arrow, parts_for, words_of
from veilmark.session import scratch_path

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")
GOOD, TOXIC = 1 << len(LETTERS), 2 << len(LETTERS)
ORDERS = ["".join(p) for p in permutations(LETTERS)]

TEXTS_PER_BUCKET = 4096
MICRO_BATCHES = 4

# A key is the digest of a text. Rows without one are settled: no later row can
# change what they count as.
KEYED = "bucket long, key binary, doc_id long, part string, flags int, n long"
HELD = pa.schema(
    [
        ("key", pa.binary()),
        ("doc_id", pa.int64()),
        ("part", pa.string()),
        ("flags", pa.int32()),
        ("n", pa.int64()),
    ]
)
DELTAS = "part string, flags int, n long"


def failed_filters(text: Column) -> Column:
    """Bits of the filters A to D that a text fails, by its own words only.

    A: under 50 words; B: fewer than 65% of the words are distinct; C: more than 5%
    capitals; D: holds a marking sign. NULL counts as empty and fails A alone.
    """
    text = F.coalesce(text, F.lit(""))
    words = words_of(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    )
    bits = [F.when(f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(fails)]
    return sum(bits[1:], bits[0]).cast("int")


def judged(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """One slim row per document: bucket, digest of the text, id, part and flags.

    A row of ``labels`` that repeats an id counts once. Documents without an id have
    no label and are spread over the join by their text.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        F.pmod(F.xxhash64(text), F.lit(buckets)).alias("bucket"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        failed_filters(F.col("text")).alias("fails"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(0).alias("spread"),
    )
    known = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("toxic"),
        F.lit(0).cast("long").alias("no_spread"),
    )
    on = (F.col("doc_id") == F.col("label_id")) & (F.col("spread") == F.col("no_spread"))
    marks = F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))
    return slim.join(known, on, "left").select(
        "bucket", "key", "doc_id", "part", (F.col("fails") + marks).cast("int").alias("flags"),
        F.lit(1).cast("long").alias("n"),
    )


def _summed(table: pa.Table) -> pa.Table:
    """Rows that agree in everything but ``n`` become one."""
    keys = [c for c in table.column_names if c != "n"]
    return table.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns(
        {"n_sum": "n"}
    )


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fewer rows before they move: within a batch only the least ids of a text stay.

    A larger id of the same text is a copy whatever comes later, so it becomes a
    settled count; so does a document without an id, which is nobody's copy. A text
    with a third of all rows thus sends a few rows per batch to its bucket.
    """
    names = [c.split()[0] for c in KEYED.split(", ")]
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).select(names)
        ids = rows["doc_id"].combine_chunks()
        keys = pc.dictionary_encode(rows["key"].combine_chunks()).indices.to_numpy()
        given = ids.is_valid().to_numpy(zero_copy_only=False)
        number = pc.fill_null(ids, 0).to_numpy()
        least = np.full(int(keys.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, keys[given], number[given])
        copy = given & (number > least[keys])
        settled = pa.array(copy | ~given)
        flags = rows["flags"].to_numpy() | np.where(copy, COPY, 0).astype(np.int32)
        nothing = pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.int64())
        rows = rows.set_column(1, "key", pc.if_else(settled, nothing[0], rows["key"]))
        rows = rows.set_column(2, "doc_id", pc.if_else(settled, nothing[1], rows["doc_id"]))
        rows = rows.set_column(4, "flags", pa.array(flags, pa.int32()))
        yield from _summed(rows).select(names).combine_chunks().to_batches()


def _packed(held: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(held, HELD, preserve_index=False)
    with pa.ipc.new_stream(sink, HELD, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_all().to_pandas()


def merged(held: pd.DataFrame, new: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The least ids per text after ``new`` rows, and the changes of the counters.

    ``held`` are the holders of the least ids so far and what they were counted as.
    Holders that a smaller id makes copies are taken back and counted again.
    """
    rows = pd.concat([held.assign(old=True), new.assign(old=False)], ignore_index=True)
    copy = (rows["doc_id"] > rows.groupby("key")["doc_id"].transform("min")).to_numpy()
    counted = rows["flags"].to_numpy() | np.where(copy, COPY, 0)
    old = rows["old"].to_numpy()
    taken_back = rows[old & copy]
    changes = pd.concat(
        [
            rows.assign(flags=counted)[~old | copy][["part", "flags", "n"]],
            taken_back.assign(n=-taken_back["n"])[["part", "flags", "n"]],
        ]
    )
    keys = ["key", "doc_id", "part", "flags"]
    return rows[~copy].groupby(keys, as_index=False)["n"].sum(), changes


def retracting(
    bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """Changes of the part counters by the new rows of one bucket of texts.

    The state holds the least id per text of the bucket with the part, flags and
    number of its holders. Frames are merged one after another.
    """
    names = HELD.names
    if state.exists:
        held = _unpacked(state.get[0])
    else:
        held = HELD.empty_table().to_pandas()
    changes = []
    for frame in frames:
        settled = frame["key"].isna()
        changes.append(frame.loc[settled, ["part", "flags", "n"]])
        open_rows = frame.loc[~settled, names].astype({"doc_id": "int64"})
        if len(open_rows):
            held, changed = merged(held, open_rows)
            changes.append(changed)
        total = pd.concat(changes).groupby(["part", "flags"], as_index=False)["n"].sum()
        changes = [total]
    state.update((_packed(held),))
    yield changes[0].query("n != 0").astype({"flags": "int32"})


def counters(docs: DataFrame, labels: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Run a stream of documents to its end: part, flags and number of documents.

    ``docs`` is a streaming DataFrame, ``labels`` a table. ``folder`` keeps the
    stream's checkpoint and the changes of each micro-batch; a batch that runs again
    overwrites its own changes, so calling this again with the same folder after a
    failure goes on where it stopped and counts nothing twice. The state goes to the
    session's state store; it has some 50 bytes per distinct text. ``buckets`` should
    leave a few thousand texts in each.
    """
    spark = docs.sparkSession
    importable(spark)
    slim = map_arrow(judged(docs, labels, buckets), combined, KEYED)
    changes = slim.groupBy("bucket").applyInPandasWithState(
        retracting, DELTAS, "texts binary", "update", "NoTimeout"
    )

    def keep(batch: DataFrame, number: int) -> None:
        total = batch.groupBy("part", "flags").agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    stream = changes.writeStream.outputMode("update").trigger(availableNow=True)
    stream = stream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(keep)
    stream.start().awaitTermination()
    try:
        kept = spark.read.schema(DELTAS).parquet(f"{folder}/changes")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        # No file came in, so there was no batch.
        kept = spark.createDataFrame([], DELTAS)
    return kept.groupBy("part", "flags").agg(F.sum("n").alias("n")).where("n <> 0")


def _steps() -> Column:
    """Every step of every order: its letter's bit and the bits before it."""
    rows = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            rows.append({"filter_order": order, "step": step, "bit": bit, "before": before})
            before |= bit
    kind = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    return F.explode(F.from_json(F.lit(json.dumps(rows)), kind))


def interactions(counted: DataFrame) -> DataFrame:
    """Per part, order and step what the step's filter does, from the counters.

    A part has at most 32 sums, one per set of failed filters, so they travel as one
    list and only the answer has a row per step. Over all 120 orders a document
    is removed by each of its k failed filters equally often, 120 / k times.
    """
    fails = F.col("flags").bitwiseAND((1 << len(LETTERS)) - 1)
    marked = {"good": GOOD, "toxic": TOXIC}
    sums = [F.sum("n").alias("n")] + [
        F.sum(F.when(F.col("flags").bitwiseAND(bit) > 0, F.col("n")).otherwise(0)).alias(name)
        for name, bit in marked.items()
    ]
    by_fails = counted.groupBy("part", fails.alias("fails")).agg(*sums)
    lists = by_fails.groupBy("part").agg(
        F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets")
    )
    steps = lists.select("part", "sets", _steps().alias("at"))

    def total(field: str, condition) -> Column:
        zero = F.lit(0).cast("long")
        value = lambda s: F.when(condition(s["fails"]), s[field]).otherwise(zero)
        return F.aggregate("sets", zero, lambda acc, s: acc + value(s))

    bit, before = F.col("at.bit"), F.col("at.before")
    own = lambda m: m.bitwiseAND(bit) > 0
    here = lambda m: own(m) & (m.bitwiseAND(before) == 0)
    shares = F.aggregate(
        "sets",
        F.lit(0).cast("long"),
        lambda acc, s: acc
        + F.when(
            own(s["fails"]),
            (F.lit(len(ORDERS)) / F.bit_count(s["fails"])).cast("long") * s["n"],
        ).otherwise(F.lit(0).cast("long")),
    )
    return steps.select(
        "part",
        "at.filter_order",
        "at.step",
        total("n", lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: own(m) & (m.bitwiseAND(before) > 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        shares.alias("shapley"),
    )


def filter_audit(spark: SparkSession, sf_dir: str, batches: int = MICRO_BATCHES) -> DataFrame:
    """The audit of all files of ``documents``, in about ``batches`` micro-batches.

    One row per part, order of the five filters and step. NULL texts are empty, a
    NULL source is the part ``''``. Documents without an id are no copies, make none
    and have no labels; rows that repeat id and text are no copies of each other. An
    empty table has no parts and no rows. Other columns are not read.
    """
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    per_batch = -(-len(table.inputFiles()) // batches)
    # A pattern, as a streaming source takes a plain path for a folder.
    docs = (
        spark.readStream.schema(table.schema)
        .option("maxFilesPerTrigger", max(1, per_batch))
        .parquet(f"{sf_dir}/{{documents}}.parquet")
    )
    buckets = parts_for(table.count(), TEXTS_PER_BUCKET, 1 << 30)
    counted = counters(docs, labels, scratch_path(spark, "filter-audit"), buckets)
    return interactions(counted)
