"""Helpers that several operators share."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
SPACE = r"[\x20\x09-\x0D]+"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here.

    A later stage that loses an executor reads files instead of computing the
    rows anew, and every reader sees the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    if (noted := _noted.get()) is not None:
        noted.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def noted_paths() -> Iterator[list[str]]:
    """The paths that `stored` writes to meanwhile in this thread, for `removed`."""
    paths: list[str] = []
    token = _noted.set(paths)
    try:
        yield paths
    finally:
        _noted.reset(token)


def removed(spark: SparkSession, paths: Iterable[str]) -> None:
    """Stored tables deleted that nothing reads any more, wherever the folder is."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once per row and use it often in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


PACKED = "packed_row"


def packed(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows as one column, so that no name of theirs can meet a helper's."""
    names = docs.columns if columns is None else columns
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias(PACKED))


def unpacked(docs: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    """The columns of `packed` rows, without those named in ``but``."""
    names = docs.schema[PACKED].dataType.names
    return [F.col(PACKED)[c].alias(c) for c in names if c.lower() not in but]


def words_of(text: Column) -> Column:
    """Words of a text as an array; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def utf8_crc32(text: str) -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def parts_for(rows: int, per_part: int, most: int = 65536) -> int:
    """How many parts a table of so many rows is dealt into."""
    return max(1, min(most, -(-rows // per_part)))


def lowest(df: DataFrame, rank: Column, n: int) -> DataFrame:
    """The ``n`` rows of lowest rank, ties cut off; only ranks are sorted.

    ``rank`` is a hash of the row, so these are a sample that stays the same.
    """
    ranked = df.withColumn("_rank", rank)
    last = ranked.select("_rank").orderBy("_rank").limit(n).agg(F.max("_rank")).first()[0]
    if last is None:
        return df.limit(0)
    return ranked.where(F.col("_rank") <= last).limit(n).drop("_rank")


def one_row(df: DataFrame) -> dict:
    """The only row of an aggregate over a whole table."""
    return df.first().asDict()


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it.

    Enough for local sessions and shared installations; on other clusters the
    package is installed or sent along like any job's code.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def map_arrow(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(function, schema)


SLICE_BYTES = 2 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, at_once: int = SLICE_BYTES) -> Iterator[None]:
    """What runs meanwhile sends rows to Python by so many bytes, or one row at a time.

    The batches stand in the JVM, in buffers of up to twice their size, and in Python.
    """
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(at_once))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def with_arrow_columns(
    df: DataFrame,
    fields: T.StructType,
    make: Callable[[pa.RecordBatch], list[pa.Array]],
    by: str | None = "text",
    at_once: int = SLICE_BYTES,
    without: tuple[str, ...] = (),
) -> DataFrame:
    """All rows with added columns, computed batch by batch in Python.

    Columns of the added names are replaced, the others pass through, except those
    named in ``without``: Spark cannot tell that a column is not wanted back, so one
    dropped afterwards is copied to the JVM first. Batches are cut to about ``at_once``
    bytes of the column ``by``.
    """
    added = [f.name for f in fields]
    gone = {name.lower() for name in (*added, *without)}
    kept = [f for f in df.schema if f.name.lower() not in gone]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, by, at_once) if by else batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, *make(batch)], names=[*names, *added])

    return map_arrow(df, run, T.StructType([*kept, *fields]))


def sliced(
    batches: Iterator[pa.RecordBatch], column: str = "text", at_once: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``at_once`` bytes of text, or of one row.

    What a batch is turned into can be many times its size.
    """
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes) // at_once
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end > start:
                yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; NULL counts as empty."""
    values = batch.column(batch.schema.get_field_index(column)).to_pylist()
    return ["" if v is None else v for v in values]


def list_array(rows: list, kind: pa.DataType, dtype: type) -> pa.Array:
    """A list array of numeric rows, without a Python object per element."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    flat = np.concatenate([np.asarray(r, dtype) for r in rows]) if rows else np.empty(0, dtype)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(dtype), kind))
