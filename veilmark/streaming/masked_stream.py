"""Masked copies of streams: the batch projection on a streaming DataFrame.

Masks keep no state, so there is no watermark and nothing to shuffle. The
file sink records finished batches in the checkpoint folder, which makes a
restart after a lost executor or driver continue without gaps or repeats.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from veilmark.operators.masking import masked


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files that arrive below ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_masked_export(
    stream: DataFrame,
    table: str | Mapping[str, str],
    tier: str,
    path: str,
    checkpoint: str,
    salt: str | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Write the masked stream to Parquet: all that is there, or on and on."""
    writer = (
        masked(stream, table, tier, salt)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()
