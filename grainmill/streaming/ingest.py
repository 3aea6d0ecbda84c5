"""Structured Streaming ingest (an extension): the same gate and keys on rows as they arrive.

The gate is the batch code, applied to a stream. Repeats within the watermark are dropped by
state that the watermark bounds; repeats of what earlier batches stored are dropped by an
anti-join when a batch is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions import text
from grainmill.operators import selection


def gated(stream: DataFrame, column: str = "text") -> DataFrame:
    """Rows that pass the gate, cleaned, with their key."""
    cleaned = stream.withColumn(column, text.clean(column))
    return cleaned.where(text.quality_ok(column)).where(text.is_sfw(column)).withColumn("key", text.norm_key(column))


def first_in_window(stream: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["key"])


def append_new(path: str):
    """A ``foreachBatch`` writer: the first row of each key that the table at ``path`` does not hold.

    A batch that is run again finds its rows there and adds none.
    """

    def write(batch: DataFrame, _: int) -> None:
        from grainmill.sources import readers

        first = selection.first_wins(batch, "key", ["key", *[c for c in batch.columns if c in ("doc_id", "pos")]])
        spark = batch.sparkSession
        fresh = selection.new_rows(first, spark.read.parquet(path), "key") if readers.exists(spark, path) else first
        fresh.write.mode("append").parquet(path)

    return write


def counts_by_time(stream: DataFrame, time: str, width: str = "1 hour", delay: str = "1 hour", by: str = "source") -> DataFrame:
    """Rows by source in tumbling windows; late rows count until the watermark passes."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), by).agg(F.count(F.lit(1)).alias("n_rows"))
