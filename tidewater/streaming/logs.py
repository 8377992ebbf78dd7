"""Append-only logs as streams: new files are taken up, repeated keys dropped, finished jobs resumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def log_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def first_per_key(stream: DataFrame, keys: list[str], event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """One event of each key, the first to arrive; with an event time, keys are forgotten once they are later than `late`."""
    if event_time is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(keys)


def rates(stream: DataFrame, event_time: str, key: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Events of each key in tumbling windows, final once the watermark has passed."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def drain(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Everything there is now, once, to Parquet; the next call goes on where this one ended."""
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)


def first_so_far(stream: DataFrame, keys: list[str], order: str, event_time: str, late: str = "1 day") -> DataFrame:
    """(keys, first, n): of each key the smallest `order` and the events so far, final once the watermark has passed the key's day."""
    day = F.window(event_time, "1 day")
    return stream.withWatermark(event_time, late).groupBy(day.alias("w"), *keys).agg(F.min(order).alias("first"), F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "first", "n")
