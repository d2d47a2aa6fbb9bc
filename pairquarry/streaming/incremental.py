"""Resumable ingestion as a stream of files that stops when it has caught up; the checkpoint holds what was read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def event_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(path)


def first_seen(events: DataFrame, keys: list[str], time_col: str, delay: str = "1 day") -> DataFrame:
    """Events without repeats of a key within the delay; state of older keys is dropped with the watermark."""
    return events.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def catch_up(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that is new to a Parquet table, then stop. Run again, it takes up where it stopped."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def catch_up_batches(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
