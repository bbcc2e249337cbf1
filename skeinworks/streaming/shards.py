"""Append-only streams: rows that arrive once or twice are stored once, in folders by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_table(spark: SparkSession, path: str, schema: StructType, max_files: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def store_once(rows: DataFrame, key: list[str], event_time: str, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """Rows of a stream stored once for each key; a repeat within delay of its first arrival is dropped.

    State is bounded by the watermark. Each micro-batch writes a folder named by its number and overwrites it
    when it is run again after a failure, so the result holds every batch exactly once.
    """
    once = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return once.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(rows: DataFrame, event_time: str, delay: str, width: str, key: str) -> DataFrame:
    """Rows of each key in tumbling windows of event time; windows are closed by the watermark."""
    return rows.withWatermark(event_time, delay).groupBy(F.window(event_time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
