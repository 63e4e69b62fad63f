"""Generated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def rate_stream(spark: SparkSession, rows_per_second: int = 1, partitions: int | None = None) -> DataFrame:
    """Stream of ``timestamp, value`` at a fixed rate."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return reader.load()


def number_range(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    """``id`` from ``start`` to ``end`` exclusive."""
    return spark.range(start, end, 1, partitions)
