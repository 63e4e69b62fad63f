"""Parquet laid out for look-ups by a key and a range of a second one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group: what a look-up reads at least.
ROW_GROUP = 8 << 20


def write_sorted(df: DataFrame, path: str, key: str, sort_key: str, files: int, distinct_keys: int, row_group: int = ROW_GROUP) -> None:
    """Rows ranged over ``files`` by (key, sort key), sorted inside, with a bloom filter on the key.

    A key on very many rows fills several files, as ranges go by both keys. The scan skips files and row groups by their
    bounds; where a key lies between bounds but is absent, the filter skips them too. ``distinct_keys`` sizes the filter
    of a row group.
    """
    ranged = df.repartitionByRange(files, key, sort_key).sortWithinPartitions(key, sort_key)
    (
        ranged.write.option("parquet.block.size", row_group)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", distinct_keys)
        .parquet(path)
    )


def rows_of_key(spark: SparkSession, path: str, key: str, value, within: Column | None = None) -> DataFrame:
    """Rows of one key, of those for which ``within`` holds; both conditions reach the scan."""
    rows = spark.read.parquet(path).where(F.col(key) == F.lit(value))
    return rows if within is None else rows.where(within)
