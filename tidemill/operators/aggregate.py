"""Counts, top-k and sums per bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.timefn import time_bucket


def word_count(df: DataFrame, tokens: Column, drop_empty: bool = False) -> DataFrame:
    """Occurrences of each token as ``word, count``."""
    exploded = df.select(F.explode(tokens).alias("word"))
    if drop_empty:
        exploded = exploded.where(F.length("word") > 0)
    return exploded.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_k(df: DataFrame, k: int, by: str = "count", tie_break: Sequence[str] = ("word",)) -> DataFrame:
    """The ``k`` rows with the greatest ``by``; each task keeps only its own best k."""
    return df.orderBy(F.desc(by), *tie_break).limit(k)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows of a stated order."""
    return df.orderBy(*order).limit(n)


def count_per(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def bounds(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """Smallest and largest value, of the whole frame or per key."""
    return df.groupBy(*keys).agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def bucket_sums(df: DataFrame, key: str, ts: str, value: str, width: int) -> DataFrame:
    """Sum per key and time bucket as ``key, bucket_start, bucket_sum``."""
    return df.groupBy(key, time_bucket(F.col(ts), width).alias("bucket_start")).agg(
        F.sum(value).alias("bucket_sum")
    )
