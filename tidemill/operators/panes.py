"""Sliding-window aggregates of tables, built from panes.

Rows are first combined into panes of one slide; a pane is then counted in
every window that covers it. Raw rows are never copied per window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.timefn import bucket_seconds


def _expand(panes: DataFrame, width: int, slide: int) -> DataFrame:
    starts = F.sequence(F.col("_pane") - (width - slide), F.col("_pane"), F.lit(slide))
    return panes.withColumn("window_start_s", F.explode(starts))


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    width: int,
    slide: int,
    pane_aggs: Mapping[str, Column],
    merge_aggs: Mapping[str, Column],
) -> DataFrame:
    """Aggregate per key and window ``[start, start + width)``; seconds, ``width`` a multiple of ``slide``.

    ``pane_aggs`` run on rows, ``merge_aggs`` on the columns those produce.
    """
    if width % slide:
        raise ValueError("width must be a multiple of slide")
    panes = (
        df.where(F.col(ts).isNotNull())
        .withColumn("_pane", bucket_seconds(F.col(ts), slide))
        .groupBy(*keys, "_pane")
        .agg(*[column.alias(name) for name, column in pane_aggs.items()])
    )
    return (
        _expand(panes, width, slide)
        .groupBy(*keys, "window_start_s")
        .agg(*[column.alias(name) for name, column in merge_aggs.items()])
        .withColumn("window_start", F.timestamp_seconds("window_start_s"))
        .drop("window_start_s")
    )


def sliding_count(df: DataFrame, keys: Sequence[str], ts: str, width: int, slide: int) -> DataFrame:
    return sliding(df, keys, ts, width, slide, {"_n": F.count(F.lit(1))}, {"n": F.sum("_n")})


def sliding_latest(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, order: Sequence[str], width: int, slide: int
) -> DataFrame:
    """Latest value per key and window."""
    newest = F.max_by(F.struct(F.struct(*order).alias("at"), F.col(value).alias("v")), F.struct(*order))
    return sliding(
        df, keys, ts, width, slide, {"_last": newest}, {value: F.max_by(F.col("_last.v"), F.col("_last.at"))}
    )


def sliding_average(df: DataFrame, keys: Sequence[str], ts: str, value: str, width: int, slide: int) -> DataFrame:
    """Average of a whole-number column per key and window."""
    return sliding(
        df, keys, ts, width, slide,
        {"_sum": F.sum(F.col(value).cast("bigint")), "_n": F.count(value)},
        {"average": F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))},
    )
