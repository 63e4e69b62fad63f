"""Distinct users per segment and time window.

Users are kept as rows ``(user_type, window_s, start, user)``, never as one
array per window, so a window with most of the users is still spread over all
tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.predicates import Segment
from tidemill.functions.timefn import time_bucket

WINDOW = ["user_type", "window_s", "start_time"]
#: Segments per bit column: those of a long but its sign.
_BITS = 63
USER_ROWS = "user_type string, window_s int, start_time timestamp, user_id string"


def user_bits(
    df: DataFrame, segments: Sequence[Segment], windows: Sequence[int], ts: str, user: str
) -> DataFrame:
    """``window_s, start_time, user_id`` and the segments of each event, one bit each, 63 to a column.

    Events are copied per window width, not per series; those without a user id are left out. Rows repeat: see
    :func:`distinct_users`.
    """
    words = _words(segments)

    def bits(part: Sequence[Segment]) -> Column:
        held = F.lit(0).cast("bigint")
        for position, segment in enumerate(part):
            held = held + F.when(segment.predicate, F.lit(1 << position).cast("bigint")).otherwise(0)
        return held

    starts = F.array(*[
        F.struct(F.lit(w).alias("window_s"), time_bucket(F.col(ts), w).alias("start_time")) for w in windows
    ])
    return (
        df.select(
            F.col(user).cast("string").alias("user_id"), *[bits(part).alias(n) for n, part in words.items()],
            F.explode(starts).alias("w"),
        )
        .where(F.col("user_id").isNotNull() & (F.greatest(F.lit(0), *words) > 0))
        .select("w.window_s", "w.start_time", "user_id", *words)
    )


def kept_bits(users: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """Rows of :func:`segment_users` as those of :func:`user_bits`."""
    def bit(part: Sequence[Segment]) -> Column:
        held = F.lit(0).cast("bigint")
        for position, segment in enumerate(part):
            held = F.when(F.col("user_type") == segment.name, F.lit(1 << position).cast("bigint")).otherwise(held)
        return held

    return users.select("window_s", "start_time", "user_id", *[bit(part).alias(n) for n, part in _words(segments).items()])


def distinct_users(bits: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """Distinct ``user_type, window_s, start_time, user_id`` rows of :func:`user_bits`, of one or of several sets of users.

    Bits are merged per (window, user), map-side too, and only then does a row become one row per segment: a task holds
    one row per window and user, whatever the segments, and none of them twice.
    """
    words = _words(segments)
    merged = bits.groupBy("window_s", "start_time", "user_id").agg(*[F.bit_or(n).alias(n) for n in words])

    def named(column: str, part: Sequence[Segment]) -> Column:
        return F.filter(F.array(*[F.lit(s.name) for s in part]), lambda _, i: F.getbit(F.col(column), i) == 1)

    held = F.concat(*[named(n, part) for n, part in words.items()])
    return merged.select(F.explode(held).alias("user_type"), "window_s", "start_time", "user_id")


def _words(segments: Sequence[Segment]) -> dict[str, Sequence[Segment]]:
    return {f"_bits{i}": segments[at:at + _BITS] for i, at in enumerate(range(0, len(segments), _BITS))}


def segment_users(
    df: DataFrame, segments: Sequence[Segment], windows: Sequence[int], ts: str, user: str
) -> DataFrame:
    """Distinct ``user_type, window_s, start_time, user_id`` rows in one pass; events without a user id are not counted."""
    return distinct_users(user_bits(df, segments, windows, ts, user), segments)


def count_users(users: DataFrame) -> DataFrame:
    """Users per window; expects distinct rows, so a plain count is enough."""
    return users.groupBy(*WINDOW).agg(F.count(F.lit(1)).alias("distinct_users"))


def segment_distinct(
    df: DataFrame, segments: Sequence[Segment], windows: Sequence[int], ts: str, user: str
) -> DataFrame:
    """Distinct users of every segment, width and window."""
    return count_users(segment_users(df, segments, windows, ts, user))


def union_series(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all of aggregates by column name."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def merge_users(new: DataFrame, kept: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """New and kept rows of :func:`user_bits` as one set of users: what a full outer join of user sets gives.

    Both meet before they are aggregated, in one shuffle.
    """
    return distinct_users(kept.unionByName(new), segments)


def latest_windows(windows: DataFrame) -> DataFrame:
    """Latest start per (segment, width): the windows still open.

    One row per series, so at most segments times widths.
    """
    return windows.groupBy("user_type", "window_s").agg(F.max("start_time").alias("start_time"))


def latest_segment_windows(
    df: DataFrame, segments: Sequence[Segment], windows: Sequence[int], ts: str, user: str
) -> DataFrame:
    """:func:`latest_windows` of a whole table straight from its rows.

    One global aggregate, without the shuffle by user that the counts need.
    """
    seen = df.where(F.col(user).isNotNull()).agg(
        *[F.max(F.when(s.predicate, F.col(ts))).alias(f"t{i}") for i, s in enumerate(segments)]
    )
    series = F.array(*[
        F.struct(F.lit(s.name).alias("user_type"), F.lit(w).alias("window_s"), time_bucket(F.col(f"t{i}"), w).alias("start_time"))
        for i, s in enumerate(segments) for w in windows
    ])
    return seen.select(F.explode(series).alias("s")).select("s.*").where(F.col("start_time").isNotNull())


def closed(windows: DataFrame, latest: DataFrame) -> DataFrame:
    """Windows that are not the latest of their series."""
    return windows.join(F.broadcast(latest), WINDOW, "left_anti")


def still_open(windows: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows of the latest windows."""
    return windows.join(F.broadcast(latest), WINDOW, "left_semi")


def drop_behind(windows: DataFrame, latest: DataFrame) -> DataFrame:
    """Without rows of windows before the latest known one: those were already reported."""
    known = latest.withColumnRenamed("start_time", "_known")
    return (
        windows.join(F.broadcast(known), ["user_type", "window_s"], "left")
        .where(F.col("_known").isNull() | (F.col("start_time") >= F.col("_known")))
        .drop("_known")
    )


def metric_points(counts: DataFrame, prefix: str = "events") -> DataFrame:
    """Gauge points at the window end, tagged with the segment."""
    return counts.select(
        F.concat(F.lit(f"{prefix}.distinct.count."), F.col("window_s").cast("string"), F.lit("s")).alias("metric"),
        F.timestamp_seconds(F.unix_timestamp("start_time") + F.col("window_s")).alias("ts"),
        F.col("distinct_users").cast("double").alias("value"),
        F.concat(F.lit("user_type:"), F.col("user_type")).alias("tags"),
    )


def users_per_bucket(df: DataFrame, ts: str, user: str, width: int) -> DataFrame:
    """Distinct users per time bucket, for tables."""
    return (
        df.where(F.col(user).isNotNull())
        .select(time_bucket(F.col(ts), width).alias("start_time"), F.col(user).alias("user_id"))
        .distinct()
        .groupBy("start_time")
        .agg(F.count(F.lit(1)).alias("distinct_users"))
    )
