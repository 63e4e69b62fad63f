"""Bucketed sliding sum per event, for tables, and the state a stream starts from.

The sum of an event at ``t`` covers its key's buckets that start after the
bucket of ``t - window`` up to its own, the own one only up to the event.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.timefn import bucket_seconds
from tidemill.operators.aggregate import bucket_sums
from tidemill.operators.ordered import ranged_sum, windowed_sum
from tidemill.operators.skew import HOT_ROWS, hot_of_counts, small, split_hot
from tidemill.session import cut


def check_widths(window: int, width: int) -> None:
    if not 0 < width <= window:
        raise ValueError("need 0 < bucket width <= window")


def sliding_running_sum(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    tie_break: Sequence[str],
    window: int,
    width: int,
    name: str = "running_sum",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the sliding sum after each event, events taken in (time, tie-break) order.

    Earlier buckets come from one row per (key, bucket), written with its count in a first pass; the own bucket is a
    running sum inside (key, bucket). Both are partitioned by (key, bucket), so the events are shuffled once. Buckets of
    more than ``hot_rows`` rows go another way: ranges of their order, with the earlier sums joined inside each range,
    so nothing brings such a bucket together.
    """
    check_widths(window, width)
    whole, rest = divmod(window, width)
    # A struct is never NULL, so events without a key join by plain equality too.
    events = df.withColumn("_k", F.struct(key)).withColumn("_b", bucket_seconds(F.col(ts), width))
    sums = cut(events.groupBy("_k", "_b").agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n")))

    def before(buckets: int):
        """Sum of that many buckets just before this one."""
        if buckets == 0:
            return F.lit(0)
        frame = Window.partitionBy("_k").orderBy("_b").rangeBetween(-buckets * width, -width)
        return F.coalesce(F.sum("_s").over(frame), F.lit(0))

    earlier = sums.select("_k", "_b", before(whole - 1).alias("_short"), before(whole).alias("_long"))
    offset = F.unix_timestamp(F.col(f"e.{ts}")) - F.col("e._b")
    before_own = F.when(offset >= rest, F.col("_short")).otherwise(F.col("_long"))
    total = F.col("_own") + F.coalesce(before_own, F.lit(0))
    same = (F.col("e._k") == F.col("p._k")) & (F.col("e._b") == F.col("p._b"))

    def added(running: DataFrame, before_it: DataFrame) -> DataFrame:
        return running.alias("e").join(before_it.alias("p"), same, "left").select(
            *[F.col(f"e.{c}") for c in df.columns], total.cast("bigint").alias(name)
        )

    keys, order = ["_k", "_b"], [ts, *tie_break]
    hot = hot_of_counts(sums, keys, hot_rows)
    if hot is None:
        return added(windowed_sum(events, keys, order, value, "_own"), earlier)
    ordinary, heavy = split_hot(events, keys, hot)
    earlier_of_hot = cut(split_hot(earlier, keys, hot)[1])  # a row per hot bucket
    return added(windowed_sum(ordinary, keys, order, value, "_own"), earlier).unionByName(
        added(ranged_sum(heavy, keys, order, value, "_own"), small(earlier_of_hot))
    )


def bootstrap_cutoff(history: DataFrame, ts: str, width: int, backoff: int = 60) -> dt.datetime | None:
    """Bucket start, as UTC time without zone, up to which the history is taken as complete."""
    seconds = history.agg(F.max(ts).alias("t")).select(
        bucket_seconds(F.timestamp_seconds(F.unix_timestamp("t") - backoff), width)
    ).first()[0]
    return None if seconds is None else dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)


def from_cutoff(events: DataFrame, ts: str, cutoff: dt.datetime) -> DataFrame:
    """Events at or after a time."""
    return events.where(F.col(ts) >= F.lit(cutoff.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))


def bootstrap_state(
    history: DataFrame, key: str, ts: str, value: str, width: int, cutoff: dt.datetime, window: int | None = None
) -> DataFrame:
    """Initial stream state as rows ``key, bucket_start, bucket_sum`` of the history before the cut-off.

    With ``window`` only buckets are kept that some event at or after the
    cut-off can still see; older ones would be dropped by the first event.
    """
    limit = F.lit(cutoff.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    kept = history.where(F.col(ts) < limit)
    if window is not None:
        oldest = bucket_seconds(F.timestamp_seconds(F.unix_timestamp(limit) - window), width)
        kept = kept.where(F.col(ts) >= F.timestamp_seconds(oldest + width))
    return bucket_sums(kept, key, ts, value, width)
