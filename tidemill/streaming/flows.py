"""Streams built from Spark's own stateful operators.

Each function takes and returns a streaming frame; the caller starts it.
Watermarks bound the state of all but the flows that say otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.parse import space_tokens
from tidemill.operators.latest import latest_value, oldest_per_key


def running_word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Count per word since the start; update or complete mode. State: one row per distinct word."""
    return lines.select(F.explode(space_tokens(F.col(text))).alias("value")).groupBy("value").count()


def running_count(df: DataFrame, *keys: str) -> DataFrame:
    """Count per key since the start. State: one row per distinct key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def view_count(df: DataFrame, view: str = "updates") -> DataFrame:
    """Total count through SQL text on a streaming view; complete mode."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT count(*) AS n FROM {view}")


def _window(ts: str, width: str, slide: str | None) -> Column:
    return (F.window(ts, width, slide) if slide else F.window(ts, width)).alias("window")


def window_counts(
    df: DataFrame, key: str, ts: str, width: str = "60 seconds", slide: str | None = "20 seconds",
    delay: str = "5 minutes",
) -> DataFrame:
    """Rows per key and event-time window; rows of windows behind the watermark are dropped."""
    return df.withWatermark(ts, delay).groupBy(_window(ts, width, slide), key).count()


def window_latest(
    df: DataFrame, key: str, ts: str, value: str, order: list[str],
    width: str = "30 seconds", slide: str | None = "10 seconds", delay: str = "1 minute",
) -> DataFrame:
    """Latest value per key and event-time window."""
    return df.withWatermark(ts, delay).groupBy(key, _window(ts, width, slide)).agg(
        latest_value(value, *order).alias(value)
    )


def window_average(
    df: DataFrame, key: str, ts: str, value: str,
    width: str = "20 seconds", slide: str | None = "10 seconds", delay: str = "1 second",
) -> DataFrame:
    """Average per key and event-time window."""
    return df.withWatermark(ts, delay).groupBy(_window(ts, width, slide), key).agg(F.avg(value).alias("average"))


def latest_map(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """Latest value per key since the start; update mode. State: one row per key."""
    return df.groupBy(key).agg(latest_value(value, *order).alias(value))


def first_seen(df: DataFrame, keys: list[str]) -> DataFrame:
    """First row per key for ever. State: one row per distinct key, never dropped."""
    return df.dropDuplicates(keys)


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First whole row per key by ``order``, whatever order rows arrive in; update mode, as an earlier row may still come.

    State: that row of each key, never dropped.
    """
    return oldest_per_key(df, keys, order)


def first_seen_within(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """First row per key; a key is forgotten once the watermark has passed it by ``delay``."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def clicks_after_impressions(
    impressions: DataFrame, clicks: DataFrame,
    impression_delay: str = "2 hours", click_delay: str = "3 hours", within: str = "1 hour", splits: int = 1,
) -> DataFrame:
    """Clicks on an ad up to ``within`` after its impression, both ends included; append mode.

    Expects ``impression_time, impression_ad_id`` and ``click_time, click_ad_id``.
    The two watermarks and the interval tell Spark when a row can be forgotten.
    Time is part of the join key, in steps of four times ``within``: a click looks
    into its own step and, if the interval begins there, the one before, so an ad's
    rows far apart in time never meet, also within one large batch.
    A stream cannot re-plan an ad that is hot within a step: ``splits`` spreads its
    impressions over that many state partitions and shows every click to all of them.
    """
    shown = impressions.withWatermark("impression_time", impression_delay)
    clicked = clicks.withWatermark("click_time", click_delay)
    condition = (
        f"click_ad_id = impression_ad_id AND click_time >= impression_time "
        f"AND click_time <= impression_time + INTERVAL {within}"
    )
    step = f"(4 * unix_micros(timestamp_micros(0) + INTERVAL {within}))"
    shown = shown.withColumn("_impression_step", F.expr(f"unix_micros(impression_time) div {step}"))
    clicked = clicked.withColumn("_click_step", F.expr(
        f"explode(sequence(unix_micros(click_time - INTERVAL {within}) div {step}, unix_micros(click_time) div {step}))"
    ))
    condition = f"_click_step = _impression_step AND {condition}"
    if splits == 1:
        return shown.join(clicked, F.expr(condition)).drop("_impression_step", "_click_step")
    part = F.pmod(F.xxhash64(*[F.col(c) for c in impressions.columns]), F.lit(splits)).cast("int")
    shown = shown.withColumn("_impression_part", part)
    clicked = clicked.withColumn("_click_part", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    joined = shown.join(clicked, F.expr(f"_click_part = _impression_part AND {condition}"))
    return joined.drop("_impression_part", "_click_part", "_impression_step", "_click_step")


def users_per_window(df: DataFrame, ts: str, user: str, width: str = "10 seconds", delay: str = "10 seconds") -> DataFrame:
    """Distinct users per tumbling window; append mode.

    State is keyed by (window, user), so the users of a busy window are spread
    over all tasks; only counts meet per window. Ends with the watermark.
    """
    return (
        df.where(F.col(user).isNotNull())
        .withWatermark(ts, delay)
        .select(F.window(ts, width).alias("window"), F.col(user).alias("user_id"))
        .dropDuplicates(["window", "user_id"])
        .groupBy("window")
        .agg(F.count(F.lit(1)).alias("distinct_users"))
    )


def users_running(
    df: DataFrame, ts: str, user: str, width: str, delay: str, shards: int = 16
) -> DataFrame:
    """Distinct users of each tumbling window so far, per shard of users; update mode, so every batch reports what it touched.

    A window's users are spread over ``shards`` sets, and its count is the sum over the newest row of each shard
    (:func:`running_totals`). The watermark ends the sets of past windows; users without id don't count.
    """
    shard = F.pmod(F.xxhash64(user), F.lit(shards)).cast("int").alias("shard")
    return (
        df.where(F.col(user).isNotNull())
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("window"), shard)
        .agg(F.size(F.collect_set(user)).cast("bigint").alias("users"))
        .select(F.col("window.start").alias("window_start"), "shard", "users")
    )


def running_totals(rows: DataFrame, batch: str = "batch_id") -> DataFrame:
    """``window_start, users`` and the batch for each window that a batch of :func:`users_running` touched.

    Counts of a shard never fall, so its newest row up to a batch adds what it grew by since the row before.
    """
    before = Window.partitionBy("window_start", "shard").orderBy(batch)
    grown = rows.withColumn("grown", F.col("users") - F.coalesce(F.lag("users").over(before), F.lit(0)))
    per_batch = grown.groupBy("window_start", batch).agg(F.sum("grown").alias("grown"))
    so_far = Window.partitionBy("window_start").orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.select("window_start", batch, F.sum("grown").over(so_far).alias("users"))
