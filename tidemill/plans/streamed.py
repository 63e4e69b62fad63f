"""Streaming jobs over tables that arrive in parts; the emitted rows are the result.

A part is written, the job runs until it has read it and stops; for the next part it starts again from its checkpoint.
So every result below depends on state carried over micro-batches and restarts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators import cluster, sliding, user_aggregate
from tidemill.operators.joins import with_static
from tidemill.operators.latest import newest_per_key
from tidemill.plans import feeds, inputs, relational, timed
from tidemill.session import scratch_path, use_rocksdb
from tidemill.sources.batches import BatchFolder
from tidemill.sources.changelog import ChangeLog
from tidemill.sources.tables import raw_table, table, zoned, zoneless
from tidemill.streaming import flows, idle, sinks
from tidemill.streaming import tables as jobs
from tidemill.streaming.sliding_state import SlidingSumTable, sliding_sum_stream


#: Parts in which a table arrives.
PARTS = 5


class Feed:
    """A table that arrives in :data:`PARTS` parts, by equal steps of a column; nulls are in the first."""

    def __init__(self, spark, folder, name: str, order: str, parts: int = PARTS):
        self.spark, self.order = spark, order
        self.source = raw_table(spark, folder, name)
        self.path = scratch_path(spark, f"feed-{name}")
        low, high = self.source.agg(F.min(order), F.max(order)).first()
        bounds = [] if low is None else [low + (high - low) * i // parts for i in range(1, parts)]
        self.ranges = list(zip([None, *bounds], [*bounds, None]))
        self._write(0)

    def _bound(self, value) -> Column:
        return F.lit(str(value)).cast(self.source.schema[self.order].dataType)

    def _write(self, part: int) -> None:
        (low, high), column, rows = self.ranges[part], F.col(self.order), self.source
        if low is not None:
            rows = rows.where(column >= self._bound(low))
        if high is not None:
            before = column < self._bound(high)
            rows = rows.where(before | column.isNull() if part == 0 else before)
        rows.write.mode("append").parquet(self.path)

    def stream(self, files: int | None = None) -> DataFrame:
        """The table as a stream, of at most so many files a batch."""
        reader = self.spark.readStream.schema(self.source.schema)
        return zoned((reader.option("maxFilesPerTrigger", files) if files else reader).parquet(self.path))

    def arrivals(self) -> Iterator[int]:
        """Part numbers, each once its rows are there."""
        yield 0
        for part in range(1, len(self.ranges)):
            self._write(part)
            yield part


class Events(Feed):
    """The events in order of time, or of another column."""

    def __init__(self, spark, folder, order: str = "ts", parts: int = PARTS):
        super().__init__(spark, folder, "events", order, parts)

    def stream(self, files: int | None = None) -> DataFrame:
        return super().stream(files).withColumn("cents", inputs.cents("value"))


def _emitted(feed: Feed, df: DataFrame) -> DataFrame:
    """Rows of an append-mode stream."""
    base = scratch_path(feed.spark, "stream")
    for _ in feed.arrivals():
        writer = df.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint")
        sinks.triggered(writer).start().awaitTermination()
    return feed.spark.read.schema(df.schema).parquet(f"{base}/rows")


def _final(feed: Feed, df: DataFrame, keys: list[str], mode: str = "update") -> DataFrame:
    """Last row emitted per key of an update-mode stream."""
    return newest_per_key(_by_batch(feed, df, mode), keys, ["batch_id"]).drop("batch_id")


def _by_batch(feed: Feed, df: DataFrame, mode: str = "update") -> DataFrame:
    """All rows emitted, with the batch of each; a repeated batch replaces its rows."""
    base = scratch_path(feed.spark, "stream")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{base}/rows/batch={batch_id}")

    _run(feed, df, keep, base, mode)
    schema = df.withColumn("batch_id", F.lit(0)).schema
    return feed.spark.read.option("recursiveFileLookup", True).schema(schema).parquet(f"{base}/rows")


def _run(feed: Feed, df: DataFrame, handle: Callable[[DataFrame, int], None], base: str, mode: str = "append") -> None:
    for _ in feed.arrivals():
        sinks.each_batch(df, handle, f"{base}/checkpoint", mode).awaitTermination()


def _starts(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.col("window.start")).drop("window")


# -- Spark's own stateful operators --------------------------------------------


def stream_word_count(spark, folder):
    feed = Feed(spark, folder, "documents", "doc_id")
    return _final(feed, flows.running_word_count(feed.stream(), "text"), ["value"])


def stream_counts_by_type(spark, folder):
    feed = Events(spark, folder)
    return _final(feed, flows.running_count(feed.stream(), "event_type"), ["event_type"], "complete")


def stream_window_count(spark, folder):
    feed = Events(spark, folder)
    counted = flows.window_counts(feed.stream(), "event_type", "ts", "1 hour", "20 minutes", "1 hour")
    return zoneless(_final(feed, _starts(counted).withColumnRenamed("count", "n"), ["event_type", "window_start"]))


def stream_latest_per_sliding(spark, folder):
    feed = Events(spark, folder)
    latest = flows.window_latest(
        feed.stream(), "event_type", "ts", "cents", ["ts", "event_id"], "1 hour", "20 minutes", "1 hour"
    )
    return zoneless(_final(feed, _starts(latest), ["event_type", "window_start"]))


def stream_avg_per_sliding(spark, folder):
    """Append mode: only windows the watermark has passed."""
    feed = Events(spark, folder)
    average = flows.window_average(
        feed.stream(), "event_type", "ts", "cents", "1 hour", "30 minutes", "1 hour"
    )
    return zoneless(_emitted(feed, _starts(average)).withColumn("average", F.round("average", 6)))


def stream_users_per_window(spark, folder):
    """Append mode: only windows the watermark has passed."""
    feed = Events(spark, folder)
    users = flows.users_per_window(feed.stream(), "ts", "user_id", "1 hour", "1 hour")
    return zoneless(_emitted(feed, _starts(users)))


def stream_dedup(spark, folder):
    """Each user's row comes from the first part that has the user; within a part any of its rows may be taken."""
    feed = Events(spark, folder)
    rows = feed.stream().select("user_id", F.to_date("ts").alias("day"))
    return _emitted(feed, flows.first_seen(rows, ["user_id"])).select("user_id")


def stream_static_join(spark, folder):
    builders = table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("user_id"), "c_name"
    )
    feed = Events(spark, folder)
    return _emitted(feed, with_static(feed.stream().select("event_id", "user_id"), builders, "user_id"))


def stream_interval_join(spark, folder):
    feed = Events(spark, folder)

    def side(kind, prefix):
        return feed.stream().where(F.col("event_type") == kind).select(
            F.col("event_id").alias(f"{prefix}_id"),
            F.col("user_id").alias(f"{prefix}_ad_id"),
            F.col("ts").alias(f"{prefix}_time"),
        )

    joined = flows.clicks_after_impressions(side("view", "impression"), side("click", "click"))
    return zoneless(_emitted(feed, joined))


def stream_late_rows(spark, folder):
    """Hourly counts of events that arrive by event id: what comes for a window behind the watermark is dropped."""
    feed = Events(spark, folder, order="event_id")
    counted = flows.window_counts(feed.stream(), "event_type", "ts", "1 hour", None, "3 days")
    return zoneless(_final(feed, _starts(counted).withColumnRenamed("count", "n"), ["event_type", "window_start"]))


def stream_idle_counts(spark, folder):
    """Append mode: sessions of six hours' silence that the watermark has passed."""
    feed = Events(spark, folder)
    return zoneless(_emitted(feed, idle.idle_counts(feed.stream(), "user_id", "ts", "6 hours", "1 hour")))


def stream_silence_counts(spark, folder):
    """Rows per user by processing-time timers: parts come in quick succession, and all timers have fired at the end.

    Where a run takes longer than the timers wait, a user's rows are emitted in several counts; their sum is the result.
    """
    use_rocksdb(spark)
    feed, base, idle_seconds = Events(spark, folder), scratch_path(spark, "stream"), 5
    counts = idle.silence_counts(feed.stream(), "user_id", idle_seconds)
    for part in feed.arrivals():
        writer = counts.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint")
        sinks.run_until_quiet(writer, idle_seconds if part == len(feed.ranges) - 1 else 0, 1800)
    return spark.read.schema(counts.schema).parquet(f"{base}/rows").groupBy("user_id").agg(F.sum("count").alias("n"))


def stream_latest_map(spark, folder):
    feed = Events(spark, folder)
    latest = flows.latest_map(feed.stream(), "user_id", "cents", ["ts", "event_id"])
    return _final(feed, latest, ["user_id"])


# -- own state ---------------------------------------------------------------------


def _bootstrapped(spark, folder):
    """State of the history up to a cut-off, and the stream of the events from then on."""
    rows = inputs.events(spark, folder)
    history = rows.where(F.col("ts") < F.lit("2024-01-20 11:07:00").cast("timestamp"))
    cutoff = sliding.bootstrap_cutoff(history, "ts", 1800)
    state = sliding.bootstrap_state(history, "user_id", "ts", "cents", 1800, cutoff, window=3600)
    state = state.withColumnRenamed("user_id", "id").withColumn("id", F.col("id").cast("string"))
    feed = Events(spark, folder)
    live = sliding.from_cutoff(feed.stream(), "ts", cutoff).select(
        F.col("user_id").cast("string").alias("id"), F.col("ts").alias("timestamp"), F.col("cents").alias("value"),
        F.col("event_id").alias("tie"),
    )
    return feed, state, live


def stream_sliding_sum(spark, folder):
    """Sliding sums from the state store, started from the history; one row per event, also at tied instants."""
    use_rocksdb(spark)
    feed, state, live = _bootstrapped(spark, folder)
    summed = sliding_sum_stream(live, 3600, 1800, state, tie_break="tie")
    return zoneless(_by_batch(feed, summed).drop("batch_id"))


def stream_sliding_sum_table(spark, folder):
    """The same sums with the state as a table."""
    feed, state, live = _bootstrapped(spark, folder)
    base = scratch_path(spark, "sliding")
    job = SlidingSumTable(spark, base, 3600, 1800)
    job.bootstrap(state)
    _run(feed, live, job.process, base)
    return zoneless(job.output.all())


def stream_window_metrics(spark, folder):
    base = scratch_path(spark, "distinct")
    job = jobs.DistinctCounts(spark, base, inputs.event_segments(), timed.WIDTHS, "ts", "user_id")
    feed = Events(spark, folder)
    _run(feed, feed.stream(), job.process, base)
    return zoneless(job.metrics.all())


def stream_cdc_merge(spark, folder):
    base = scratch_path(spark, "cdc")
    stored = ChangeLog(inputs.order_target(spark, folder), f"{base}/orders", ["o_orderkey"])
    job = jobs.CdcMerge({inputs.NAMESPACE: jobs.CdcTarget(stored, feeds.ORDER_KEY, feeds.ORDER_VALUE)})
    feed = Feed(spark, folder, "orders", "o_orderkey")
    _run(feed, inputs.order_changes_of(feed.stream()), job.process, base)
    return stored.read()


def stream_latest_map_table(spark, folder):
    base = scratch_path(spark, "map")
    feed = Events(spark, folder)
    fields = feed.stream().select("user_id", "cents").schema
    job = jobs.LatestMap(spark, f"{base}/map", fields, "user_id", "cents", ["ts", "event_id"])
    _run(feed, feed.stream().select("user_id", "cents", "ts", "event_id"), job.process, base)
    return job.read()


def stream_latest_map_snapshot(spark, folder):
    """The map over 25 batches or more in five runs, saved every tenth batch."""
    base = scratch_path(spark, "saved-map")
    feed = Events(spark, folder, parts=25)
    rows = feed.stream(files=1).select("user_id", "cents", "ts", "event_id")
    job = jobs.SavedMap(spark, f"{base}/map", rows.schema, "user_id", "cents", ["ts", "event_id"])
    for part in feed.arrivals():
        if part % 5 == 4:
            sinks.each_batch(rows, job.process, f"{base}/checkpoint").awaitTermination()
    return job.read()


def _first_rows(spark, folder, name, order):
    feed = Events(spark, folder, order=order)
    rows = _final(feed, flows.first_rows(feed.stream(), ["user_id"], ["ts", "event_id"]), ["user_id"])
    return zoneless(rows.withColumn("feed", F.lit(name)))


def stream_first_rows(spark, folder):
    """Each user's first whole row, from events that arrive by time and from the same by id."""
    return _first_rows(spark, folder, "by time", "ts").unionByName(_first_rows(spark, folder, "by id", "event_id"))


def stream_users_running(spark, folder):
    """Distinct users of each day so far, after each batch that touched the day."""
    feed = Events(spark, folder, order="event_id")
    running = flows.users_running(feed.stream(), "ts", "user_id", "1 day", "400 days", shards=8)
    totals = flows.running_totals(_by_batch(feed, running))
    # One entry per batch that touched the day.
    steps = F.array_sort(F.collect_list(F.struct("batch_id", "users")))["users"]
    return zoneless(totals.groupBy("window_start").agg(F.array_join(steps.cast("array<string>"), ",").alias("users")))


def stream_stop_resume(spark, folder):
    """Events counted over a run that ends after two batches and one that goes on; batch ids without gap or repeat."""
    base = scratch_path(spark, "resumed")
    feed = Events(spark, folder)
    for _ in feed.arrivals():
        pass
    kept = BatchFolder(spark, f"{base}/rows", "event_type string, event_id bigint")
    rows = feed.stream(files=1).select("event_type", "event_id")
    checkpoint = f"{base}/checkpoint"
    first = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, i: kept.write(i, batch))
    sinks.run_batches(first, 2, 300)
    stopped = len(kept.batches())
    sinks.each_batch(rows, lambda batch, i: kept.write(i, batch), checkpoint).awaitTermination()
    ids = kept.batches()
    gapless = ids == list(range(len(ids))) and 2 <= stopped < len(ids)
    return kept.rows().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("events")).withColumn(
        "gapless", F.lit(gapless)
    )


def ingest_topics_once(spark, folder):
    """A topic per event type, all ingested by one query; errors come as a topic of their own only from the third part on."""
    base = scratch_path(spark, "topics-once")
    feed = Events(spark, folder)
    records = inputs.envelope_of(feed.stream().where("event_type is not null")).drop("headers", "topic")
    kind = F.from_json(F.col("value").cast("string"), inputs.PAYLOAD)["name"]
    late = (kind == "error") & (F.col("timestamp") < F.lit("2024-01-13").cast("timestamp"))
    records = records.withColumn("topic", F.when(late, "other").otherwise(kind))
    for _ in feed.arrivals():
        sinks.by_topic(records, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    written = spark.read.schema("value string, partition int, offset bigint, topic string").json(f"{base}/out")
    payload = F.from_json(F.unbase64("value").cast("string"), inputs.PAYLOAD)
    return written.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.sum(payload["value"]).alias("cents"))


def stream_progress(spark, folder):
    """Rows of each batch as its progress record tells, by input and as observed, beside those written."""
    base = scratch_path(spark, "progress")
    feed = Events(spark, folder)
    log = sinks.ProgressLog(spark, f"{base}/log")
    kept = BatchFolder(spark, f"{base}/rows", "event_id bigint")
    rows = sinks.with_row_count(feed.stream().select("event_id"))
    spark.streams.addListener(log)
    try:
        for part in feed.arrivals():
            query = sinks.each_batch(rows, lambda batch, i: kept.write(i, batch), f"{base}/checkpoint")
            query.awaitTermination()
            log.wait_for(query.id, part, 60)
    finally:
        spark.streams.removeListener(log)
    records = log.texts(query.id).select(
        F.get_json_object("value", "$.batchId").cast("bigint").alias("batch"),
        F.get_json_object("value", "$.numInputRows").cast("bigint").alias("rows_read"),
        F.get_json_object("value", "$.observedMetrics.rows.count").cast("bigint").alias("rows_observed"),
    )
    written = kept.rows().groupBy("batch").agg(F.count(F.lit(1)).alias("rows_written"))
    return records.where("rows_read > 0").join(written, "batch", "full")


def stream_user_average(spark, folder):
    """The mean by user code, whose buffers every batch adds to a table that a read merges."""
    base = scratch_path(spark, "user-average")
    feed = Events(spark, folder)
    average = user_aggregate.Average("cents")
    kept = BatchFolder(spark, f"{base}/buffers", f"event_type string, {user_aggregate.BUFFER} binary")
    _run(feed, feed.stream(), lambda batch, i: kept.write(i, user_aggregate.partial_buffers(batch, ["event_type"], average)), base)
    return user_aggregate.merged_buffers(kept.all(), average, "average").withColumn("average", F.round("average", 6))


SKETCHED, RANKS = ("2024-01-05", "2024-01-20"), (0.1, 0.5, 0.9)


def stream_sketch_rollup_ok(spark, folder):
    """Sketches of hourly windows from five batches, rolled up to fifteen days: rows, and whether each estimate is within
    5 % of the distinct values or 3 % of the ranks."""
    feed = Events(spark, folder, order="event_id")
    base = scratch_path(spark, "sketches")
    job = jobs.SketchTable(spark, f"{base}/sketches", "event_type", "ts", "user_id", "cents", "1 hour")
    _run(feed, feed.stream().select("event_type", "ts", "user_id", "cents"), job.process, base)
    rolled = job.roll_up(*SKETCHED, RANKS)
    begin, end = (F.lit(t).cast("timestamp") for t in SKETCHED)
    rows = inputs.events(spark, folder).where((F.col("ts") >= begin) & (F.col("ts") < end)).select("event_type", "user_id", "cents")
    # A few rows, one per kind of event.
    found = rows.join(F.broadcast(rolled), "event_type").groupBy("event_type", "n", "distinct_values", "quantiles").agg(
        F.count_distinct("user_id").alias("users"), F.count("cents").alias("known"),
        *[F.count_if(F.col("cents") <= F.get("quantiles", F.lit(i))).alias(f"upto{i}") for i in range(len(RANKS))],
        *[F.count_if(F.col("cents") < F.get("quantiles", F.lit(i))).alias(f"below{i}") for i in range(len(RANKS))],
    )
    near = F.abs(F.col("distinct_values") - F.col("users")) <= 0.05 * F.col("users")
    for i, rank in enumerate(RANKS):
        near &= (F.col(f"upto{i}") >= (rank - 0.03) * F.col("known")) & (F.col(f"below{i}") <= (rank + 0.03) * F.col("known"))
    return found.select("event_type", "n", near.alias("ok"))


def stream_time_clusters(spark, folder):
    base = scratch_path(spark, "clusters")
    job = jobs.TimeClusters(spark, f"{base}/ranges", "ts")
    feed = Events(spark, folder)
    _run(feed, feed.stream().select("ts"), job.process, base)
    return zoneless(job.ranges.all())


def stream_time_clusters_ok(spark, folder):
    """Rows covered, number of clusters over all parts, and whether no two ranges overlap, as the parts follow in time."""
    return relational.ranges_summary("parts", stream_time_clusters(spark, folder), "left_bound", "right_bound")


def stream_ingest_json(spark, folder):
    """Records appended as JSON in folders of their day and hour, then counted from the files."""
    base = scratch_path(spark, "ingest")
    feed = Events(spark, folder)
    records = inputs.envelope_of(feed.stream()).drop("headers")
    for _ in feed.arrivals():
        sinks.to_json_folders(records, f"{base}/rows", f"{base}/checkpoint", folders=("day", "hour")).awaitTermination()
    schema = "key string, value string, topic string, partition int, offset bigint, day string, hour int"
    written = spark.read.schema(schema).json(f"{base}/rows")
    payload = F.from_json(F.unbase64("value").cast("string"), inputs.PAYLOAD)
    return written.groupBy("day", "hour", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.sum(payload["value"]).alias("cents"), F.max("offset").alias("last_offset")
    )


_CLOSED = "(SELECT max(ts) FROM events) - INTERVAL 1 HOUR"
_FROM_CUTOFF = """
WITH e AS (SELECT *, epoch_us(ts) // 1000000 AS s, CAST(round(value * 100) AS BIGINT) AS c FROM events)
SELECT CAST(e.user_id AS VARCHAR) AS id, e.ts AS timestamp, CAST(sum(p.c) AS BIGINT) AS running_sum
FROM e JOIN e p ON p.user_id = e.user_id AND (p.ts, p.event_id) <= (e.ts, e.event_id)
     AND p.s // 1800 * 1800 > (e.s - 3600) // 1800 * 1800
WHERE e.s >= ((SELECT max(s) FROM e WHERE ts < TIMESTAMP '2024-01-20 11:07:00') - 60) // 1800 * 1800
GROUP BY e.user_id, e.ts, e.event_id
"""
_LATE = f"""
WITH b AS (SELECT min(event_id) AS low, max(event_id) AS high FROM events),
e AS (SELECT e.*, date_trunc('hour', ts) AS window_start,
             (SELECT count(*) FROM range(1, {PARTS}) r(i) WHERE event_id >= low + (high - low) * i // {PARTS}) AS part FROM events e, b),
m AS (SELECT part, max(ts) AS latest FROM e GROUP BY part),
w AS (SELECT p.part, max(m.latest) - INTERVAL 3 DAY AS behind FROM m p LEFT JOIN m ON m.part < p.part GROUP BY p.part)
SELECT event_type, window_start, count(*) AS n FROM e JOIN w USING (part)
WHERE behind IS NULL OR window_start + INTERVAL 1 HOUR > behind GROUP BY ALL
"""
_LATEST = """
SELECT user_id, arg_max(CAST(round(value * 100) AS BIGINT), (ts, event_id)) AS cents FROM events GROUP BY 1"""

QUERIES = {
    "stream_word_count": (stream_word_count, f"""
SELECT word AS value, count FROM ({relational.QUERIES["word_count_space"][1]})"""),
    "stream_counts_by_type": (stream_counts_by_type, relational.QUERIES["counts_by_type"][1]),
    "stream_window_count": (stream_window_count, timed.QUERIES["sliding_window_count"][1]),
    "stream_latest_per_sliding": (stream_latest_per_sliding, timed.QUERIES["latest_per_sliding"][1]),
    "stream_avg_per_sliding": (stream_avg_per_sliding, f"""
SELECT * FROM ({timed.QUERIES["avg_per_sliding"][1]}) WHERE window_start + INTERVAL 1 HOUR <= {_CLOSED}"""),
    "stream_users_per_window": (stream_users_per_window, f"""
SELECT date_trunc('hour', ts) AS window_start, count(DISTINCT user_id) AS distinct_users FROM events GROUP BY 1
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_CLOSED}"""),
    "stream_dedup": (stream_dedup, "SELECT DISTINCT user_id FROM events"),
    "stream_static_join": (stream_static_join, relational.QUERIES["stream_static_left"][1]),
    "stream_interval_join": (stream_interval_join, relational.QUERIES["interval_join"][1]),
    "stream_latest_map": (stream_latest_map, _LATEST),
    "stream_latest_map_table": (stream_latest_map_table, _LATEST),
    "stream_sliding_sum": (stream_sliding_sum, _FROM_CUTOFF),
    "stream_sliding_sum_table": (stream_sliding_sum_table, _FROM_CUTOFF),
    "stream_window_metrics": (stream_window_metrics, timed.QUERIES["window_metrics"][1]),
    "stream_cdc_merge": (stream_cdc_merge, feeds.QUERIES["cdc_merge"][1]),
    "stream_latest_map_snapshot": (stream_latest_map_snapshot, _LATEST),
    "stream_first_rows": (stream_first_rows, f"""
WITH e AS (SELECT event_id, ts, user_id, event_type, value, props, CAST(round(value * 100) AS BIGINT) AS cents FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1)
SELECT *, unnest(['by time', 'by id']) AS feed FROM e"""),
    "stream_users_running": (stream_users_running, f"""
WITH b AS (SELECT min(event_id) AS low, max(event_id) AS high FROM events),
e AS (SELECT date_trunc('day', ts) AS window_start, user_id,
             (SELECT count(*) FROM range(1, {PARTS}) r(i) WHERE event_id >= low + (high - low) * i // {PARTS})::INTEGER AS batch_id FROM events, b),
f AS (SELECT window_start, user_id, min(batch_id) AS batch_id FROM e WHERE user_id IS NOT NULL GROUP BY ALL),
t AS (SELECT t.window_start, t.batch_id, count(*) AS users
      FROM (SELECT DISTINCT window_start, batch_id FROM e WHERE user_id IS NOT NULL) t
      JOIN f ON f.window_start = t.window_start AND f.batch_id <= t.batch_id GROUP BY ALL)
SELECT window_start, string_agg(users::VARCHAR, ',' ORDER BY batch_id) AS users FROM t GROUP BY 1"""),
    "stream_stop_resume": (stream_stop_resume, """
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS events, true AS gapless FROM events GROUP BY 1"""),
    "ingest_topics_once": (ingest_topics_once, """
SELECT CASE WHEN event_type = 'error' AND ts < TIMESTAMP '2024-01-13' THEN 'other' ELSE event_type END AS topic, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events WHERE event_type IS NOT NULL GROUP BY 1"""),
    "stream_progress": (stream_progress, f"""
WITH b AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events),
e AS (SELECT (SELECT count(*) FROM range(1, {PARTS}) r(i) WHERE epoch_us(ts) >= low + (high - low) * i // {PARTS}) AS batch FROM events, b)
SELECT batch, count(*) AS rows_read, count(*) AS rows_observed, count(*) AS rows_written FROM e GROUP BY 1"""),
    "stream_user_average": (stream_user_average, relational.QUERIES["user_average_sql"][1]),
    "stream_sketch_rollup_ok": (stream_sketch_rollup_ok, f"""
SELECT event_type, count(*) AS n, true AS ok FROM events WHERE ts >= '{SKETCHED[0]}' AND ts < '{SKETCHED[1]}' GROUP BY 1"""),
    "stream_time_clusters": (stream_time_clusters, f"""
SELECT make_timestamp_ms(low) AS left_bound, make_timestamp_ms(high) AS right_bound, n FROM ({cluster.ranges_sql(f"""
  SELECT epoch_us(ts) // 1000 AS v, (SELECT count(*) FROM range(1, {PARTS}) r(i) WHERE epoch_us(ts) >= low + (high - low) * i // {PARTS}) AS part
  FROM events, (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events)""", 3, "part")})"""),
    "stream_time_clusters_ok": (stream_time_clusters_ok, f"""
SELECT 'parts' AS name, count(*) AS n, CAST({3 * PARTS} AS BIGINT) AS clusters, true AS disjoint FROM events"""),
    "stream_late_rows": (stream_late_rows, _LATE),
    "stream_idle_counts": (stream_idle_counts, f"""
SELECT * FROM ({timed.QUERIES["idle_sessions"][1]}) WHERE session_end + INTERVAL 6 HOUR <= {_CLOSED}"""),
    "stream_silence_counts": (stream_silence_counts, "SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1"),
    "stream_ingest_json": (stream_ingest_json, """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(event_id % 3 AS INTEGER) AS partition,
       count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, max(event_id // 3) AS last_offset
FROM events GROUP BY ALL"""),
}
