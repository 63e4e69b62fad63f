import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streams import FileFeed, LiveRun, run_all
from tidemill.operators import distinct
from tidemill.plans import streamed
from tidemill.plans.inputs import event_segments
from tidemill.session import use_rocksdb
from tidemill.sources import files
from tidemill.sources.generate import rate_stream
from tidemill.sources.changelog import ChangeLog
from tidemill.sources.tables import table
from tidemill.streaming import flows, idle, sinks
from tidemill.streaming import tables as jobs


def at(text, day=18):
    h, m, s = map(int, text.split(":"))
    return dt.datetime(2024, 3, day, h, m, s)


WORD = "event_time timestamp, word string"


def test_watermark_case(spark, tmp_path):
    """Window 60 s, slide 20 s, delay 5 min: rows are dropped only when all their windows are over."""
    feed = FileFeed(spark, tmp_path / "in", WORD)
    run = LiveRun(flows.window_counts(feed.stream(), "word", "event_time"), tmp_path, "update")
    run.feed(feed, [(at("07:57:02"), "a")])
    run.feed(feed, [(at("07:51:19"), "late"), (at("07:51:20"), "ok")])
    run.feed(feed, [(at("07:57:22"), "a")])
    run.feed(feed, [(at("07:51:20"), "late"), (at("07:51:39"), "late"), (at("07:51:40"), "ok")])
    rows = run.stop()
    assert not [r for r in rows if r[1] == "late"]
    assert sorted(r[0].start for r in rows if r[1] == "ok") == [at("07:51:20"), at("07:51:40")]
    assert sorted(r[0].start for r in rows if r[1] == "a" and r[2] == 1)[:2] == [at("07:56:20"), at("07:56:40")]


def test_word_count_modes(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "value string")
    for line in ("a b a", "b c", "c"):
        feed.add([(line,)])
    counted = flows.running_word_count(feed.stream())
    update = run_all(counted, tmp_path, "update", "u")
    assert [sorted(b) for b in update] == [[("a", 2), ("b", 1)], [("b", 2), ("c", 1)], [("c", 2)]]
    complete = run_all(counted, tmp_path, "complete", "c")
    assert sorted(complete[-1]) == [("a", 2), ("b", 2), ("c", 2)]
    assert run_all(flows.view_count(feed.stream()), tmp_path, "complete", "v")[-1] == [(3,)]
    with pytest.raises(Exception, match="(?i)append"):
        run_all(counted, tmp_path, "append", "bad")


def test_running_count_equals_table(spark, tmp_path, data):
    feed = FileFeed(spark, tmp_path / "in", "event_type string")
    events = table(spark, data, "events").select("event_type", "event_id")
    for third in range(3):
        feed.add(events.where(F.col("event_id") % 3 == third).select("event_type"))
    last = {}
    for batch in run_all(flows.running_count(feed.stream(), "event_type"), tmp_path, "update"):
        last.update(batch)
    assert last == {r[0]: r[1] for r in events.groupBy("event_type").count().collect()}


@pytest.mark.parametrize("splits", [1, 3])
def test_interval_join(spark, tmp_path, splits):
    shown = FileFeed(spark, tmp_path / "i", "impression_time timestamp, impression_ad_id int, name string")
    clicked = FileFeed(spark, tmp_path / "c", "click_time timestamp, click_ad_id int, clicker string")
    shown.add([(at("07:07:02"), 12, "printer"), (at("06:27:02"), 12, "drink")])
    clicked.add([(at("07:32:02"), 12, "Jim"), (at("07:32:02"), 18, "Jim"), (at("06:32:02"), 12, "Jason")])
    clicked.add([(at("06:32:02"), 12, "John"), (at("08:02:02"), 12, "Jane")])
    joined = flows.clicks_after_impressions(shown.stream(), clicked.stream(), splits=splits).select("name", "clicker")
    rows = [r for b in run_all(joined, tmp_path) for r in b]
    assert sorted(rows) == [("drink", "Jason"), ("drink", "John"), ("printer", "Jane"), ("printer", "Jim")]


@pytest.mark.parametrize("splits", [1, 2])
def test_interval_join_meets_by_time(spark, tmp_path, splits):
    """Rows of one ad meet by steps of time, and no pair is lost or doubled at the edges of steps."""
    shown = FileFeed(spark, tmp_path / "i", "impression_time timestamp, impression_ad_id int, i int")
    clicked = FileFeed(spark, tmp_path / "c", "click_time timestamp, click_ad_id int, c int")
    times = [f"{h:02}:{m:02}:00" for h in range(13) for m in (0, 1, 59)]
    shown.add([(at(t), 1, i) for i, t in enumerate(times)])
    clicked.add([(at(t), 1, i) for i, t in enumerate(times)] + [(None, 1, -1)])
    joined = flows.clicks_after_impressions(shown.stream(), clicked.stream(), splits=splits)
    assert joined.columns == ["impression_time", "impression_ad_id", "i", "click_time", "click_ad_id", "c"]
    assert "_click_step" in joined._jdf.queryExecution().analyzed().toString()
    rows = [(r[2], r[5]) for b in run_all(joined, tmp_path) for r in b]
    near = [(i, c) for i, s in enumerate(times) for c, t in enumerate(times) if 0 <= (at(t) - at(s)).total_seconds() <= 3600]
    assert sorted(rows) == sorted(near)


def test_dedup_and_static_join(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "name string, age int")
    feed.add([("Jack", 12), ("Jason", 40)])
    feed.add([("Jack", 13), ("CannotBeJoined", 100)])
    first = [r for b in run_all(flows.first_seen(feed.stream(), ["name"]), tmp_path, "append", "d") for r in b]
    assert sorted(first) == [("CannotBeJoined", 100), ("Jack", 12), ("Jason", 40)]
    from tidemill.operators.joins import with_static
    places = spark.createDataFrame([("Aaron", "Boston"), ("Jack", "New York"), ("Jason", "Seattle")], "name string, address string")
    rows = [r for b in run_all(with_static(feed.stream(), places, "name"), tmp_path, "append", "j") for r in b]
    assert ("CannotBeJoined", 100, None) in rows and ("Jason", 40, "Seattle") in rows and len(rows) == 4


def test_dedup_within_watermark(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "k string, ts timestamp")
    feed.add([("a", at("10:00:00")), ("a", at("10:00:01"))])
    feed.add([("a", at("10:00:30")), ("b", at("10:00:31"))])
    rows = [r[0] for b in run_all(flows.first_seen_within(feed.stream(), ["k"], "ts", "1 hour"), tmp_path) for r in b]
    assert sorted(rows) == ["a", "b"]


def test_window_latest_and_average(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "name string, ts timestamp, id bigint, value bigint")
    feed.add([("n", at("10:00:05"), 1, 10), ("n", at("10:00:15"), 2, 20)])
    feed.add([("n", at("10:00:12"), 3, 30)])
    feed.add([("n", at("10:05:00"), 4, 1)])
    latest = flows.window_latest(feed.stream(), "name", "ts", "value", ["ts", "id"])
    last = {}
    for b in run_all(latest, tmp_path, "update", "l"):
        last.update({r[1].start: r[2] for r in b})
    assert last[at("09:59:40")] == 10 and last[at("09:59:50")] == 20 and last[at("10:00:10")] == 20
    feed.add([("n", at("10:09:00"), 5, 1)])
    average = flows.window_average(feed.stream(), "name", "ts", "value", delay="1 minute")
    closed = {r[0].start: r[2] for b in run_all(average, tmp_path, "append", "a") for r in b}
    assert closed[at("10:00:00")] == 20.0 and closed[at("09:59:50")] == 10.0 and closed[at("10:00:10")] == 25.0


def test_latest_map(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "name string, ts timestamp, offset bigint, value int")
    parts = [
        [("a", at("10:00:00"), 1, 1), ("b", at("10:00:00"), 2, 2)],
        [("a", at("09:00:00"), 3, 9), ("c", at("10:00:00"), 4, 4)],
        [("a", at("11:00:00"), 5, None), ("b", at("11:00:00"), 6, 7)],
    ]
    for part in parts:
        feed.add(part)
    streamed = {}
    for b in run_all(flows.latest_map(feed.stream(), "name", "value", ["ts", "offset"]), tmp_path, "update"):
        streamed.update(b)
    assert streamed == {"a": None, "b": 7, "c": 4}
    fields = T._parse_datatype_string("name string, value int")
    job = jobs.LatestMap(spark, str(tmp_path / "map"), fields, "name", "value", ["ts", "offset"])
    for number, part in enumerate(parts):
        for _ in range(2):
            job.process(spark.createDataFrame(part, feed.schema), number)
    # per batch the new value wins, a new NULL does not
    assert {r.name: r.value for r in job.read().collect()} == {"a": 9, "b": 7, "c": 4}
    assert {r.name: r.value for r in job.read(0).collect()} == {"a": 1, "b": 2}


def test_users_per_window(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "user string, ts timestamp")
    feed.add([("u1", at("10:00:01")), ("u1", at("10:00:02")), ("u2", at("10:00:03")), (None, at("10:00:04"))])
    feed.add([("u2", at("10:00:09")), ("u3", at("10:00:09")), ("u1", at("10:00:11"))])
    feed.add([("u9", at("10:05:00"))])
    feed.add([("u9", at("10:10:00"))])
    rows = {r[0].start: r[1] for b in run_all(flows.users_per_window(feed.stream(), "ts", "user"), tmp_path) for r in b}
    assert rows[at("10:00:00")] == 3 and rows[at("10:00:10")] == 1


def test_distinct_machine_equals_table(spark, tmp_path, data):
    events = table(spark, data, "events").select("event_id", "event_type", "user_id", "ts", "props").orderBy("ts")
    widths = [3600, 86400]
    windows = distinct.segment_distinct(events, event_segments(), widths, "ts", "user_id")
    want = distinct.metric_points(distinct.closed(windows, distinct.latest_windows(windows)))
    job = jobs.DistinctCounts(spark, str(tmp_path / "job"), event_segments(), widths, "ts", "user_id")
    feed = FileFeed(spark, tmp_path / "in", events._jdf.schema().toDDL())
    edges = ["2024-01-01 00:00:00", "2024-01-09 10:30:00", "2024-01-17 10:30:00", "2024-01-25 10:30:00", "2024-02-01 00:00:00"]
    for start, end in zip(edges, edges[1:]):
        feed.add(events.where((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))))
    sinks.each_batch(feed.stream(), job.process, str(tmp_path / "cp")).awaitTermination()
    got = {(r.metric, r.ts, r.tags): r.value for r in job.metrics.all().collect()}
    assert got == {(r.metric, r.ts, r.tags): r.value for r in want.collect()}
    assert sorted(map(tuple, job.counts.read(0).collect())) == sorted(
        (r.user_type, r.window_s, r.start_time, r.distinct_users)
        for r in distinct.segment_distinct(
            events.where(F.col("ts") < F.lit(edges[1]).cast("timestamp")), event_segments(), widths, "ts", "user_id").collect())
    last = job.metrics.rows().agg(F.max("batch")).first()[0]
    before = sorted(map(tuple, job.metrics.read(last).collect()))
    job.process(spark.read.schema(feed.schema).parquet(feed.folder).where(F.col("ts") >= F.lit("2024-01-25 10:30:00")), last)
    assert sorted(map(tuple, job.metrics.read(last).collect())) == before  # a repeated batch is harmless
    late = events.limit(5)
    job.process(late, last + 1)
    assert job.metrics.read(last + 1).count() == 0


def _cdc(spark, changes):
    """(oc, ns, pk, va) texts as envelope rows with rising offsets."""
    rows = [(bytearray(b"k"), None, "t", 0, n, at("10:00:00"), 0, c) for n, c in enumerate(changes)]
    frame = spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int, "
              "c struct<oc string, ns string, pk string, va string>")
    return frame.withColumn("value", F.to_json("c").cast("binary")).drop("c")


def test_cdc_merge_stream(spark, tmp_path):
    one = ChangeLog(spark.createDataFrame([(1, "v0"), (2, "v0")], "_id int, value string"), str(tmp_path / "t1"), ["_id"])
    uuids = spark.createDataFrame([(f"uuid{i}", "0", i) for i in (1, 2, 3)], "uuid string, version string, num int")
    two = ChangeLog(uuids, str(tmp_path / "t2"), ["uuid"])
    job = jobs.CdcMerge({
        "db.t1": jobs.CdcTarget(one, T._parse_datatype_string("_id int"), T._parse_datatype_string("value string")),
        "db.t2": jobs.CdcTarget(two, T._parse_datatype_string("uuid string"), T._parse_datatype_string("version string, num int")),
    })
    first = [("U", "db.t1", '{"_id":1}', '{"value":"v1"}'), ("I", "db.t1", '{"_id":3}', '{"value":"v0"}'),
             ("U", "db.t2", '{"uuid":"uuid1"}', '{"version":"1","num":11}'), ("I", "db.t2", '{"uuid":"uuid4"}', '{"version":"0","num":44}'),
             ("D", "db.t2", '{"uuid":"uuid3"}', "{}"), ("U", "db.none", '{"_id":1}', "{}")]
    second = [("U", "db.t1", '{"_id":1}', '{"value":"v2"}'), ("D", "db.t1", '{"_id":2}', None),
              ("U", "db.t2", '{"uuid":"uuid1"}', '{"version":"2","num":12}'), ("U", "db.t2", '{"uuid":"uuid2"}', '{"version":"1","num":22}')]
    feed = FileFeed(spark, tmp_path / "in", "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int")
    feed.add(_cdc(spark, first))
    sinks.each_batch(feed.stream(), job.process, str(tmp_path / "cp")).awaitTermination()
    feed.add(_cdc(spark, second))
    sinks.each_batch(feed.stream(), job.process, str(tmp_path / "cp")).awaitTermination()  # restart
    assert sorted(map(tuple, one.read().collect())) == [(1, "v2"), (3, "v0")]
    assert sorted(map(tuple, two.read().collect())) == [("uuid1", "2", 12), ("uuid2", "1", 22), ("uuid4", "0", 44)]
    job.process(_cdc(spark, second), 1)
    assert sorted(map(tuple, one.read().collect())) == [(1, "v2"), (3, "v0")]  # a repeated batch is harmless
    assert sorted(map(tuple, one.read(-1).collect())) == [(1, "v0"), (2, "v0")]
    assert sorted(map(tuple, one.read(0).collect())) == [(1, "v1"), (2, "v0"), (3, "v0")]


def test_time_clusters(spark, tmp_path):
    job = jobs.TimeClusters(spark, str(tmp_path / "r"), "created_at")
    times = [at(t) for t in ("10:00:00", "10:00:02", "11:00:00", "11:00:05", "12:00:00", "12:00:01")]
    job.process(spark.createDataFrame([(t,) for t in times], "created_at timestamp"), 0)
    job.process(spark.createDataFrame([], "created_at timestamp"), 1)
    assert [r.batch for r in job.ranges.rows().select("batch").distinct().collect()] == [0]
    rows = job.ranges.read(0).orderBy("left_bound").collect()
    assert [(r.left_bound, r.right_bound, r.n) for r in rows] == [(times[0], times[1], 2), (times[2], times[3], 2), (times[4], times[5], 2)]
    feed = _cdc(spark, [("I", "x", '{"_id":"a"}', '{"created_at":"2024-03-18T10:00:00Z","type":"t"}'), ("D", "x", '{"_id":"a"}', None)])
    live = jobs.live_changes(feed, T._parse_datatype_string("_id string"), T._parse_datatype_string("created_at timestamp, type string"))
    assert [tuple(r) for r in live.collect()] == [("a", at("10:00:00"), "t")]


def test_idle_counts(spark, tmp_path):
    """A session leaves once the watermark has passed it; a row within the gap extends it over micro-batches."""
    feed = FileFeed(spark, tmp_path / "in", "name string, ts timestamp")
    run = LiveRun(idle.idle_counts(feed.stream(), "name", "ts", "10 seconds", "5 seconds"), tmp_path, "append")
    run.feed(feed, [("a", at("10:00:00")), ("b", at("10:00:01"))])
    run.feed(feed, [("a", at("10:00:09")), ("c", at("10:00:30"))])
    run.feed(feed, [("a", at("10:00:02")), ("c", at("10:01:00"))])
    rows = {tuple(r) for r in run.stop()}
    assert rows == {
        ("a", at("10:00:00"), at("10:00:09"), 2), ("b", at("10:00:01"), at("10:00:01"), 1), ("c", at("10:00:30"), at("10:00:30"), 1)
    }


def test_silence_counts(spark, tmp_path):
    """Rows that come before a key's timer are one count, over a restart too; a key that comes back after it starts anew."""
    use_rocksdb(spark)
    feed = FileFeed(spark, tmp_path / "in", "name string")

    def run(rows, idle_seconds, quiet):
        feed.add(rows)
        counts = idle.silence_counts(spark.readStream.schema("name string").parquet(feed.folder), "name", idle_seconds)
        writer = counts.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        sinks.run_until_quiet(writer, quiet, 120)
        return sorted((tuple(r) for r in spark.read.schema(counts.schema).parquet(str(tmp_path / "out")).collect()), key=repr)

    assert run([("a",), ("b",), ("a",), (None,)], 3600, 0) == []
    assert run([("a",)] * 30 + [("c",)], 2, 2) == [("a", 32), ("c", 1)]  # the others' timers have not fired
    assert run([("a",), ("b",), (None,)], 2, 2) == [("a", 1), ("a", 32), ("b", 2), ("c", 1), (None, 2)]


def test_registered_streams_run_over_several_batches(spark, data):
    feed = streamed.Events(spark, data)
    rows = streamed._by_batch(feed, flows.running_count(feed.stream(), "event_type"))
    assert rows.select("batch_id").distinct().count() == streamed.PARTS
    assert spark.read.parquet(feed.path).count() == feed.source.count()


def test_json_sinks_topics_and_progress(spark, tmp_path):
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
    feed = FileFeed(spark, tmp_path / "in", schema)
    for n in range(3):
        feed.add([(bytearray(b"k"), bytearray(b'{"x":1}'), t, 0, n, at(f"1{n}:30:00"), 0) for t in ("t1", "t2")])
    out = str(tmp_path / "folders")
    sinks.to_json_folders(feed.stream(), out, str(tmp_path / "cp1")).awaitTermination()
    read = spark.read.json(out)
    assert read.count() == 6 and {"day", "hour", "minute"} <= set(read.columns)
    assert read.where("hour = 11 AND minute = 30").count() == 2
    assert read.first().value == "eyJ4IjoxfQ=="
    for query in sinks.per_topic(lambda t: feed.stream().where(F.col("topic") == t), ["t1", "t2"], str(tmp_path / "topics")):
        query.awaitTermination()
    assert spark.read.json(str(tmp_path / "topics" / "t1")).select("topic").distinct().collect() == [("t1",)]
    sinks.to_json_folders(feed.stream(), str(tmp_path / "byhour"), str(tmp_path / "cp2"), folders=("day", "hour")).awaitTermination()
    assert "minute" not in spark.read.json(str(tmp_path / "byhour")).columns
    # a restart on the same checkpoint writes nothing again
    sinks.to_json_folders(feed.stream(), out, str(tmp_path / "cp1")).awaitTermination()
    assert spark.read.json(out).count() == 6


def test_dead_letters_in_a_stream(spark, tmp_path):
    from tidemill.functions.parse import split_rejects
    from tidemill.schemas import EMPLOYEE
    feed = FileFeed(spark, tmp_path / "in", "value string")
    feed.add([('{"emp_id":1}',), ("junk",)])
    kept = []
    handler = sinks.with_dead_letters(
        lambda b: split_rejects(b, "value", EMPLOYEE, ["emp_id"]),
        lambda good, i: kept.extend(r.record.emp_id for r in good.collect()), str(tmp_path / "dlq"))
    sinks.each_batch(feed.stream(), handler, str(tmp_path / "cp")).awaitTermination()
    assert kept == [1]
    assert [r.value for r in spark.read.text(str(tmp_path / "dlq")).collect()] == [
        '{"orig_request":"junk","failed_reason":"missing or invalid: emp_id"}']


def test_csv_text_and_partition_folders(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Ann,30\nBob,x\n")
    people = files.stream_csv(spark, str(folder), "name string, age int", max_files=1, latest_first=True)
    assert sorted(run_all(people, tmp_path, name="csv")[0]) == [("Ann", 30), ("Bob", None)]
    wrong = files.stream_csv(spark, str(folder), "name string, age int", sep=";")
    assert sorted(run_all(wrong, tmp_path, name="sep")[0]) == [("Ann,30", None), ("Bob,x", None)]
    hive = tmp_path / "hive"
    for day in (1, 2):
        (hive / f"day={day}").mkdir(parents=True)
        (hive / f"day={day}" / "f.csv").write_text(f"x{day}\n")
    found = run_all(files.stream_csv(spark, str(hive), "v string, day int"), tmp_path, name="hive")
    assert sorted(r for b in found for r in b) == [("x1", 1), ("x2", 2)]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.txt").write_text("one two\nthree\n")
    assert len(run_all(files.stream_lines(spark, str(lines), 1), tmp_path, name="txt")[0]) == 2
    assert files.read_lines(spark, str(lines)).count() == 2
    listed = files.list_files(spark, str(hive)).collect()
    assert len(listed) == 2 and all(r.length == 3 for r in listed)


def test_rate_and_stop_after(spark, tmp_path):
    query = (rate_stream(spark, 20, 2).writeStream.format("memory").queryName("rate_rows")
             .trigger(processingTime="300 milliseconds").start())
    sinks.stop_after(query, 3, timeout=60)
    assert not query.isActive and query.lastProgress["batchId"] >= 2
    assert spark.table("rate_rows").columns == ["timestamp", "value"]


def test_console(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "v string")
    feed.add([("x" * 50,)])
    query = sinks.to_console(feed.stream(), "shown", str(tmp_path / "cp"))
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress["numInputRows"] == 1


def test_observed_row_counts(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "v string")
    feed.add([("a",), ("b",)])
    query = (sinks.with_row_count(feed.stream(), "seen").writeStream.format("noop")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert query.recentProgress[0]["observedMetrics"]["seen"][0] == 2


def test_progress_records_of_a_query(spark):
    class Query:
        recentProgress = [{
            "name": "q", "batchId": 3, "numInputRows": 2, "durationMs": {"latestOffset": 1},
            "sources": [{"startOffset": {"t": {"0": 1}}, "endOffset": {"t": {"0": 3}}, "numInputRows": 2}],
        }]

    row = sinks.progress_of(spark, Query()).first()
    assert (row.query, row.batch_id, row.topic, row.partition, row.start_offset, row.end_offset) == ("q", 3, "t", 0, 1, 3)


def test_progress_log_keeps_more_than_a_hundred_batches(spark, tmp_path):
    batches = 105
    spark.range(0, batches, 1, batches).write.parquet(str(tmp_path / "in"))
    log = sinks.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = sinks.each_batch(stream, lambda batch, number: None, str(tmp_path / "cp"))
        query.awaitTermination()
        ids = {p["batchId"] if isinstance(p, dict) else p.batchId for p in query.recentProgress}
        for _ in range(120):
            if log.texts(query.id).count() > max(ids):
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(log)
    numbers = {r.n for r in log.texts(query.id).select(F.get_json_object("value", "$.batchId").cast("int").alias("n")).collect()}
    assert numbers == set(range(max(ids) + 1)) and len(numbers) > 100
