import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from streams import FileFeed, LiveRun, run_all
from tidemill.operators import sliding
from tidemill.streaming.sliding_state import SlidingSumTable, sliding_sum_stream, sums_after

import numpy as np

DAY = dt.datetime(2024, 7, 25)
SCHEMA = "id string, timestamp timestamp, value bigint, tie bigint"


def at(text, micros=0):
    h, m, s = map(int, text.split(":"))
    return DAY + dt.timedelta(hours=h, minutes=m, seconds=s, microseconds=micros)


def micros(moment):
    return int((moment - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000 + moment.microsecond


def bucket(text):
    return micros(at(text + ":00")) // 1_000_000


# state before, events (time, micros, value), output, state after
GOLDEN = [
    ([], [("00:00:01", 0, 1), ("00:01:01", 0, 2), ("00:31:01", 0, 10), ("00:32:01", 0, 2), ("01:01:01", 0, 5)],
     [1, 3, 13, 15, 17], [("00:30", 12), ("01:00", 5)]),
    ([("00:00", 3), ("00:30", 12), ("01:00", 5)], [("00:51:01", 0, 1)], [16],
     [("00:00", 3), ("00:30", 13), ("01:00", 5)]),
    ([("00:00", 3), ("00:30", 13), ("01:00", 5)], [("01:01:01", 0, 1)], [19], [("00:30", 13), ("01:00", 6)]),
    ([("00:30", 13), ("01:00", 6)], [("01:11:01", 0, 1), ("01:31:01", 0, 1)], [20, 8], [("01:00", 7), ("01:30", 1)]),
    ([("01:00", 7), ("01:30", 1)],
     [("03:32:01", 3, 8), ("03:32:01", 1, 4), ("03:32:01", 2, 2), ("03:01:01", 0, 1), ("00:31:01", 0, 99)],
     [99, 1, 5, 7, 15], [("03:00", 1), ("03:30", 14)]),
]


@pytest.mark.parametrize("before, events, output, after", GOLDEN)
def test_state_step(before, events, output, after):
    ordered = sorted((micros(at(t, us)), v) for t, us, v in events)
    running, starts, sums = sums_after(
        np.array([bucket(b) for b, _ in before], dtype=np.int64), np.array([s for _, s in before], dtype=np.int64),
        np.array([m for m, _ in ordered]), np.array([v for _, v in ordered]), 3600, 1800,
    )
    assert running.tolist() == output
    assert list(zip(starts.tolist(), sums.tolist())) == [(bucket(b), s) for b, s in after]


@pytest.mark.parametrize("before, events, output, after", GOLDEN)
def test_table_step(spark, tmp_path, before, events, output, after):
    kept = spark.createDataFrame([("1", at(b + ":00"), s) for b, s in before], "id string, bucket_start timestamp, bucket_sum bigint")
    job = SlidingSumTable(spark, str(tmp_path), 3600, 1800)
    job.bootstrap(kept)
    batch = spark.createDataFrame([("1", at(t, us), v, 0) for t, us, v in events], SCHEMA)
    for _ in range(2):  # a repeated batch gives the same
        job.process(batch, 0)
        rows = job.output.all().orderBy("timestamp").collect()
        assert [r.running_sum for r in rows] == output
        seen = [(bucket(b), s) for b, s in after]  # what the next event in the last bucket can see
        state = job.buckets(1, seen[0][0], seen[-1][0]).orderBy("bucket_s").collect()
        assert [(r.bucket_s, r.bucket_sum) for r in state] == seen


def test_table_drops_late_rows_and_leaves_idle_days(spark, tmp_path):
    job = SlidingSumTable(spark, str(tmp_path), 3600, 1800)
    parts = [[("1", at("01:00:00"), 5, 0)], [("1", at("00:59:59"), 7, 1), ("1", None, 9, 2)], [("1", at("01:00:01"), 1, 3)], []]
    for number, part in enumerate(parts):
        job.process(spark.createDataFrame(part, SCHEMA), number)
    assert sorted(r.running_sum for r in job.output.all().collect()) == [5, 6]
    month_on = at("01:00:00") + dt.timedelta(days=30)
    for number, hour in ((4, 0), (5, 1)):
        job.process(spark.createDataFrame([("2", month_on + dt.timedelta(hours=hour), 1, 9)], SCHEMA), number)
    assert job.state.read(5).count() == 1  # a batch writes its own buckets, not those of idle keys
    second = int((month_on - dt.datetime(1970, 1, 1)).total_seconds())
    plan = job.buckets(6, second, second)._jdf.queryExecution().toString()
    assert "bucket_day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def step_by_step(events, window, width):
    """The rule, one event at a time."""
    state, out = {}, {}
    for key, when, tie, value in sorted(events, key=lambda e: e[1:3]):
        held = state.setdefault(key, {})
        second = when // 1_000_000
        floor = (second - window) // width * width
        for start in [s for s in held if s <= floor]:
            del held[start]
        own = second // width * width
        held[own] = held.get(own, 0) + value
        out[tie] = sum(v for s, v in held.items() if s <= own)
    return out


@pytest.mark.parametrize("window, width", [(3600, 1800), (7200, 600), (10000, 3600), (1800, 1800), (4000, 900)])
@pytest.mark.parametrize("hot_rows", [10**9, 50])
def test_table_operator_against_rule(spark, window, width, hot_rows):
    rng = random.Random(window + width)
    base = micros(DAY)
    events = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", base + rng.randrange(0, 40000) * 500_000, i, rng.randrange(-5, 50))
              for i in range(600)]
    # many events of one key in one bucket, some at the same instant
    events += [("hot", base + 7_200_000_000 + (i % 7), 1000 + i, 1) for i in range(200)]
    events += [(None, base + i * 600_000_000, 2000 + i, 3) for i in range(30)]
    df = spark.createDataFrame(events, "id string, m bigint, tie bigint, value bigint").select(
        "id", F.timestamp_micros("m").alias("timestamp"), "value", "tie")
    got = sliding.sliding_running_sum(df, "id", "timestamp", "value", ["tie"], window, width, hot_rows=hot_rows)
    assert {r.tie: r.running_sum for r in got.collect()} == step_by_step(events, window, width)


def test_hot_buckets_stay_apart(spark):
    """Nothing above the union of ordinary and hot buckets shuffles them together again."""
    rows = spark.range(500).select(
        F.lit("hot").alias("id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("timestamp"), F.lit(1).alias("value"), F.col("id").alias("tie"))
    summed = sliding.sliding_running_sum(rows, "id", "timestamp", "value", ["tie"], 3600, 1800, hot_rows=50)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        summed.explain()
    above = text.getvalue().split("Union")[0]
    assert "Union" in text.getvalue() and "Exchange" not in above and "Window" not in above


def test_width_check(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        sliding.sliding_running_sum(df, "id", "timestamp", "value", ["tie"], 600, 1800)


def _events(n, seed):
    rng = random.Random(seed)
    return sorted((at("00:00:00") + dt.timedelta(seconds=60 * i + rng.randrange(60)), f"u{rng.randrange(4)}", rng.randrange(1, 90), i)
                  for i in range(n))


def test_stream_equals_table_with_bootstrap_and_restart(spark, tmp_path):
    rows = [(i, t, v, tie) for t, i, v, tie in _events(400, 3)]
    everything = spark.createDataFrame(rows, SCHEMA)
    batch = {r.tie: r.running_sum for r in
             sliding.sliding_running_sum(everything, "id", "timestamp", "value", ["tie"], 3600, 1800).collect()}
    by_time = {(i, t): batch[tie] for i, t, v, tie in rows}

    history = everything.where(F.col("tie") < 150)
    cutoff = sliding.bootstrap_cutoff(history, "timestamp", 1800)
    state = sliding.bootstrap_state(history, "id", "timestamp", "value", 1800, cutoff)
    small = sliding.bootstrap_state(history, "id", "timestamp", "value", 1800, cutoff, window=3600)
    assert small.count() <= state.count()
    live = [r for r in rows if r[1] >= cutoff]

    def run(first):
        feed = FileFeed(spark, tmp_path / "in", SCHEMA)
        got = []
        for part in first:
            feed.add(part)
            df = sliding_sum_stream(feed.stream(), 3600, 1800, small, tie_break="tie")
            for out in run_all(df, tmp_path, "update"):
                got += out
        return got

    cut = [live[i:i + 60] for i in range(0, len(live), 60)]
    got = run(cut)  # one start per file: every batch after the first is a restart
    assert len(got) == len(live)
    assert {(i, t): s for i, t, s in got} == {k: v for k, v in by_time.items() if k[1] >= cutoff}

    job = SlidingSumTable(spark, str(tmp_path / "table"), 3600, 1800, hot_rows=20)
    job.bootstrap(state)
    for number, part in enumerate(cut):
        job.process(spark.createDataFrame(part, SCHEMA), number)
    table = {(r.id, r.timestamp): r.running_sum for r in job.output.all().collect()}
    assert table == {k: v for k, v in by_time.items() if k[1] >= cutoff}


def test_stream_drops_late_rows(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", SCHEMA)
    run = LiveRun(sliding_sum_stream(feed.stream(), 3600, 1800), tmp_path, "update")
    run.feed(feed, [("1", at("01:00:00"), 5, 0)])
    run.feed(feed, [("1", at("00:59:59"), 7, 1)])
    run.feed(feed, [("1", at("01:00:01"), 1, 2)])
    assert [s for _, _, s in run.stop()] == [5, 6]


def test_idle_key_loses_its_state(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", SCHEMA)
    run = LiveRun(sliding_sum_stream(feed.stream(), 3600, 1800), tmp_path, "update")
    run.feed(feed, [("a", at("00:00:00"), 5, 0), ("b", at("00:00:00"), 1, 1)])
    run.feed(feed, [("b", at("00:40:00"), 2, 2)])
    run.feed(feed, [("b", at("03:00:00"), 3, 3)])
    run.feed(feed, [("b", at("03:10:00"), 4, 4), ("a", at("03:20:00"), 6, 5)])
    removed = sum(op["numRowsRemoved"] for p in run.query.recentProgress for op in p["stateOperators"])
    rows = run.stop()
    assert sorted(rows[:4]) == [("a", at("00:00:00"), 5), ("b", at("00:00:00"), 1), ("b", at("00:40:00"), 3), ("b", at("03:00:00"), 3)]
    assert sorted(rows[4:]) == [("a", at("03:20:00"), 6), ("b", at("03:10:00"), 7)]
    assert removed == 1  # the state of "a"; "b" went on and its timer was set again
