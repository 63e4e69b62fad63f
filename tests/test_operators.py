import datetime as dt
import json
import math
import random
from bisect import bisect_right

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions.predicates import Segment
from tidemill.operators import aggregate, changes, cluster, control, distinct, joins, latest, ordered, panes, paths, progress, sessions, sketch, skew

from tidemill.sources.tables import table

START = dt.datetime(2024, 1, 1)


# -- change merge ------------------------------------------------------------

def test_merge_golden(spark):
    target = spark.createDataFrame([(1, "v0"), (2, "v0")], "_id int, value string")
    feed = spark.createDataFrame([("U", 1, "v1", 0), ("I", 3, "v0", 1), ("U", 1, "v2", 2), ("D", 2, None, 3)],
                                 "oc string, _id int, value string, n int")
    newest = latest.newest_per_key(feed, ["_id"], ["n"])
    assert sorted(map(tuple, changes.merge_changes(target, newest, ["_id"]).collect())) == [(1, "v2"), (3, "v0")]


def test_merge_rules(spark):
    target = spark.createDataFrame([(i, f"old{i}", i) for i in range(6)], "k int, v string, n int")
    change = spark.createDataFrame(
        [("I", 0, "new"), (None, 1, "new"), ("U", 2, "new"), ("D", 3, None), ("X", 4, "new"),
         ("U", 10, "new"), (None, 11, "new"), ("D", 12, "new"), ("X", 13, "new")], "oc string, k int, v string")
    found = {r.k: (r.v, r.n) for r in changes.merge_changes(target, change, ["k"]).collect()}
    assert found == {0: ("old0", 0), 1: ("old1", 1), 2: ("new", None), 4: ("old4", 4), 5: ("old5", 5),
                     10: ("new", None), 13: ("new", None)}


def test_table_changes_golden(spark):
    t = spark.range(5)
    even = F.expr("id % 2 = 0")
    assert [r.id for r in changes.update_where(t, even, {"id": F.col("id") + 100}).collect()] == [100, 1, 102, 3, 104]
    assert [r.id for r in changes.delete_where(t, even).collect()] == [1, 3]
    assert sorted(r.id for r in changes.upsert(changes.delete_where(t, even), spark.range(20), ["id"]).collect()) == list(range(20))
    assert changes.delete_where(t, F.lit(None).cast("boolean")).count() == 5
    twice = spark.createDataFrame([(1, 2), (1, 3)], "id bigint, v int")
    with pytest.raises(Exception, match="several rows"):
        changes.upsert(t.withColumn("v", F.lit(0)), twice, ["id"]).collect()


# -- latest, words, windows -----------------------------------------------------

def test_latest_by_order(spark):
    df = spark.createDataFrame([(1, 1, 100.0, 0), (1, 2, 200.0, 1), (2, 5, 100.0, 2), (2, 5, 300.0, 3), (3, -1, 7.0, 4)],
                               "id int, ord bigint, data double, arrival bigint")
    found = {r[0]: r[1] for r in df.groupBy("id").agg(latest.latest_first_seen("data", "ord", "arrival")).collect()}
    assert found == {1: 200.0, 2: 100.0, 3: 7.0}


def test_map_merge_keeps_value_on_null(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "name string, value int")
    new = spark.createDataFrame([("a", None), ("b", 5), ("c", 6)], "name string, value int")
    assert sorted(map(tuple, latest.merge_latest_map(old, new, "name", "value").collect())) == [("a", 1), ("b", 5), ("c", 6)]


def test_top_k(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "word string, count bigint")
    assert [r.word for r in aggregate.top_k(counts, 2).collect()] == ["a", "b"]


def test_panes_equal_spark_windows(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(f"k{rng.randrange(3)}", START + dt.timedelta(seconds=rng.randrange(500)), i, rng.randrange(99)) for i in range(300)],
                               "k string, ts timestamp, id bigint, v bigint")
    def windows(agg):
        return {(r.k, r.w.start): r.x for r in df.groupBy("k", F.window("ts", "60 seconds", "20 seconds").alias("w")).agg(agg.alias("x")).collect()}
    def got(frame, name):
        return {(r.k, r.window_start): r[name] for r in frame.collect()}
    assert got(panes.sliding_count(df, ["k"], "ts", 60, 20), "n") == windows(F.count("*"))
    assert got(panes.sliding_latest(df, ["k"], "ts", "v", ["ts", "id"], 60, 20), "v") == windows(F.max_by("v", F.struct("ts", "id")))
    assert got(panes.sliding_average(df, ["k"], "ts", "v", 60, 20), "average") == pytest.approx(windows(F.avg("v")))
    with pytest.raises(ValueError):
        panes.sliding_count(df, ["k"], "ts", 50, 20)


def test_sessions_at_the_gap(spark):
    def sec(n, micros=0):
        return START + dt.timedelta(seconds=n, microseconds=micros)
    times = [sec(0), sec(9), sec(18, 999_999), sec(28, 999_999), sec(28, 999_999), sec(100)]
    found = sessions.idle_sessions(spark.createDataFrame([("a", t) for t in times], "k string, ts timestamp"), "k", "ts", 10)
    assert sorted((r.session_start, r.session_end, r["count"]) for r in found.collect()) == [
        (times[0], times[2], 3), (times[3], times[3], 2), (times[5], times[5], 1)]


def test_single_pass_equals_union_of_series(spark, data):
    """All segments and widths in one pass against one aggregate each."""
    from tidemill.functions.timefn import time_bucket
    from tidemill.plans.inputs import event_segments
    events = table(spark, data, "events")
    segments, widths = event_segments(), [600, 3600]
    each = [
        events.where(s.predicate).groupBy(time_bucket(F.col("ts"), w).alias("start_time"))
        .agg(F.countDistinct("user_id").alias("distinct_users"))
        .select(F.lit(s.name).alias("user_type"), F.lit(w).alias("window_s"), "start_time", "distinct_users")
        for s in segments for w in widths
    ]
    got = distinct.segment_distinct(events, segments, widths, "ts", "user_id").select(each[0].columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, distinct.union_series(each).collect()))
    latest_now = distinct.latest_windows(got).select("user_type", "window_s", "start_time")
    direct = distinct.latest_segment_windows(events, segments, widths, "ts", "user_id")
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, latest_now.collect()))


def test_newest_row_with_map_column(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"x": 2})], "k string, o int, m map<string,int>")
    assert latest.newest_per_key(df, ["k"], ["o"]).first().m == {"x": 2}
    assert latest.oldest_per_key(df, ["k"], ["o"]).first().m == {"x": 1}


# -- skew ---------------------------------------------------------------------

def _interval_rows(spark):
    rng = random.Random(5)
    left = [(i, 1 if rng.random() < 0.6 else rng.randrange(6), rng.randrange(4000)) for i in range(150)]
    right = [(i, 1 if rng.random() < 0.6 else rng.randrange(6), rng.randrange(4000)) for i in range(150)]
    left.append((900, None, 0))
    right.append((900, None, 0))
    make = lambda rows, p: spark.createDataFrame(rows, f"{p}id int, {p}k int, {p}s int").withColumn(
        f"{p}t", F.timestamp_seconds(F.col(f"{p}s") + 1_700_000_000))
    want = sorted((a, c) for a, k, s in left for c, m, u in right if k is not None and k == m and s <= u <= s + 600)
    return make(left, "a"), make(right, "b"), want


@pytest.mark.parametrize("hot_rows", [10**9, 10])
def test_interval_join_against_brute_force(spark, hot_rows):
    left, right, want = _interval_rows(spark)
    found = joins.within_interval(left, right, "ak", "bk", "at", "bt", 600, ["aid"], ["bid"], hot_rows=hot_rows)
    assert sorted((r.aid, r.bid) for r in found.collect()) == want


def test_interval_join_splits_hot_keys(spark):
    left, right, _ = _interval_rows(spark)
    bucketed = left.withColumn("b", F.floor(F.col("as") / 600))
    hot = skew.hot_groups(bucketed, ["ak", "b"], 10)
    assert hot is not None and hot.agg(F.max("_splits")).first()[0] >= 2
    assert skew.hot_groups(bucketed, ["ak", "b"], 10**6) is None


@pytest.mark.parametrize("hot_rows", [10**9, 30])
def test_running_sum_against_brute_force(spark, hot_rows):
    rng = random.Random(9)
    data = [(rng.choice(["h", "h", "h", "x", None]), rng.randrange(20), i, rng.randrange(-9, 9)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, o int, tie int, v int")
    total, want = {}, {}
    for k, o, tie, v in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        total[k] = total.get(k, 0) + v
        want[tie] = total[k]
    found = ordered.running_sum(df, ["k"], ["o", "tie"], "v", hot_rows=hot_rows)
    assert {r.tie: r.running for r in found.collect()} == want


def test_groups_are_hot_by_the_threshold_alone(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, F.col("id") % 50).otherwise(F.col("id")).alias("k"))
    hot = skew.hot_groups(rows, ["k"], 8)
    assert hot.count() == 50 and {r[0] for r in hot.select("_splits").distinct().collect()} == {3}  # 20 rows each


def test_more_segments_than_bits(spark):
    rows = spark.createDataFrame([(i % 140, f"u{i % 7}", dt.datetime(2024, 1, 1, 0, i % 3)) for i in range(280)], "n int, u string, ts timestamp")
    segments = [Segment(f"s{i}", F.col("n") % 140 == i) for i in range(140)]
    found = {r.user_type: r.distinct_users for r in distinct.segment_distinct(rows, segments, [3600], "ts", "u").collect()}
    assert found == {f"s{i}": 1 for i in range(140)}


def test_ordered_index(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("n"))
    assert [(r.n, r.idx) for r in ordered.ordered_index(df, ["n"]).orderBy("n").collect()] == [(i, i) for i in range(1000)]
    assert ordered.ordered_index(df.where("false"), ["n"]).count() == 0


# -- paths -----------------------------------------------------------------------

def group_by_rule(names, limit):
    """Shortest prefix with few enough paths, by definition."""
    out = {}
    for name in names:
        fits = [name[:n] for n in range(len(name) + 1) if sum(o.startswith(name[:n]) for o in names) <= limit]
        out[name] = fits[0] if fits else None
    return out


def _paths(spark, names):
    return spark.createDataFrame([(n,) for n in names], "path string")


@pytest.mark.parametrize("limit, want", [
    (1, {"a/b/1": "a/b/1", "a/b/2": "a/b/2", "a/c/1": "a/c/1", "a/c/2": "a/c/2"}),
    (2, {"a/b/1": "a/b", "a/b/2": "a/b", "a/c/1": "a/c", "a/c/2": "a/c"}),
    (3, {"a/b/1": "a/b", "a/b/2": "a/b", "a/c/1": "a/c", "a/c/2": "a/c"}),
    (4, dict.fromkeys(["a/b/1", "a/b/2", "a/c/1", "a/c/2"], "")),
])
def test_path_groups_golden(spark, limit, want):
    assert {r.path: r.prefix for r in paths.path_groups(_paths(spark, want), limit).collect()} == want


def test_path_conflict_is_an_error(spark):
    names = ["a/b", "a/b/1", "a/b/2", "a/c/1", "a/c/2"]
    with pytest.raises(ValueError, match="a/b is also a folder of a/b/1"):
        paths.path_groups(_paths(spark, reversed(names)), 1)
    assert paths.path_conflicts(_paths(spark, names)).collect() == [("a/b", "a/b/1")]
    assert paths.duplicate_paths(_paths(spark, names + ["a/b"])).collect() == [("a/b", 2)]
    assert paths.path_groups(_paths(spark, []), 1).count() == 0
    with pytest.raises(ValueError):
        paths.path_groups(_paths(spark, names), 0)


@settings(max_examples=12, deadline=None)
@given(st.sets(st.text("ab/é𝄞", min_size=1, max_size=5), min_size=1, max_size=25), st.integers(1, 7))
def test_path_groups_against_rule(spark, names, limit):
    found = {r.path: r.prefix for r in paths.path_groups(_paths(spark, names), limit, strict=False).collect()}
    assert found == group_by_rule(names, limit)


# -- sketches and quantiles ----------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles(spark, seed):
    rng = random.Random(seed)
    values = sorted(rng.randrange(60) * 0.5 for _ in range(777))
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    probs = [0.0, 0.1, 0.25, 0.33, 0.5, 0.75, 0.9, 1.0]
    found = {r.probability: r.value for r in sketch.quantiles_exact(df, "v", probs).collect()}
    assert found == dict(zip(probs, df.where("v IS NOT NULL").approxQuantile("v", probs, 0.0)))
    assert sketch.quantiles_exact(df.where("false"), "v", probs).count() == 0


@pytest.mark.parametrize("shape", ["unique", "hot", "dates"])
def test_exact_quantiles_inside_brackets(spark, shape):
    """Enough rows for brackets that leave most rows out; a third of the rows may be equal."""
    n = 30000
    value = {
        "unique": (F.col("id") * 7919 % n).cast("double"),
        "hot": F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000),
        "dates": F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 31 % n).cast("int")),
    }[shape]
    df = spark.range(n).select(value.alias("v"))
    ordered_values = sorted(r.v for r in df.collect())
    probs = [0.0, 0.001, 0.25, 0.251, 0.5, 0.9, 1.0]
    found = {r.probability: r.value for r in sketch.quantiles_exact(df, "v", probs).collect()}
    assert found == {p: ordered_values[max(1, math.ceil(p * n - 1e-9)) - 1] for p in probs}


def test_exact_quantiles_without_brackets(spark, monkeypatch):
    """Brackets that miss the quantile lead to the full sort."""
    monkeypatch.setattr(sketch, "_disjoint", lambda brackets: [(-2, -1)])
    df = spark.range(1000)
    assert {r.probability: r.value for r in sketch.quantiles_exact(df, "id", [0.25, 1.0]).collect()} == {0.25: 249, 1.0: 999}


@pytest.mark.parametrize("error", [0.05, 0.1])
def test_approx_quantiles(spark, error):
    n = 20000
    df = spark.range(n)
    for r in sketch.quantiles_approx(df, "id", [0, 0.25, 0.5, 0.75, 1], error).collect():
        assert abs(r.value / n - r.probability) <= error + 1e-4


def test_theta(spark):
    df = spark.range(50000).select((F.col("id") % 20000).alias("u"), (F.col("id") % 3).alias("p"))
    stored = sketch.theta_sketches(df, ["p"], "u").unionByName(
        spark.createDataFrame([(9, None)], "p bigint, sketch binary"))
    estimate = sketch.theta_union(stored).select(sketch.theta_estimate()).first()[0]
    assert abs(estimate / 20000 - 1) <= 0.05


def test_kll(spark):
    stored = sketch.kll_sketches(spark.range(100000).withColumn("p", F.col("id") % 4), ["p"], "id")
    merged = sketch.kll_union(stored)
    row = merged.select(sketch.kll_quantile("sketch", 0.5), sketch.kll_rank("sketch", 25000),
                        sketch.kll_mass("sketch", [50000.0])).first()
    assert abs(row[0] / 100000 - 0.5) < 0.02 and abs(row[1] - 0.25) < 0.02
    assert row[2][0] == pytest.approx(0.5, abs=0.02) and sum(row[2]) == pytest.approx(1)
    small = sketch.kll_sketches(spark.range(101), [], "id").select(
        sketch.kll_rank("sketch", 50), sketch.kll_mass("sketch", [50.0])).first()
    assert small[0] == pytest.approx(51 / 101) and small[1][0] == pytest.approx(50 / 101)


def test_histogram_of_two_normals(spark):
    rng = random.Random(3)
    values = sorted(rng.gauss(mean, 1) for mean in (0, 1) for _ in range(2000))
    found = {r.bin: (r.frequency, r.mass) for r in
             sketch.histogram(spark.createDataFrame([(v,) for v in values] + [(2.0,), (-2.0,)], "v double"), "v", [2, -2, 0]).collect()}
    edges = [-2, 0, 2]
    want = [0] * 4
    for v in [*values, 2.0, -2.0]:
        want[bisect_right(edges, v)] += 1
    assert [found[i][0] for i in range(4)] == want
    assert sum(m for _, m in found.values()) == pytest.approx(1)


# -- clusters ---------------------------------------------------------------------------

def test_cluster_ranges_golden(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 50, 51, 53, 58, 100, 102, 105)], "v int")
    assert [tuple(r) for r in cluster.cluster_ranges(df, "v").collect()] == [(1.0, 4.0, 4), (50.0, 58.0, 4), (100.0, 105.0, 3)]


def test_hex_ranges(spark):
    groups = [0x64000000, 0x65000000, 0x66000000]
    ids = [f"{g + i:08x}{'0' * 16}" for g in groups for i in range(3)]
    found = cluster.hex_id_ranges(spark.createDataFrame([(i,) for i in ids], "id string"), "id", k=3)
    assert [(r.left_hex, r.right_hex, r.n) for r in found.collect()] == [(f"{g:08x}", f"{g + 2:08x}", 3) for g in groups]
    assert cluster.hex_id_ranges(spark.createDataFrame([], "id string"), "id").count() == 0


# -- commands and progress -------------------------------------------------------------

def test_control(spark):
    texts = ['{"topic_name":"a","operation":"START"}', '{"topic_name":"b","operation":"start"}', '{"topic_name":"b","operation":"cancel"}',
             '{"topic_name":"c","operation":"cancel"}', '{"topic_name":"d","operation":"start"}', '{"topic_name":"e","operation":"halt"}',
             '{"operation":"start"}', '{"topic_name":"f"}', "junk"]
    commands = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    active = spark.createDataFrame([("Stream-for-b",), ("Stream-for-d",)], "stream_name string")
    found = {r.topic_name: (r.action, r.reason) for r in control.control_actions(commands, active, "value", "n").collect()}
    assert found == {"a": ("start", None), "b": ("cancel", None), "c": ("skip", "not active"), "d": ("skip", "already active")}
    reasons = sorted(json.loads(r.dead_letter)["failed_reason"] for r in control.control_rejects(commands).collect())
    assert reasons == ["missing field: operation", "missing field: topic_name", "missing field: topic_name", "unknown operation: halt"]


def test_progress(spark):
    def record(batch, n, start):
        return json.dumps({"name": "q", "batchId": batch, "numInputRows": n, "durationMs": {"latestOffset": 4}, "extra": 1, "sources": [
            {"startOffset": start, "endOffset": {"t": {"0": 5, "1": 7}}, "inputRowsPerSecond": 1.5, "processedRowsPerSecond": 2.5}]})
    df = spark.createDataFrame([(record(0, 3, None),), (record(1, 0, None),), (record(2, 4, {"t": {"0": 2}}),)], "value string")
    found = [(r.batch_id, r.partition, r.start_offset, r.end_offset) for r in progress.progress_table(df).orderBy("batch_id", "partition").collect()]
    assert found == [(0, 0, None, 5), (0, 1, None, 7), (2, 0, 2, 5), (2, 1, None, 7)]
