"""User aggregates, bucketed tables, saved maps, exact clusters and bounded runs on small fixtures."""

import random
from bisect import bisect_left

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from streams import FileFeed

from tidemill.operators import cluster, user_aggregate
from tidemill.operators.user_aggregate import Average, Newest
from tidemill.plans import feeds, inputs
from tidemill.sources.buckets import BucketedTable
from tidemill.sources.changelog import ChangeLog
from tidemill.streaming import sinks
from tidemill.streaming import tables as jobs


def means(frame, *keys):
    return {tuple(r[k] for k in keys): r["m"] for r in frame.collect()}


def test_average_by_key_and_over_all(spark):
    rows = [("a", 10), ("a", 20), ("a", 15), ("b", 10), ("b", 25), ("b", None), (None, 4), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v bigint").repartition(3)
    assert means(user_aggregate.user_aggregate(df, ["k"], Average("v"), "m"), "k") == {("a",): 15, ("b",): 17.5, (None,): 4, ("c",): None}
    assert means(user_aggregate.user_aggregate(df, [], Average("v"), "m")) == {(): 14}
    empty = df.where("false")
    assert means(user_aggregate.user_aggregate(empty, [], Average("v"), "m")) == {(): None}
    assert user_aggregate.user_aggregate(empty, ["k"], Average("v"), "m").count() == 0


def test_sums_beyond_64_bits_and_odd_keys(spark):
    big = 2**62
    df = spark.createDataFrame([(float("nan"), big), (float("nan"), big), (float("nan"), big), (1.0, -big)], "k double, v bigint").coalesce(1)
    got = sorted(((str(r.k), r.m) for r in user_aggregate.user_aggregate(df, ["k"], Average("v"), "m").collect()))
    assert got == [("1.0", -float(big)), ("nan", float(big))]


def test_many_keys_leave_a_task_in_parts(spark, monkeypatch):
    monkeypatch.setattr(user_aggregate, "BUFFERS_A_TASK", 10)
    df = spark.range(0, 5000, 1, 2).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"), F.col("id").alias("t"))
    got = means(user_aggregate.user_aggregate(df, [(F.col("k") % 50).alias("z"), "k"], Newest("v", "t", "v", "bigint"), "m"), "z", "k")
    assert got == {(k % 50, k): max(range(k, 5000, 97)) for k in range(97)}


def test_buffers_of_several_runs_merge(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    parts = [user_aggregate.partial_buffers(df.where(F.col("v") % 4 == i), ["k"], Average("v")) for i in range(4)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    want = {(r.k,): r.m for r in df.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    assert means(user_aggregate.merged_buffers(whole, Average("v"), "m"), "k") == want


def test_newest_prefers_the_first_to_arrive(spark):
    rows = [("a", 1.0, 5, 1), ("a", 2.0, 9, 3), ("a", 3.0, 9, 2), ("a", 4.0, None, 0), ("b", None, 1, 1), ("c", 1.0, None, 1)]
    df = spark.createDataFrame(rows, "k string, v double, t bigint, i bigint")
    got = means(user_aggregate.user_aggregate(df, ["k"], Newest("v", "t", "i", "double"), "m"), "k")
    assert got == {("a",): 3.0, ("b",): None, ("c",): None}


def plain_clusters(values, k):
    values = sorted(values)
    n = len(values)
    bounds = sorted({b for i in range(1, k) if (b := values[-(-i * n // k) - 1]) < values[-1]})
    while True:
        groups = [[] for _ in range(len(bounds) + 1)]
        for v in values:
            groups[bisect_left(bounds, v)].append(v)
        groups = [g for g in groups if g]
        moved = [(sum(a) * len(b) + sum(b) * len(a)) // (2 * len(a) * len(b)) for a, b in zip(groups, groups[1:])]
        if moved == bounds:
            return [(g[0], g[-1], len(g)) for g in groups]
        bounds = moved


@pytest.mark.parametrize("fanout", [64, 1 << 16])
def test_clusters_equal_plain_rounds(spark, monkeypatch, fanout):
    monkeypatch.setattr(cluster, "FANOUT", fanout)
    rnd = random.Random(fanout)
    for k, values in ((3, [rnd.randrange(-5000, 5000) for _ in range(400)]), (6, [int(rnd.lognormvariate(8, 2)) for _ in range(300)]),
                      (4, [7] * 50 + [8, 9]), (3, [-(10**8), 0, 10**8, 5])):
        df = spark.createDataFrame([(v,) for v in values], "v bigint")
        assert cluster.whole_ranges(df, k) == plain_clusters(values, k)
    assert cluster.whole_ranges(df.where("false"), 3) == []


def test_clusters_do_not_depend_on_partitions(spark):
    df = spark.range(2000).select((F.col("id") * F.col("id") % 7919).alias("v"))
    assert cluster.whole_ranges(df.repartition(1), 3) == cluster.whole_ranges(df.repartition(13, "v"), 3)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


def test_bucketed_table(spark, tmp_path):
    table = BucketedTable(spark, f"bucketed_{tmp_path.name.replace('-', '_')}".lower(), str(tmp_path / "log"), ["id"], 4)
    table.create(spark.createDataFrame([(i, f"v{i}") for i in range(6)], "id bigint, value string"))
    schema = "id string, value string, oc string, at int"
    table.append(spark.createDataFrame([("1", "x", "U", 1), ("1", "y", "U", 2), ("2", None, "D", 1), ("9", "n", "I", 1)], schema), ["at"], 0)
    after_first = [(0, "v0"), (1, "y"), (3, "v3"), (4, "v4"), (5, "v5"), (9, "n")]
    assert rows_of(table.read()) == after_first
    table.fold(0)
    table.fold(0)  # a repeated fold is harmless
    assert table.versions() == [0, 1] and rows_of(table.read()) == after_first and rows_of(table.base(1)) == after_first
    table.append(spark.createDataFrame([("1", "late", "U", 9)], schema), ["at"], 0)  # the folded batch comes again
    table.append(spark.createDataFrame([("2", "back", "I", 1), ("9", None, "D", 1)], schema), ["at"], 1)
    after_second = [(0, "v0"), (1, "y"), (2, "back"), (3, "v3"), (4, "v4"), (5, "v5")]
    assert rows_of(table.read()) == after_second
    assert rows_of(table.read(0)) == after_first and rows_of(table.read(-1)) == [(i, f"v{i}") for i in range(6)]
    table.drop(0)
    with pytest.raises(ValueError):
        table.read(-1)
    with pytest.raises(ValueError):
        table.drop(1)
    assert rows_of(table.read()) == after_second


def test_saved_map_opens_few_files(spark, tmp_path):
    fields = spark.createDataFrame([], "k string, v bigint, t bigint").schema
    job = jobs.SavedMap(spark, str(tmp_path), fields, "k", "v", ["t"], every=10)
    want = {}
    for i in range(25):
        rows = [(f"k{i % 7}", i, i), (f"n{i}", None, i), ("old", 100 - i, -i)]
        if i == 13:
            rows.append(("k0", None, 99))
        job.process(spark.createDataFrame(rows, fields).coalesce(1), i)
        want.update({f"k{i % 7}": i, f"n{i}": None, "old": 100})
        if i in (10, 20):
            job.process(spark.createDataFrame(rows, fields).coalesce(1), i)  # a repeated batch
    assert dict(map(tuple, job.read().collect())) == want
    opened = {path.rsplit("/", 2)[-2] for path in job.parts().inputFiles()}
    assert opened == {"batch=19", "batch=20", "batch=21", "batch=22", "batch=23", "batch=24"}
    assert dict(map(tuple, job.read(9).collect()))["k2"] == 9 and dict(map(tuple, job.read(12).collect()))["k5"] == 12
    assert job.saved.batches() == [9, 19]
    job.saved.write(24, spark.createDataFrame([("junk", 1, 1)], fields))  # a save whose batch never came
    assert dict(map(tuple, job.read().collect())) == want


def test_bounded_run_stops_and_goes_on(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "n int")
    for n in range(6):
        feed.add([(n,)])
    seen = {}

    def writer():
        return feed.stream().writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(
            lambda batch, i: seen.__setitem__(i, [r.n for r in batch.collect()])
        )

    sinks.run_batches(writer(), 2, 60)
    assert 2 <= len(seen) <= 4
    writer().trigger(availableNow=True).start().awaitTermination()
    assert seen == {i: [i] for i in range(6)}
    with pytest.raises(TimeoutError):
        sinks.run_batches(writer(), 1, 1)


def test_bounded_run_raises_what_the_query_raised(spark, tmp_path):
    feed = FileFeed(spark, tmp_path / "in", "n int")
    feed.add([(1,)])

    def fail(batch, batch_id):
        raise ValueError("no good")

    writer = feed.stream().writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(fail)
    with pytest.raises(Exception, match="no good"):
        sinks.run_batches(writer, 1, 60)


def test_newest_of_many_keys_at_once(monkeypatch):
    """The same as key by key, nulls and ties included."""
    draw = random.Random(3)
    some = [[draw.choice([None, *range(6)]) for _ in range(3)] for _ in range(3000)]
    rows = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some)], names=["v", "t", "i"])
    starts = [0, *sorted(draw.sample(range(1, 3000), 900))]
    held = [draw.choice([None, (7, 5, 1), (8, 0, 0)]) for _ in starts]
    want = []
    for buffer, lo, hi in zip(held, starts, [*starts[1:], 3000]):
        known = [tuple(r) for r in some[lo:hi] if None not in r[1:]] + ([buffer] if buffer else [])
        want.append(max(((t, -i) for _, t, i in known), default=None))
    monkeypatch.setattr(Newest, "reduce", None)  # not once per key
    got = Newest("v", "t", "i", "bigint").reduce_runs(held, rows, starts)
    assert [b and (b[1], -b[2]) for b in got] == want


def test_changes_for_one_table_are_not_cached(spark, data, tmp_path, monkeypatch):
    """Its records are read once, straight into the log; two tables share them."""
    batch, cached = inputs.order_changes(spark, data), []
    kind, keep = type(batch), type(batch).persist
    monkeypatch.setattr(kind, "persist", lambda self, *a: cached.append(1) or keep(self, *a))

    def run(*names):
        logs = [ChangeLog(inputs.order_target(spark, data), str(tmp_path / f"{len(names)}-{n}"), ["o_orderkey"]) for n in names]
        targets = {n: jobs.CdcTarget(log, feeds.ORDER_KEY, feeds.ORDER_VALUE) for n, log in zip(names, logs)}
        jobs.CdcMerge(targets).process(batch, 0)
        return logs[0].read().count()

    one = run(inputs.NAMESPACE)
    assert not cached
    assert run(inputs.NAMESPACE, "shop.other") == one and cached
