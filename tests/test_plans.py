"""What the plans of the registered queries must and must not hold."""

import contextlib
import io

import pytest

from tidemill.plans import registry

TABLE_QUERIES = [n for n in sorted(registry.queries()) if not n.startswith(("stream_", "kmeans_"))]


def plan_of(df, mode=None) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode) if mode else df.explain()
    return text.getvalue()


@pytest.fixture()
def no_small_tables(spark):
    """Plan as for large inputs: nothing is broadcast unless the code says so."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_pairwise_joins_and_no_single_task_windows(spark, data, no_small_tables, name):
    plan = plan_of(registry.queries()[name](spark, data))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for above, below in zip(lines, lines[1:]):
        assert not ("Sort [" in above and "SinglePartition" in below), above
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python


@pytest.mark.parametrize("name, exchanges", [
    ("cdc_merge", 2), ("latest_map_merge", 2), ("segment_distinct", 2), ("dedup_first_seen", 1),
    ("sliding_window_count", 2), ("word_counts", 1), ("bucket_sum", 1), ("table_upsert", 2), ("idle_sessions", 2),
])
def test_number_of_shuffles(spark, data, no_small_tables, name, exchanges):
    plan = plan_of(registry.queries()[name](spark, data))
    assert plan.count("Exchange hashpartitioning") == exchanges, plan


@pytest.mark.parametrize("name, part", [
    ("cutoff_filter", "GreaterThanOrEqual(ts,"),
    ("key_range_lookup", "EqualTo(o_custkey,370)"),
    ("interval_join", "EqualTo(event_type,view)"),
    ("stream_static_left", "EqualTo(c_mktsegment,BUILDING)"),
])
def test_filters_reach_the_scan(spark, data, name, part):
    pushed = [line for line in plan_of(registry.queries()[name](spark, data), "formatted").splitlines() if "PushedFilters" in line]
    assert any(part in line for line in pushed), pushed


@pytest.mark.parametrize("name, columns", [
    ("word_counts", "struct<text:string>"),
    ("counts_by_type", "struct<event_type:string>"),
    ("segment_distinct", "struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>"),
    ("sliding_bootstrap_state", "struct<ts:timestamp_ntz,user_id:bigint,value:double>"),
])
def test_only_needed_columns_are_read(spark, data, name, columns):
    plan = plan_of(registry.queries()[name](spark, data), "formatted")
    assert f"ReadSchema: {columns}" in plan, plan


def test_bucketed_merge_leaves_the_base_in_place(spark, data, no_small_tables):
    plan = plan_of(registry.queries()["cdc_merge_bucketed"](spark, data))
    base = next(i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
    assert plan.count("Exchange hashpartitioning") == 1
    lines = plan.splitlines()
    depth = lines[base].index("FileScan")
    above = [line for line in lines[:base] if "Exchange" in line and line.index("Exchange") < depth]
    assert not above, plan


def test_lookup_reads_few_rows(spark, data):
    found = registry.queries()["key_lookup_sorted"](spark, "/root/testdata/sf0.1")
    rows = len(found.collect())
    plan = found._jdf.queryExecution().executedPlan()
    while plan.children().nonEmpty():
        plan = plan.children().head()
    read = plan.metrics().apply("numOutputRows").value()
    assert 0 < rows <= read <= spark.read.parquet("/root/testdata/sf0.1/orders.parquet").count() / 10


def test_user_aggregate_sends_buffers_only(spark, data):
    plan = plan_of(registry.queries()["user_latest"](spark, data))
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line)
    below = plan.split(exchange, 1)[1]
    assert plan.count("Exchange") == 1 and "MapInArrow" in below and "_buffer" in below


def test_user_sets_meet_before_they_become_rows_per_segment(spark, data, no_small_tables):
    plan = plan_of(registry.queries()["user_state_merge"](spark, data))
    assert plan.count("Exchange hashpartitioning") == 2, plan
    above, below = plan.split("Generate explode(", 1)
    assert "user_id" not in above.split("HashAggregate", 1)[1], plan
    assert below.count("functions=[bit_or") + below.count("functions=[partial_bit_or") == 2 and "Union" in below, plan
