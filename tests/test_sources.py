import datetime as dt
import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemill.session import scratch_path, shared_dir
from tidemill.sources import envelope as env
from tidemill.sources import jdbc, sinks
from tidemill.sources.batches import BatchFolder
from tidemill.sources.changelog import ChangeLog
from tidemill.sources.generate import number_range
from tidemill.sources.tables import catalog_table, save_as_table
from tidemill.operators.changes import merge_changes
from tidemill.operators.latest import newest_per_key

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_offset_texts():
    assert env.from_earliest("t", 2) == '{"t":{"0":-2,"1":-2}}'
    assert env.from_latest("t", 1) == '{"t":{"0":-1}}'
    assert env.offsets_text({"t": {0: 5}, "u": {1: 7}}) == '{"t":{"0":5},"u":{"1":7}}'
    with pytest.raises(ValueError):
        env.offsets_text({"t": {0: -3}})


def test_kafka_options():
    options = env.kafka_options(
        "h:1", ["a", "b"], starting={"a": {0: -2}}, starting_timestamps={"a": {0: 1000}}, ending="latest",
        min_partitions=4, include_headers=True, extra={"kafka.security.protocol": "SSL"})
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": '{"a":{"0":-2}}', "endingOffsets": "latest",
        "startingOffsetsByTimestamp": '{"a":{"0":1000}}', "minPartitions": "4", "includeHeaders": "true",
        "kafka.security.protocol": "SSL"}
    assert json.loads(env.kafka_options("h:1", assign={"t": [2, 0]})["assign"]) == {"t": [0, 2]}
    with pytest.raises(ValueError):
        env.kafka_options("h:1")


@pytest.fixture(scope="module")
def records(spark):
    moment = dt.datetime(2024, 1, 1)
    values = [("t", p, o, moment + dt.timedelta(minutes=o)) for p in (0, 1) for o in range(5)]
    return spark.createDataFrame(values, "topic string, partition int, offset bigint, timestamp timestamp").withColumn(
        "value", F.col("offset").cast("string").cast("binary"))


def test_offset_range_end_is_exclusive(records):
    found = env.offset_range(records, {"t": {0: 1}}, {"t": {0: 3}}).select("partition", "offset").collect()
    assert sorted(map(tuple, found)) == [(0, 1), (0, 2)]


def test_start_by_timestamp(records):
    found = env.from_timestamps(records, {"t": {0: "2024-01-01 00:03:00", 1: "2025-01-01 00:00:00"}})
    assert sorted(map(tuple, found.select("partition", "offset").collect())) == [(0, 3), (0, 4)]
    assert env.assign_partitions(records, {"t": [1]}).count() == 5
    new_partition = env.from_timestamps(records, {"t": {0: "2024-01-01 00:03:00"}})
    assert new_partition.where("partition = 1").count() == 5  # a partition without a time starts at its earliest


def test_offsets_json(records):
    assert env.offsets_json(records, "end").first().offsets == '{"t":{"0":5,"1":5}}'
    assert env.offsets_json(records, "earliest").first().offsets == env.from_earliest("t", 2)
    assert env.offsets_json(records, "latest").first().offsets == env.from_latest("t", 2)
    assert env.spread(records, 4, 2).rdd.getNumPartitions() == 4


def test_envelope_json_is_base64(records):
    line = json.loads(sinks.envelope_json(records.where("partition = 0 AND offset = 0")).first().value)
    assert line["value"] == "MA==" and line["topic"] == "t"


def test_batch_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, v string")
    for _ in range(2):
        sinks.write_csv(df, str(tmp_path / "c"))
        sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.schema("n int, v string").csv(str(tmp_path / "c")).collect() == df.collect()
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    sinks.append_rejects(spark.createDataFrame([("x",)], "dead_letter string"), str(tmp_path / "d"))
    assert spark.read.text(str(tmp_path / "d")).first().value == "x"
    save_as_table(df, "tidemill_saved")
    with pytest.raises(Exception, match="(?i)already exists"):
        save_as_table(df, "tidemill_saved")
    save_as_table(df, "tidemill_saved", "overwrite")
    assert catalog_table(spark, "tidemill_saved").count() == 1


def test_range(spark):
    assert [r.id for r in number_range(spark, 2, 5, 2).collect()] == [2, 3, 4]


@pytest.fixture(scope="module")
def database(spark):
    url = "jdbc:derby:memory:tidemill;create=true"
    df = spark.range(100).select(F.col("id").cast("int").alias("ID"), (F.col("id") % 3).cast("int").alias("KIND"),
                                 F.concat(F.lit("n"), F.col("id").cast("string")).alias("NAME"))
    df.write.format("jdbc").options(url=url, dbtable="ITEMS", **DERBY).mode("overwrite").save()
    return url


def test_jdbc_strides(spark, database):
    source = '(SELECT ID, KIND FROM ITEMS) T'
    assert jdbc.column_bounds(spark, database, source, "ID", DERBY) == (0, 100)
    auto = jdbc.read_strides(spark, database, source, "ID", 4, options=DERBY)
    assert auto.rdd.getNumPartitions() == 4 and auto.count() == 100
    narrow = jdbc.read_strides(spark, database, source, "ID", 3, bounds=(40, 60), options=DERBY)
    assert narrow.count() == 100  # bounds do not filter


def test_jdbc_predicates_query_and_first_row(spark, database):
    found = jdbc.read_predicates(spark, database, "ITEMS", ['"KIND" = 0', '"KIND" = 1'], options=DERBY)
    assert found.rdd.getNumPartitions() == 2 and found.count() == 67  # kind 2 is not read
    assert jdbc.read_query(spark, database, "SELECT * FROM ITEMS", DERBY).count() == 100
    assert jdbc.first_row(spark, database, "SELECT NAME FROM ITEMS", "NAME", DERBY).first().NAME == "n0"


def test_change_log_versions_and_replays(spark, tmp_path):
    log = ChangeLog(spark.range(200).withColumn("v", F.lit(0)), str(tmp_path / "t"), ["id"])
    assert log.read().count() == 200
    schema = "id bigint, oc string, v int, seq int"
    for _ in range(2):
        log.append(spark.createDataFrame([(7, "U", 1, 1), (7, "U", 2, 2)], schema), ["seq"], 0)
    log.append(spark.createDataFrame([], schema), ["seq"], 1)
    assert log.read(1).where("v = 2").first().id == 7 and log.read(1).count() == 200
    log.append(spark.createDataFrame([(i, "D", 0, 0) for i in range(200)], schema), ["seq"], 2)
    assert log.read().count() == 0 and log.read().columns == ["id", "v"]
    assert log.read(-1).where("v = 0").count() == 200 and log.read(0).where("v = 2").count() == 1


def test_change_log_equals_merging_batch_by_batch(spark, tmp_path):
    rng = random.Random(5)
    table = spark.createDataFrame([(i, f"base{i}") for i in range(0, 60, 2)], "id bigint, v string")
    log = ChangeLog(table, str(tmp_path / "t"), ["id"])
    for batch in range(6):
        rows = [(rng.randrange(60), rng.choice(["I", "I", "U", "D", None]), f"b{batch}-{n}", n) for n in range(50)]
        part = spark.createDataFrame(rows, "id bigint, oc string, v string, seq int")
        log.append(part, ["seq"], batch)
        merged = merge_changes(table, newest_per_key(part, ["id"], ["seq"]), ["id"])
        table = spark.createDataFrame(merged.collect(), "id bigint, v string")
        assert sorted(map(tuple, log.read().collect())) == sorted(map(tuple, table.collect()))


def test_change_log_casts_keys_and_fills_missing_columns(spark, tmp_path):
    log = ChangeLog(spark.range(200).selectExpr("id", "'a' AS v"), str(tmp_path / "t"), ["id"])
    log.append(spark.createDataFrame([(i, "b", "U", i) for i in range(5)], "id int, v string, oc string, nr int"), ["nr"], 0)
    log.append(spark.createDataFrame([(9, "U", 1)], "id int, oc string, nr int"), ["nr"], 1)
    rows = {r.id: r.v for r in log.read().collect()}
    assert len(rows) == 200 and [rows[i] for i in range(6)] == ["b"] * 5 + ["a"] and rows[9] is None


def test_batch_folder(spark, tmp_path):
    folder = BatchFolder(spark, str(tmp_path / "b"), "id bigint")
    assert folder.previous(0).count() == 0 and folder.all().count() == 0
    folder.write(0, spark.range(2))
    folder.write(1, spark.range(3))
    folder.write(1, spark.range(4))
    assert folder.previous(1).count() == 2 and folder.all().count() == 6
    assert sorted((r.batch, r.id) for r in folder.rows().where("batch = 0").collect()) == [(0, 0), (0, 1)]
    with pytest.raises(AnalysisException):
        folder.read(5)
    with pytest.raises(ValueError):
        BatchFolder(spark, str(tmp_path / "c"), "batch bigint")


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark)) and scratch_path(spark, "x") != scratch_path(spark, "x")
