"""Tables written through each sink, read back through its source, and compared row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.timefn import guarded_bucket_of
from tidemill.plans import inputs
from tidemill.session import scratch_path
from tidemill.sources import files, tables
from tidemill.sources import sinks as batch_sinks
from tidemill.sources.tables import raw_table, zoneless
from tidemill.streaming import sinks

_EVENT = "event_id bigint, user_id bigint, event_type string, cents bigint"


def _events(spark, folder) -> DataFrame:
    return inputs.events(spark, folder).select("event_id", "user_id", "event_type", "cents")


def _arrived(stream: DataFrame, base: str) -> DataFrame:
    """All rows of a stream of files, kept as parquet."""
    writer = stream.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint")
    sinks.triggered(writer).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/rows")


def csv_stream_sep(spark, folder):
    """CSV files with a separator of their own, as a stream."""
    base = scratch_path(spark, "csv")
    batch_sinks.write_csv(_events(spark, folder), f"{base}/in", sep=";")
    return _arrived(files.stream_csv(spark, f"{base}/in", _EVENT, sep=";", max_files=2), base)


def partition_folders(spark, folder):
    """Files in ``event_type=`` folders: the folder is a column of the stream."""
    base = scratch_path(spark, "folders")
    _events(spark, folder).write.partitionBy("event_type").parquet(f"{base}/in")
    stream = files.stream_files(spark, f"{base}/in", _EVENT, max_files=3)
    return _arrived(stream, base).select("event_id", "user_id", "event_type", "cents")


def _lines(spark, folder) -> DataFrame:
    return _events(spark, folder).select(F.concat_ws(" ", "event_id", "event_type").alias("value"))


def text_lines(spark, folder):
    """Lines of text files as a table."""
    base = scratch_path(spark, "text")
    _lines(spark, folder).write.text(f"{base}/in")
    return files.read_lines(spark, f"{base}/in")


def text_lines_stream(spark, folder):
    """The same lines as a stream."""
    base = scratch_path(spark, "text")
    _lines(spark, folder).write.text(f"{base}/in")
    return _arrived(files.stream_lines(spark, f"{base}/in", max_files=2), base)


def catalog_round_trip(spark, folder):
    """A catalog table saved, replaced and read by name; its files are in the shared folder."""
    path = scratch_path(spark, "catalog")
    name = "t_" + path.rsplit("-", 1)[1]
    tables.save_as_table(_events(spark, folder).where("event_id < 0"), name, path=path)
    tables.save_as_table(_events(spark, folder), name, mode="overwrite", path=path)
    return tables.catalog_table(spark, name)


def csv_json_round_trip(spark, folder):
    """Each event once from its CSV file and once from its JSON file."""
    base = scratch_path(spark, "rows")
    batch_sinks.write_csv(_events(spark, folder), f"{base}/csv", header="true")
    batch_sinks.write_json(_events(spark, folder), f"{base}/json")
    from_csv = spark.read.schema(_EVENT).option("header", True).csv(f"{base}/csv").withColumn("form", F.lit("csv"))
    return from_csv.unionByName(spark.read.schema(_EVENT).json(f"{base}/json").withColumn("form", F.lit("json")))


def ingest_per_topic(spark, folder):
    """A topic per event type, each ingested by its own query to its own folder; records per topic from the files."""
    base = scratch_path(spark, "topics")
    source = raw_table(spark, folder, "events")
    topics = [r[0] for r in source.where("event_type IS NOT NULL").select("event_type").distinct().orderBy("event_type").collect()]

    def envelope(topic: str) -> DataFrame:
        rows = tables.table_stream(spark, folder, "events").where(F.col("event_type") == topic)
        records = inputs.envelope_of(rows.withColumn("cents", inputs.cents("value")))
        return records.drop("headers").withColumn("topic", F.lit(topic))

    for query in sinks.per_topic(envelope, topics, f"{base}/out"):
        query.awaitTermination()
    schema = "value string, topic string, partition int, offset bigint"
    counted = None
    for topic in topics:
        written = spark.read.schema(schema).json(f"{base}/out/{topic}").withColumn("folder", F.lit(topic))
        counted = written if counted is None else counted.unionByName(written)
    payload = F.from_json(F.unbase64("value").cast("string"), inputs.PAYLOAD)
    return counted.groupBy("folder", "topic").agg(F.count(F.lit(1)).alias("n"), F.sum(payload["value"]).alias("cents"))


def guarded_bucket_sum(spark, folder):
    """Sums per half hour with the guard against epochs in seconds."""
    rows = inputs.events(spark, folder).groupBy("user_id", guarded_bucket_of(F.col("ts"), 1800).alias("bucket_start"))
    return zoneless(rows.agg(F.sum("cents").alias("bucket_sum")))


def listed_files(spark, folder):
    """Rows per file name of files written by event type, joined with the listing of what was written."""
    base = scratch_path(spark, "listing")
    _events(spark, folder).write.partitionBy("event_type").parquet(f"{base}/in")
    kind = F.regexp_extract("path", "/event_type=([^/]+)/", 1)
    listed = files.list_files(spark, f"{base}/in").where(F.col("path").endswith(".parquet"))
    seen = spark.read.parquet(f"{base}/in").groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    name = lambda c: F.substring_index(c, "/in/", -1)
    both = listed.withColumn("event_type", kind).join(seen, name(F.col("path")) == name(F.col("file")), "full_outer")
    return both.groupBy("event_type").agg(F.sum("n").alias("n"), F.min(F.col("length") > 0).alias("filled"))


_ROWS = "SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events"
_TEXT = "SELECT concat_ws(' ', event_id, event_type) AS value FROM events"

QUERIES = {
    "csv_stream_sep": (csv_stream_sep, _ROWS),
    "partition_folders": (partition_folders, _ROWS),
    "text_lines": (text_lines, _TEXT),
    "text_lines_stream": (text_lines_stream, _TEXT),
    "catalog_round_trip": (catalog_round_trip, _ROWS),
    "csv_json_round_trip": (csv_json_round_trip, f"SELECT *, 'csv' AS form FROM ({_ROWS}) UNION ALL SELECT *, 'json' FROM ({_ROWS})"),
    "ingest_per_topic": (ingest_per_topic, f"""
SELECT event_type AS folder, event_type AS topic, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM ({_ROWS})
WHERE event_type IS NOT NULL GROUP BY ALL"""),
    "guarded_bucket_sum": (guarded_bucket_sum, """
SELECT user_id, make_timestamp(epoch_us(ts) // 1800000000 * 1800000000) AS bucket_start,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS bucket_sum FROM events GROUP BY ALL"""),
    "listed_files": (listed_files, "SELECT event_type, CAST(count(*) AS BIGINT) AS n, true AS filled FROM events GROUP BY 1"),
}
