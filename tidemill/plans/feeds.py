"""Queries on record feeds: offsets, parsing, change merge, commands, progress."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import parse, predicates, timefn
from tidemill.operators.changes import merge_changes
from tidemill.operators.control import control_actions, control_rejects
from tidemill.operators.latest import newest_per_key
from tidemill.operators.progress import progress_table
from tidemill.plans import inputs
from tidemill.schemas import EMPLOYEE
from tidemill.session import scratch_path
from tidemill.sources import envelope as env
from tidemill.sources.buckets import BucketedTable
from tidemill.sources.changelog import ChangeLog
from tidemill.sources.lookup import rows_of_key, write_sorted
from tidemill.sources.tables import raw_table, table, zoneless

ORDER_KEY = T.StructType([T.StructField("o_orderkey", T.LongType())])
ORDER_VALUE = T.StructType([T.StructField("status", T.StringType()), T.StructField("cents", T.LongType())])
POSITION = ["timestamp", "partition", "offset"]


def _order_rows(spark, folder):
    feed = parse.cdc_records(inputs.order_changes(spark, folder))
    return parse.cdc_rows(feed, inputs.NAMESPACE, ORDER_KEY, ORDER_VALUE)


def cdc_latest_change(spark, folder):
    return newest_per_key(_order_rows(spark, folder), ["o_orderkey"], POSITION).select(
        "o_orderkey", "oc", "status", "cents"
    )


def cdc_merge(spark, folder):
    newest = newest_per_key(_order_rows(spark, folder), ["o_orderkey"], POSITION)
    return merge_changes(inputs.order_target(spark, folder), newest, ["o_orderkey"])


def cdc_merge_versions(spark, folder):
    """The same merge read from a change log; the repeated batch replaces its own changes."""
    log = ChangeLog(inputs.order_target(spark, folder), scratch_path(spark, "orders"), ["o_orderkey"])
    changes = _order_rows(spark, folder)
    log.append(changes, POSITION, 0)
    log.append(changes, POSITION, 0)
    return log.read()


def cdc_merge_bucketed(spark, folder):
    """The same merge in three batches, the first two folded into a new base; the base is never shuffled."""
    changes = _order_rows(spark, folder)
    part = F.when(F.col("timestamp") < "1994-01-01", 0).when(F.col("timestamp") < "1996-06-01", 1).otherwise(2)
    name = f"orders_{uuid.uuid4().hex}"
    table = BucketedTable(spark, name, scratch_path(spark, name), ["o_orderkey"], 16)
    table.create(inputs.order_target(spark, folder))
    for batch in range(3):
        table.append(changes.where(part == batch), POSITION, batch)
        if batch == 1:
            table.fold(batch)
    return table.read()


_CHANGES = """
WITH feed AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'D' WHEN o_orderkey % 5 <= 2 THEN 'U' ELSE 'I' END AS oc,
         'X' AS status, CAST(round(o_totalprice * 100) AS BIGINT) + 1 AS cents, 0 AS nr
  FROM orders WHERE o_orderkey % 11 <> 0
  UNION ALL
  SELECT o_orderkey, 'U', 'Y', CAST(round(o_totalprice * 100) AS BIGINT) + 2, 1
  FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 11 <> 0
),
s AS (
  SELECT o_orderkey, oc, status, cents
  FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY nr DESC) AS rn FROM feed) WHERE rn = 1
)
"""

_MERGE = _CHANGES + """,
t AS (
  SELECT o_orderkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders WHERE o_orderstatus <> 'P'
)
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NULL OR s.oc = 'U' THEN s.status ELSE t.status END AS status,
       CASE WHEN t.o_orderkey IS NULL OR s.oc = 'U' THEN s.cents ELSE t.cents END AS cents
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
WHERE s.oc IS NULL OR s.oc <> 'D'
"""


# -- offsets ---------------------------------------------------------------

STARTS = {inputs.TOPIC: {0: 100, 1: env.EARLIEST, 2: 50}}
ENDS = {inputs.TOPIC: {0: 900, 1: 700, 2: env.LATEST}}


def _payload(envelope):
    records = parse.text_records(envelope, "partition", "offset").withColumn(
        "payload", parse.parse_json(F.col("value"), inputs.PAYLOAD)
    )
    return records.select("key", "partition", "offset", "payload.name", "payload.value", "payload.params")


def envelope_offset_range(spark, folder):
    return _payload(env.offset_range(inputs.envelope(spark, folder), STARTS, ENDS))


def envelope_assign_from_ts(spark, folder):
    assigned = env.assign_partitions(inputs.envelope(spark, folder), {inputs.TOPIC: [0, 2]})
    return _payload(env.from_timestamps(assigned, {inputs.TOPIC: {0: "2024-01-10 00:00:00"}}))


_PAYLOAD_SQL = """
SELECT CAST(user_id AS VARCHAR) AS key, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset",
       event_type AS name, CAST(round(value * 100) AS BIGINT) AS value, props AS params
FROM events
"""


def envelope_partition_sizes(spark, folder):
    """Records per partition after large partitions were spread over more tasks."""
    spread = env.spread(inputs.envelope(spark, folder), 8, run=500)
    return spread.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.max("offset").alias("last_offset"), F.max("timestampType").alias("ts_type")
    )


def offsets_json_by_topic(spark, folder):
    texts = env.offsets_json(inputs.envelope(spark, folder), "end")
    parsed = F.from_json("offsets", "map<string, map<string, bigint>>")
    return (
        texts.select(F.explode(parsed).alias("topic", "parts"))
        .select("topic", F.explode("parts").alias("partition", "end_offset"))
        .withColumn("partition", F.col("partition").cast("int"))
    )


def ingest_by_hour(spark, folder):
    records = inputs.envelope(spark, folder)
    day, hour, _ = timefn.calendar_parts(F.col("timestamp"))
    return (
        records.select(day.cast("string").alias("day"), hour, parse.first_header(F.col("headers"), "header1").alias("header1"),
                       parse.first_header(F.col("headers"), "header2").alias("header2"))
        .groupBy("day", "hour", "header1", "header2")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# -- parsing ---------------------------------------------------------------

def _employee_texts(spark, folder):
    """Well-formed, wrong-type, extra-field, missing-field and non-JSON employee records."""
    kind, user = F.col("event_id") % 5, F.col("user_id").cast("string")
    name = F.concat(F.lit('"first_name":"'), F.col("event_type"), F.lit('","last_name":"L"'))
    text = (
        F.when(kind == 0, F.concat(F.lit('{"emp_id":"'), user, F.lit('c",'), name, F.lit("}")))
        .when(kind == 1, F.concat(F.lit('{"emp_id":'), user, F.lit(","), name, F.lit(',"age":3}')))
        .when(kind == 2, F.concat(F.lit("{"), name, F.lit("}")))
        .when(kind == 3, F.concat(F.lit("plain "), user))
        .otherwise(F.concat(F.lit('{"emp_id":'), user, F.lit(","), name, F.lit("}")))
    )
    return table(spark, folder, "events").select("event_id", text.alias("value"))


_EMPLOYEE_SQL = """
SELECT event_id, CASE event_id % 5
         WHEN 0 THEN '{"emp_id":"' || user_id || 'c","first_name":"' || event_type || '","last_name":"L"}'
         WHEN 1 THEN '{"emp_id":' || user_id || ',"first_name":"' || event_type || '","last_name":"L","age":3}'
         WHEN 2 THEN '{"first_name":"' || event_type || '","last_name":"L"}'
         WHEN 3 THEN 'plain ' || user_id
         ELSE '{"emp_id":' || user_id || ',"first_name":"' || event_type || '","last_name":"L"}' END AS value
FROM events
"""


def json_lenient(spark, folder):
    records = _employee_texts(spark, folder)
    return parse.flatten(
        records.withColumn("record", parse.parse_json(F.col("value"), EMPLOYEE)), "record", "event_id"
    ).withColumn("last_name", parse.or_default(F.col("last_name")))


def json_reject_split(spark, folder):
    """Good and rejected records in one frame, from one scan."""
    marked = parse.marked_rejects(_employee_texts(spark, folder), "value", EMPLOYEE, ["emp_id"])
    return marked.select("event_id", F.col("record.emp_id").alias("emp_id"), "dead_letter")


def line_records(spark, folder):
    key = F.col("c_custkey")
    line = (
        F.when(key % 10 == 0, F.col("c_name"))
        .when(key % 10 == 1, F.concat(F.col("c_name"), F.lit(",x1")))
        .otherwise(F.concat(F.col("c_name"), F.lit(" , "), key.cast("string")))
    )
    return table(spark, folder, "customer").select("c_custkey", *parse.person_line(line))


def ad_lines(spark, folder):
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    line = F.concat_ws(", ", when, F.col("user_id").cast("string"), "event_type")
    return zoneless(table(spark, folder, "events").select("event_id", *parse.click_line(line)))


def timed_word_counts(spark, folder):
    when = F.date_format("ts", "yyyy-MM-dd HH:00:00")
    line = F.concat(when, F.lit(", "), F.col("event_type"), F.lit("  "), F.col("event_type"), F.lit(" end"))
    counted = parse.timed_words(table(spark, folder, "events").select(line.alias("value"))).groupBy("event_time", "word")
    return zoneless(counted.agg(F.count(F.lit(1)).alias("n")))


def hex_id_time(spark, folder):
    seconds = F.unix_timestamp("o_orderdate")
    hex_id = F.concat(F.lpad(timefn.to_hex(seconds), 8, "0"), F.lpad(timefn.to_hex(F.col("o_orderkey")), 16, "0"))
    made = table(spark, folder, "orders").select("o_orderkey", hex_id.alias("id"))
    return made.select("o_orderkey", "id", timefn.hex_id_seconds(F.col("id")).alias("seconds"),
                       timefn.to_hex(timefn.hex_id_seconds(F.col("id"))).alias("prefix"))


def iso_millis(spark, folder):
    text = F.when(F.col("event_id") % 10 == 0, F.date_format("ts", "yyyy/MM/dd")).otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("788+00:00"))
    )
    return table(spark, folder, "events").select("event_id", timefn.iso_millis(text).alias("millis"))


def parsed_below_ten(spark, folder):
    """Numbers below ten through the guard that fails the query on any other."""
    digit = (F.col("user_id") % 10).cast("int")
    return table(spark, folder, "events").select("event_id", parse.checked_below(digit).alias("digit"))


# -- filters ---------------------------------------------------------------

def segment_filter(spark, folder):
    kept = table(spark, folder, "events").where(
        predicates.all_of([
            predicates.not_like_any(F.col("event_type"), [r"%gn\_%", "%view"]),
            predicates.not_in(F.col("event_type"), ["event1", "event2"]),
        ])
    )
    return kept.select([
        F.count_if(s.predicate).alias(s.name.lower()) for s in inputs.event_segments()
    ])


def bad_user_ids(spark, folder):
    slot = F.col("event_id") % 50
    uid = (
        F.when(slot == 0, F.lit(None).cast("string")).when(slot == 1, "").when(slot == 2, " ")
        .otherwise(F.lpad(F.col("user_id").cast("string"), 12, "0").substr(F.lit(1), 8 + (F.col("user_id") % 5).cast("int")))
    )
    ids = table(spark, folder, "events").select("event_id", uid.alias("uid"))
    return ids.where(predicates.bad_user_id(F.col("uid")))


def field_in_list(spark, folder):
    kind = F.when(F.col("event_id") % 20 == 0, F.lit(None).cast("string")).otherwise(F.initcap("event_type"))
    listed = " click,ERROR, View ".split(",")
    return table(spark, folder, "events").select(
        "event_id",
        predicates.field_in_list(kind, listed).alias("denied"),
        predicates.field_in_list(kind, listed, null_in_list=True).alias("denied_or_null"),
        predicates.field_in_list(kind, listed, negate=True).alias("not_allowed"),
    )


def key_range_lookup(spark, folder):
    orders = raw_table(spark, folder, "orders")
    return orders.where((F.col("o_custkey") == 370) & (F.col("o_orderpriority") > "2")).select(
        "o_custkey", "o_orderkey", "o_orderpriority"
    )


def key_lookup_sorted(spark, folder):
    """The same look-up in a copy laid out for it."""
    path = scratch_path(spark, "lookup")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    write_sorted(orders, path, "o_custkey", "o_orderpriority", files=16, distinct_keys=100_000)
    return rows_of_key(spark, path, "o_custkey", 370, F.col("o_orderpriority") > "2")


def cutoff_filter(spark, folder):
    """The filter stays on the stored column, so the scan skips row groups."""
    stored = raw_table(spark, folder, "events")
    return stored.where(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")).select("event_id", "ts")


# -- commands and progress ---------------------------------------------------

def _commands(spark, folder):
    operation = (
        F.when(F.col("event_type") == "click", "START").when(F.col("event_type") == "view", "cancel")
        .when(F.col("event_type") == "error", "pause").when(F.col("event_type") == "signup", "start")
    )
    return table(spark, folder, "events").select(
        F.to_json(F.struct(F.col("user_id").cast("string").alias("topic_name"), operation.alias("operation"))).alias("value"),
        "ts", "event_id",
    )


def _active(spark, folder):
    return table(spark, folder, "customer").where(F.col("c_custkey") % 2 == 0).select(
        F.concat(F.lit("Stream-for-"), F.col("c_custkey").cast("string")).alias("stream_name")
    )


def control_decisions(spark, folder):
    return control_actions(_commands(spark, folder), _active(spark, folder), "value", "ts", "event_id")


def control_dead_letters(spark, folder):
    return control_rejects(_commands(spark, folder)).groupBy("dead_letter").agg(F.count(F.lit(1)).alias("n"))


def progress_offsets(spark, folder):
    """Progress records of a feed read in hourly batches, back to rows per partition."""
    records = inputs.envelope(spark, folder).withColumn(
        "batch", F.expr("(unix_timestamp(timestamp) - unix_timestamp(timestamp'2024-01-01')) div 3600")
    )
    per_part = records.groupBy("batch", "partition").agg(
        F.min("offset").alias("s"), (F.max("offset") + 1).alias("e"), F.count(F.lit(1)).alias("n")
    )

    def offsets(column):
        entries = F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), column)))
        return F.to_json(F.create_map(F.lit(inputs.TOPIC), entries))

    # Three partitions per batch, so the lists hold three entries.
    batches = per_part.groupBy("batch").agg(
        offsets("s").alias("starts"), offsets("e").alias("ends"), F.sum("n").alias("n")
    )
    source = F.struct(
        F.when(F.col("batch") > 0, F.col("starts")).alias("startOffset"), F.col("ends").alias("endOffset"),
        F.col("n").alias("numInputRows"),
    )
    text = F.to_json(F.struct(
        F.lit("ingest").alias("name"), F.col("batch").alias("batchId"), F.col("n").alias("numInputRows"),
        F.create_map(F.lit("latestOffset"), F.col("n") * 2).alias("durationMs"), F.array(source).alias("sources"),
    ))
    return progress_table(batches.select(text.alias("value"))).drop("input_rate", "processed_rate")


QUERIES = {
    "cdc_merge": (cdc_merge, _MERGE),
    "cdc_merge_versions": (cdc_merge_versions, _MERGE),
    "cdc_merge_bucketed": (cdc_merge_bucketed, _MERGE),
    "cdc_latest_change": (cdc_latest_change, _CHANGES + "SELECT o_orderkey, oc, status, cents FROM s"),
    "envelope_offset_range": (envelope_offset_range, _PAYLOAD_SQL + """
WHERE (event_id % 3 = 0 AND event_id // 3 BETWEEN 100 AND 899)
   OR (event_id % 3 = 1 AND event_id // 3 < 700) OR (event_id % 3 = 2 AND event_id // 3 >= 50)"""),
    "envelope_assign_from_ts": (envelope_assign_from_ts, _PAYLOAD_SQL + """
WHERE event_id % 3 = 2 OR (event_id % 3 = 0 AND event_id // 3 >= (
  SELECT min(event_id // 3) FROM events WHERE event_id % 3 = 0 AND ts >= TIMESTAMP '2024-01-10'))"""),
    "envelope_partition_sizes": (envelope_partition_sizes, """
SELECT 'events' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, count(*) AS n,
       max(event_id // 3) AS last_offset, 0 AS ts_type
FROM events GROUP BY ALL"""),
    "offsets_json_by_topic": (offsets_json_by_topic, """
SELECT 'events' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, max(event_id // 3) + 1 AS end_offset
FROM events GROUP BY ALL"""),
    "ingest_by_hour": (ingest_by_hour, """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(hour(ts) AS INTEGER) AS hour, event_type AS header1,
       CAST(NULL AS VARCHAR) AS header2, count(*) AS n
FROM events GROUP BY ALL"""),
    "json_lenient": (json_lenient, f"""
WITH r AS ({_EMPLOYEE_SQL}), j AS (SELECT event_id, CASE WHEN json_valid(value) THEN value ELSE '{{}}' END AS v FROM r)
SELECT event_id, try_cast(json_extract_string(v, '$.emp_id') AS INTEGER) AS emp_id,
       json_extract_string(v, '$.first_name') AS first_name,
       coalesce(json_extract_string(v, '$.last_name'), 'n/a') AS last_name FROM j"""),
    "json_reject_split": (json_reject_split, f"""
WITH r AS ({_EMPLOYEE_SQL}),
j AS (SELECT *, CASE WHEN json_valid(value)
        THEN try_cast(json_extract_string(value, '$.emp_id') AS INTEGER) END AS emp_id FROM r)
SELECT event_id, emp_id, CASE WHEN emp_id IS NULL THEN
  CAST(json_object('orig_request', value, 'failed_reason', 'missing or invalid: emp_id') AS VARCHAR) END AS dead_letter FROM j"""),
    "line_records": (line_records, """
SELECT c_custkey, c_name AS name,
       CASE WHEN c_custkey % 10 > 1 THEN CAST(c_custkey AS INTEGER) END AS age FROM customer"""),
    "ad_lines": (ad_lines, """
SELECT event_id, date_trunc('second', ts) AS click_time, CAST(user_id AS INTEGER) AS click_ad_id, event_type AS name
FROM events"""),
    "timed_word_counts": (timed_word_counts, """
SELECT date_trunc('hour', ts) AS event_time, w.word AS word, count(*) AS n
FROM events, unnest([event_type, '', event_type, 'end']) AS w(word) GROUP BY ALL"""),
    "hex_id_time": (hex_id_time, """
WITH k AS (SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 AS seconds FROM orders)
SELECT o_orderkey, printf('%08x%016x', seconds, o_orderkey) AS id, seconds, printf('%x', seconds) AS prefix FROM k"""),
    "iso_millis": (iso_millis, """
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN epoch_us(ts) // 1000 END AS millis FROM events"""),
    "parsed_below_ten": (parsed_below_ten, """
SELECT event_id, CAST(user_id % 10 AS INTEGER) AS digit FROM events"""),
    "segment_filter": (segment_filter, r"""
WITH e AS (
  SELECT event_type AS n, CAST(user_id AS VARCHAR) AS u, props AS p FROM events
  WHERE NOT (event_type LIKE '%gn\_%' ESCAPE '\' OR event_type LIKE '%view') AND event_type NOT IN ('event1', 'event2')
), f AS (
  SELECT n = 'click' AS a, n LIKE '%purchase%' OR n LIKE '%sign%' OR p LIKE '%"k": 7%' AS b,
         n LIKE '%error%' OR p LIKE '%"k": 13%' AS c, NOT (u LIKE '9%' OR u LIKE '88%') AS real FROM e
)
SELECT count(*) FILTER (a AND real) AS click, count(*) FILTER (a) AS click_with_test,
       count(*) FILTER (b AND real) AS buy, count(*) FILTER (b) AS buy_with_test,
       count(*) FILTER (c AND real) AS fault, count(*) FILTER (c) AS fault_with_test,
       count(*) FILTER (real) AS "all", count(*) AS all_with_test FROM f"""),
    "bad_user_ids": (bad_user_ids, """
WITH i AS (SELECT event_id, CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' '
  ELSE substr(lpad(CAST(user_id AS VARCHAR), 12, '0'), 1, CAST(8 + user_id % 5 AS INTEGER)) END AS uid FROM events)
SELECT event_id, uid FROM i WHERE uid IS NULL OR uid IN ('', ' ') OR length(uid) < 10"""),
    "field_in_list": (field_in_list, """
WITH k AS (SELECT event_id, CASE WHEN event_id % 20 <> 0 THEN event_type END AS k FROM events)
SELECT event_id, coalesce(k IN ('click', 'error', 'view'), false) AS denied,
       coalesce(k IN ('click', 'error', 'view'), true) AS denied_or_null,
       NOT coalesce(k IN ('click', 'error', 'view'), false) AS not_allowed FROM k"""),
    "key_range_lookup": (key_range_lookup, """
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders WHERE o_custkey = 370 AND o_orderpriority > '2'"""),
    "key_lookup_sorted": (key_lookup_sorted, """
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders WHERE o_custkey = 370 AND o_orderpriority > '2'"""),
    "cutoff_filter": (cutoff_filter, """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'"""),
    "control_actions": (control_decisions, """
WITH c AS (
  SELECT CAST(user_id AS VARCHAR) AS topic_name, ts, event_id,
         CASE event_type WHEN 'click' THEN 'start' WHEN 'signup' THEN 'start' WHEN 'view' THEN 'cancel' END AS op
  FROM events WHERE event_type IN ('click', 'signup', 'view')
), n AS (
  SELECT topic_name, 'Stream-for-' || topic_name AS stream_name, arg_max(op, (ts, event_id)) AS op FROM c GROUP BY topic_name
), a AS (SELECT 'Stream-for-' || c_custkey AS stream_name FROM customer WHERE c_custkey % 2 = 0)
SELECT topic_name, n.stream_name,
       CASE WHEN op = 'start' AND a.stream_name IS NULL THEN 'start'
            WHEN op = 'cancel' AND a.stream_name IS NOT NULL THEN 'cancel' ELSE 'skip' END AS action,
       CASE WHEN op = 'start' AND a.stream_name IS NOT NULL THEN 'already active'
            WHEN op = 'cancel' AND a.stream_name IS NULL THEN 'not active' END AS reason
FROM n LEFT JOIN a ON n.stream_name = a.stream_name"""),
    "control_dead_letters": (control_dead_letters, """
SELECT CAST(json_object(
         'orig_request', CASE WHEN event_type = 'error' THEN '{"topic_name":"' || user_id || '","operation":"pause"}'
                              ELSE '{"topic_name":"' || user_id || '"}' END,
         'failed_reason', CASE WHEN event_type = 'error' THEN 'unknown operation: pause'
                               ELSE 'missing field: operation' END) AS VARCHAR) AS dead_letter, count(*) AS n
FROM events WHERE event_type NOT IN ('click', 'view', 'signup') GROUP BY 1"""),
    "progress_offsets": (progress_offsets, """
WITH r AS (
  SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS o,
         (epoch_us(ts) // 1000000 - epoch_us(TIMESTAMP '2024-01-01') // 1000000) // 3600 AS batch_id FROM events
), p AS (SELECT batch_id, partition, min(o) AS s, max(o) + 1 AS e, count(*) AS n FROM r GROUP BY ALL)
SELECT 'ingest' AS query, batch_id, 'events' AS topic, partition,
       CASE WHEN batch_id > 0 THEN s END AS start_offset, e AS end_offset,
       CAST(sum(n) OVER (PARTITION BY batch_id) AS BIGINT) AS batch_rows,
       CAST(2 * sum(n) OVER (PARTITION BY batch_id) AS BIGINT) AS latest_offset_ms
FROM p"""),
}
