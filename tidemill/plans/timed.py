"""Windows in time: distinct users, sliding sums, latest per window, sessions, dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import distinct, panes, sliding
from tidemill.operators.latest import latest_per_window, newest_per_key, oldest_per_key
from tidemill.operators.sessions import idle_sessions as sessions
from tidemill.plans.inputs import event_segments, events
from tidemill.sources.tables import table, zoneless

WIDTHS = [3600, 86400]


def _windows(spark, folder):
    return distinct.segment_distinct(table(spark, folder, "events"), event_segments(), WIDTHS, "ts", "user_id")


def _latest(spark, folder):
    return distinct.latest_segment_windows(table(spark, folder, "events"), event_segments(), WIDTHS, "ts", "user_id")


def segment_distinct(spark, folder):
    return zoneless(_windows(spark, folder))


def closed_windows(spark, folder):
    return zoneless(distinct.closed(_windows(spark, folder), _latest(spark, folder)))


def open_windows(spark, folder):
    return zoneless(distinct.still_open(_windows(spark, folder), _latest(spark, folder)))


def window_metrics(spark, folder):
    return zoneless(distinct.metric_points(distinct.closed(_windows(spark, folder), _latest(spark, folder))))


def user_state_merge(spark, folder):
    """User rows of the second half merged into the kept rows of the first, then counted."""
    rows = table(spark, folder, "events")
    middle = F.lit("2024-01-16 12:00:00").cast("timestamp")

    def users(half):
        return distinct.user_bits(half, event_segments(), WIDTHS, "ts", "user_id")

    merged = distinct.merge_users(
        users(rows.where(F.col("ts") >= middle)), users(rows.where(F.col("ts") < middle)), event_segments()
    )
    return zoneless(distinct.count_users(merged))


def users_per_bucket(spark, folder):
    return zoneless(distinct.users_per_bucket(table(spark, folder, "events"), "ts", "user_id", 3600))


_E = "SELECT *, epoch_us(ts) // 1000000 AS s, CAST(round(value * 100) AS BIGINT) AS c FROM events"

_SEGMENTS = r"""
WITH f AS (
  SELECT user_id, ts, event_type = 'click' AS a,
         event_type LIKE '%purchase%' OR event_type LIKE '%sign%' OR props LIKE '%"k": 7%' AS b,
         event_type LIKE '%error%' OR props LIKE '%"k": 13%' AS c,
         NOT (CAST(user_id AS VARCHAR) LIKE '9%' OR CAST(user_id AS VARCHAR) LIKE '88%') AS real,
         epoch_us(ts) // 1000000 AS s
  FROM events
),
r AS (
  SELECT 'CLICK' AS user_type, * FROM f WHERE a AND real UNION ALL SELECT 'CLICK_WITH_TEST', * FROM f WHERE a
  UNION ALL SELECT 'BUY', * FROM f WHERE b AND real UNION ALL SELECT 'BUY_WITH_TEST', * FROM f WHERE b
  UNION ALL SELECT 'FAULT', * FROM f WHERE c AND real UNION ALL SELECT 'FAULT_WITH_TEST', * FROM f WHERE c
  UNION ALL SELECT 'ALL', * FROM f WHERE real UNION ALL SELECT 'ALL_WITH_TEST', * FROM f
),
w AS (
  SELECT user_type, CAST(w.w AS INTEGER) AS window_s, make_timestamp(s // w.w * w.w * 1000000) AS start_time,
         count(DISTINCT user_id) AS distinct_users
  FROM r, unnest([3600, 86400]) AS w(w) GROUP BY ALL
),
m AS (SELECT *, max(start_time) OVER (PARTITION BY user_type, window_s) AS latest FROM w)
"""
_WINDOW_COLS = "user_type, window_s, start_time, distinct_users"

# -- sliding sums ------------------------------------------------------------


def sliding_running_sum(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "ts", "cents")
    return zoneless(sliding.sliding_running_sum(rows, "user_id", "ts", "cents", ["event_id"], 3600, 1800))


def sliding_running_sum_uneven(spark, folder):
    """Window that is no multiple of the bucket width."""
    rows = events(spark, folder).select("event_id", "user_id", "ts", "cents")
    return zoneless(sliding.sliding_running_sum(rows, "user_id", "ts", "cents", ["event_id"], 10000, 3600))


def sliding_bootstrap_state(spark, folder):
    rows = events(spark, folder)
    cutoff = sliding.bootstrap_cutoff(rows, "ts", 1800)
    return zoneless(sliding.bootstrap_state(rows, "user_id", "ts", "cents", 1800, cutoff))


def bootstrap_events(spark, folder):
    """The events a bootstrapped stream still takes."""
    rows = events(spark, folder)
    cutoff = sliding.bootstrap_cutoff(rows, "ts", 1800)
    return zoneless(sliding.from_cutoff(rows, "ts", cutoff).select("event_id", "ts"))


_SLIDING = f"""
WITH e AS ({_E})
SELECT e.event_id, e.user_id, e.ts, e.c AS cents, CAST(sum(p.c) AS BIGINT) AS running_sum
FROM e JOIN e p ON p.user_id = e.user_id AND (p.ts, p.event_id) <= (e.ts, e.event_id)
     AND p.s // {{1}} * {{1}} > (e.s - {{0}}) // {{1}} * {{1}}
GROUP BY ALL
"""
_CUTOFF = "(SELECT (max(s) - 60) // 1800 * 1800 FROM e)"

# -- windows -----------------------------------------------------------------


def latest_per_tumbling(spark, folder):
    rows = events(spark, folder)
    result = latest_per_window(rows, ["event_type"], "ts", "cents", ["ts", "event_id"], "1 hour")
    return zoneless(result.drop("window_end"))


def newest_row_per_window(spark, folder):
    """Whole newest row per type and 30 minute window."""
    rows = events(spark, folder).withColumn("window_start", F.window("ts", "30 minutes")["start"])
    newest = newest_per_key(rows, ["event_type", "window_start"], ["ts", "event_id"])
    return zoneless(newest.select("event_type", "window_start", "event_id", "user_id"))


def latest_per_sliding(spark, folder):
    return zoneless(panes.sliding_latest(events(spark, folder), ["event_type"], "ts", "cents", ["ts", "event_id"], 3600, 1200))


def avg_per_sliding(spark, folder):
    result = panes.sliding_average(events(spark, folder), ["event_type"], "ts", "cents", 3600, 1800)
    return zoneless(result.withColumn("average", F.round("average", 6)))


def sliding_window_count(spark, folder):
    return zoneless(panes.sliding_count(table(spark, folder, "events"), ["event_type"], "ts", 3600, 1200))


_SLIDES = f"""
WITH e AS ({_E}),
x AS (SELECT e.*, s // {{1}} * {{1}} - k.k * {{1}} AS start_s FROM e, unnest(range({{0}} // {{1}})) AS k(k))
"""


def dedup_first_seen(spark, folder):
    first = oldest_per_key(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])
    return zoneless(first.select("user_id", "event_id", "ts", "event_type"))


def idle_sessions(spark, folder):
    return zoneless(sessions(table(spark, folder, "events"), "user_id", "ts", 6 * 3600))


QUERIES = {
    "segment_distinct": (segment_distinct, _SEGMENTS + f"SELECT {_WINDOW_COLS} FROM w"),
    "user_state_merge": (user_state_merge, _SEGMENTS + f"SELECT {_WINDOW_COLS} FROM w"),
    "closed_windows": (closed_windows, _SEGMENTS + f"SELECT {_WINDOW_COLS} FROM m WHERE start_time < latest"),
    "open_windows": (open_windows, _SEGMENTS + f"SELECT {_WINDOW_COLS} FROM m WHERE start_time = latest"),
    "window_metrics": (window_metrics, _SEGMENTS + """
SELECT 'events.distinct.count.' || window_s || 's' AS metric, start_time + to_seconds(window_s) AS ts,
       CAST(distinct_users AS DOUBLE) AS value, 'user_type:' || user_type AS tags
FROM m WHERE start_time < latest"""),
    "users_per_bucket": (users_per_bucket, """
SELECT date_trunc('hour', ts) AS start_time, count(DISTINCT user_id) AS distinct_users FROM events GROUP BY 1"""),
    "sliding_running_sum": (sliding_running_sum, _SLIDING.format(3600, 1800)),
    "sliding_running_sum_uneven": (sliding_running_sum_uneven, _SLIDING.format(10000, 3600)),
    "sliding_bootstrap_state": (sliding_bootstrap_state, f"""
WITH e AS ({_E})
SELECT user_id, make_timestamp(s // 1800 * 1800 * 1000000) AS bucket_start, CAST(sum(c) AS BIGINT) AS bucket_sum
FROM e WHERE s < {_CUTOFF} GROUP BY ALL"""),
    "bootstrap_events": (bootstrap_events, f"WITH e AS ({_E}) SELECT event_id, ts FROM e WHERE s >= {_CUTOFF}"),
    "latest_per_tumbling": (latest_per_tumbling, f"""
WITH e AS ({_E})
SELECT event_type, date_trunc('hour', ts) AS window_start, arg_max(c, (ts, event_id)) AS cents FROM e GROUP BY ALL"""),
    "newest_row_per_window": (newest_row_per_window, f"""
WITH e AS ({_E}), n AS (
  SELECT *, make_timestamp(s // 1800 * 1800 * 1000000) AS window_start,
         row_number() OVER (PARTITION BY event_type, s // 1800 ORDER BY ts DESC, event_id DESC) AS rn FROM e)
SELECT event_type, window_start, event_id, user_id FROM n WHERE rn = 1"""),
    "latest_per_sliding": (latest_per_sliding, _SLIDES.format(3600, 1200) + """
SELECT event_type, make_timestamp(start_s * 1000000) AS window_start, arg_max(c, (ts, event_id)) AS cents FROM x GROUP BY ALL"""),
    "avg_per_sliding": (avg_per_sliding, _SLIDES.format(3600, 1800) + """
SELECT event_type, make_timestamp(start_s * 1000000) AS window_start, round(CAST(sum(c) AS BIGINT) / count(c), 6) AS average
FROM x GROUP BY ALL"""),
    "sliding_window_count": (sliding_window_count, _SLIDES.format(3600, 1200) + """
SELECT event_type, make_timestamp(start_s * 1000000) AS window_start, count(*) AS n FROM x GROUP BY ALL"""),
    "dedup_first_seen": (dedup_first_seen, """
SELECT user_id, event_id, ts, event_type FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1"""),
    "idle_sessions": (idle_sessions, """
WITH g AS (SELECT user_id, ts, event_id,
    CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS n FROM events),
s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS count FROM s GROUP BY user_id, k"""),
}
