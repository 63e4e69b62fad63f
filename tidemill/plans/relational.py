"""Word counts, joins, aggregates, table changes, sketches, clusters and path groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import parse, userfn
from tidemill.operators import aggregate, changes, cluster, joins, latest, paths, sketch, user_aggregate
from tidemill.operators.ordered import ordered_index
from tidemill.plans.inputs import cents, events
from tidemill.session import scratch_path
from tidemill.sources.generate import number_range
from tidemill.sources.changelog import ChangeLog
from tidemill.sources.tables import raw_table, table, zoneless

# -- words -------------------------------------------------------------------


def word_counts(spark, folder):
    return aggregate.word_count(raw_table(spark, folder, "documents"), parse.word_pieces(F.col("text")), drop_empty=True)


def word_count_topk(spark, folder):
    return aggregate.top_k(word_counts(spark, folder), 20)


def word_count_space(spark, folder):
    return aggregate.word_count(raw_table(spark, folder, "documents"), parse.space_tokens(F.col("text")))


def word_count_user_code(spark, folder):
    """The count through a vectorised user function."""
    return aggregate.word_count(raw_table(spark, folder, "documents"), userfn.split_words("text"))


def first_events(spark, folder):
    return zoneless(aggregate.first_rows(table(spark, folder, "events"), 20, "ts", "event_id"))


_WORDS = r"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM {0}) WHERE length(word) > 0 GROUP BY word
"""

# -- joins -------------------------------------------------------------------


def stream_static_left(spark, folder):
    builders = table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("user_id"), "c_name"
    )
    rows = table(spark, folder, "events").select("event_id", "user_id")
    return joins.with_static(rows, builders, "user_id")


def interval_join(spark, folder):
    rows = events(spark, folder)
    def side(kind, prefix):
        return rows.where(F.col("event_type") == kind).select(
            F.col("event_id").alias(f"{prefix}_id"),
            F.col("user_id").alias(f"{prefix}_ad_id"),
            F.col("ts").alias(f"{prefix}_time"),
        )

    shown, clicked = side("view", "impression"), side("click", "click")
    return zoneless(joins.within_interval(
        shown, clicked, "impression_ad_id", "click_ad_id", "impression_time", "click_time", 3600,
        ["impression_id"], ["click_id"],
    ))


def set_state_merge(spark, folder):
    """Event types per user (five at most) of the second half merged into those of the first."""
    rows = events(spark, folder)

    def types(half):
        # collect_set is bounded: the event type has five values.
        return half.groupBy("user_id").agg(F.collect_set("event_type").alias("types"))

    middle = F.lit("2024-01-16").cast("timestamp")
    new, kept = types(rows.where(F.col("ts") >= middle)), types(rows.where(F.col("ts") < middle))
    merged = joins.merge_sets(new, kept, ["user_id"], "types")
    return merged.select("user_id", F.array_join(F.array_sort("types"), ",").alias("types"), F.size("types").alias("n"))


def latest_map_merge(spark, folder):
    rows = events(spark, folder).select(
        F.col("user_id").alias("name"), "ts", "event_id",
        F.when(F.col("event_type") != "error", F.col("cents")).alias("value"),
    )
    middle = F.lit("2024-01-16").cast("timestamp")

    def newest(half):
        return latest.newest_per_key(half, ["name"], ["ts", "event_id"]).select("name", "value")

    return latest.merge_latest_map(
        newest(rows.where(F.col("ts") < middle)), newest(rows.where(F.col("ts") >= middle)), "name", "value"
    )


def agg_self_join(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("k", F.col("l_orderkey") % 500)
    counts = lines.groupBy("k").agg(F.count(F.lit(1)).alias("count"))
    averages = lines.groupBy("k").agg(
        (F.sum(cents("l_extendedprice")) / F.count("l_extendedprice")).alias("avg_cents")
    )
    return joins.on_derived_key(counts, averages)


def range_join(spark, folder):
    """Order numbers from a generated range against the orders, per number modulo 500."""
    orders = table(spark, folder, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0] or 0
    numbers = number_range(spark, 0, top + 1).withColumn("x", F.rand(7))
    slots = numbers.groupBy((F.col("id") % 500).alias("k")).agg(
        F.count(F.lit(1)).alias("count"), ((F.avg("x") >= 0) & (F.avg("x") < 1)).alias("x_ok")
    )
    used = orders.groupBy((F.col("o_orderkey") % 500).alias("k")).agg(
        (F.sum(cents("o_totalprice")) / F.count(F.lit(1))).alias("avg_cents")
    )
    return joins.on_derived_key(slots, used)


# -- aggregates ---------------------------------------------------------------


def counts_by_type(spark, folder):
    return aggregate.count_per(table(spark, folder, "events"), "event_type")


def view_count(spark, folder):
    """Count through SQL text over a view."""
    table(spark, folder, "events").createOrReplaceTempView("tidemill_updates")
    return spark.sql("SELECT count(*) AS n FROM tidemill_updates")


def min_max_ts(spark, folder):
    return zoneless(aggregate.bounds(table(spark, folder, "events"), "ts"))


def min_max_per_type(spark, folder):
    return zoneless(aggregate.bounds(table(spark, folder, "events"), "ts", "event_type"))


def bucket_sum(spark, folder):
    return zoneless(aggregate.bucket_sums(events(spark, folder), "user_id", "ts", "cents", 1800))


def latest_by_key(spark, folder):
    return events(spark, folder).groupBy("user_id").agg(latest.latest_first_seen("value", "ts", "event_id").alias("latest"))


def custom_avg(spark, folder):
    return events(spark, folder).groupBy("event_type").agg(F.round(userfn.average(F.col("cents")), 6).alias("average"))


# -- sketches and quantiles -----------------------------------------------------

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 1.0]


def theta_distinct_ok(spark, folder):
    lines = table(spark, folder, "lineitem")
    stored = sketch.theta_sketches(lines, ["l_returnflag", "l_linestatus"], "l_orderkey")
    merged = sketch.theta_union(stored, ["l_returnflag"]).select(
        "l_returnflag", sketch.theta_estimate().alias("estimate")
    )
    exact = lines.groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("n"))
    near = F.abs(F.col("estimate") / F.col("n") - 1) <= 0.05
    return merged.join(exact, "l_returnflag").select("l_returnflag", "n", near.alias("ok"))


def quantiles_exact(spark, folder):
    return sketch.quantiles_exact(table(spark, folder, "lineitem"), "l_extendedprice", PROBABILITIES)


def _rank_checks(df, column, values, error):
    """Whether each ``(probability, value)`` has a rank within the error, in one pass."""
    shares = df.agg(*[
        F.array(F.avg((F.col(column) < v).cast("int")), F.avg((F.col(column) <= v).cast("int"))).alias(f"r{i}")
        for i, (_, v) in enumerate(values)
    ])
    checks = F.array(*[
        F.struct(F.lit(p).alias("probability"),
                 ((F.col(f"r{i}")[0] - error <= p) & (p <= F.col(f"r{i}")[1] + error)).alias("ok"))
        for i, (p, _) in enumerate(values)
    ])
    return shares.select(F.explode(checks).alias("c")).select("c.*")


def quantiles_approx_ok(spark, folder):
    lines = table(spark, folder, "lineitem")
    found = sketch.quantiles_approx(lines, "l_extendedprice", PROBABILITIES, 0.05).collect()  # five rows
    return _rank_checks(lines, "l_extendedprice", [tuple(r) for r in found], 0.05)


def kll_quantiles_ok(spark, folder):
    lines = table(spark, folder, "lineitem")
    sketches = sketch.kll_sketches(lines, [], "l_extendedprice")
    found = sketches.select(*[sketch.kll_quantile("sketch", p) for p in PROBABILITIES]).first()  # one row
    return _rank_checks(lines, "l_extendedprice", list(zip(PROBABILITIES, found)), 0.02)


def kll_merge_ok(spark, folder):
    lines = table(spark, folder, "lineitem")
    stored = sketch.kll_sketches(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    found = sketch.kll_union(stored).select(*[sketch.kll_quantile("sketch", p) for p in PROBABILITIES]).first()
    return _rank_checks(lines, "l_extendedprice", list(zip(PROBABILITIES, found)), 0.02)


SPLITS = [10.0, 50.0, 100.0]


def value_histogram(spark, folder):
    return sketch.histogram(table(spark, folder, "events"), "value", SPLITS)


def kll_histogram_ok(spark, folder):
    """Bin shares from a sketch against the exact ones."""
    rows = table(spark, folder, "events")
    mass = sketch.kll_sketches(rows, [], "value").select(sketch.kll_mass("sketch", SPLITS)).first()[0]  # four numbers
    estimates = spark.createDataFrame(list(enumerate(mass)), "bin int, estimate double")
    exact = sketch.histogram(rows, "value", SPLITS)
    return exact.join(estimates, "bin").select("bin", (F.abs(F.col("mass") - F.col("estimate")) <= 0.02).alias("ok"))


# -- table changes ---------------------------------------------------------------


def user_average(spark, folder):
    """Mean per kind and over all events by user code that merges its buffers."""
    rows = events(spark, folder)
    average = user_aggregate.Average("cents")
    by_type = user_aggregate.user_aggregate(rows, ["event_type"], average, "average")
    over_all = user_aggregate.user_aggregate(rows, [], average, "average")
    return by_type.unionByName(over_all, allowMissingColumns=True).withColumn("average", F.round("average", 6))


def user_latest(spark, folder):
    """Value of each user's newest event by user code."""
    newest = user_aggregate.Newest("value", "ts", "event_id", "double")
    return user_aggregate.user_aggregate(events(spark, folder), ["user_id"], newest, "latest")


def user_average_sql(spark, folder):
    """The mean by the names of its two table functions."""
    user_aggregate.register_aggregate(spark, "mean_by_type", user_aggregate.Average("cents"), "event_type string", "cents bigint")
    return spark.sql(
        "SELECT event_type, round(result, 6) AS average FROM mean_by_type_merge(TABLE(SELECT * FROM "
        "mean_by_type_partial(TABLE(SELECT event_type, cents FROM {events}))) PARTITION BY event_type)",
        events=events(spark, folder),
    )


def _parts(spark, folder):
    return table(spark, folder, "part").select("p_partkey", "p_name", "p_size")


def _even():
    return F.col("p_partkey") % 2 == 0


def table_update(spark, folder):
    return changes.update_where(_parts(spark, folder), _even(), {"p_size": F.col("p_size") + 100})


def table_delete(spark, folder):
    """An unknown condition keeps the row."""
    condition = F.when(F.col("p_partkey") % 5 != 0, _even())
    return changes.delete_where(_parts(spark, folder), condition)


def _upsert_source(spark, folder):
    return _parts(spark, folder).select(
        (F.col("p_partkey") * 2).alias("p_partkey"), F.concat(F.lit("new "), F.col("p_name")).alias("p_name"), "p_size"
    )


def table_upsert(spark, folder):
    return changes.upsert(_parts(spark, folder), _upsert_source(spark, folder), ["p_partkey"])


def table_version(spark, folder):
    """Three versions of a table read from its log: as it began, updated, then with even keys deleted."""
    parts = _parts(spark, folder)
    log = ChangeLog(parts, scratch_path(spark, "parts"), ["p_partkey"])
    even = parts.where(_even())
    larger = changes.update_where(even, _even(), {"p_size": F.col("p_size") + 100})
    log.append(larger.withColumn("oc", F.lit("U")), ["p_partkey"], 0)
    log.append(even.select("p_partkey", F.lit("D").alias("oc")), ["p_partkey"], 1)
    versions = [log.read(v - 1).withColumn("version", F.lit(v)) for v in range(3)]
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


# -- clusters -----------------------------------------------------------------------


def kmeans_ranges(spark, folder):
    return cluster.cluster_ranges(table(spark, folder, "orders"), "o_totalprice", k=3)


def kmeans_time_ranges(spark, folder):
    return zoneless(cluster.time_ranges(table(spark, folder, "events"), "ts", k=3))


def kmeans_hex_ranges(spark, folder):
    hex_id = F.concat(F.lpad(F.lower(F.hex(F.unix_timestamp("ts"))), 8, "0"), F.lpad(F.lower(F.hex("event_id")), 16, "0"))
    return cluster.hex_id_ranges(table(spark, folder, "events").select(hex_id.alias("id")), "id", k=10)


def ranges_summary(name, ranges, low, high):
    """Rows covered, number of ranges, and whether they are disjoint."""
    # One entry per cluster.
    ordered = F.array_sort(F.collect_list(F.struct(F.col(low).alias("low"), F.col(high).alias("high"))))
    summary = ranges.agg(ordered.alias("r"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("clusters"))
    following = F.slice("r", 2, F.size("r"))
    pairs = F.zip_with(F.slice("r", 1, F.size("r") - 1), following, lambda a, b: a["high"] < b["low"])
    return summary.select(F.lit(name).alias("name"), "n", "clusters", F.forall(pairs, lambda ok: ok).alias("disjoint"))


def kmeans_ranges_ok(spark, folder):
    """Per clustering: rows covered, number of clusters, and whether the ranges are disjoint."""
    numbers = ranges_summary("numbers", kmeans_ranges(spark, folder), "range_min", "range_max")
    times = ranges_summary("times", kmeans_time_ranges(spark, folder), "left_bound", "right_bound")
    ids = ranges_summary("ids", kmeans_hex_ranges(spark, folder), "left_hex", "right_hex")
    return numbers.unionByName(times).unionByName(ids)


def kmeans_means_ok(spark, folder):
    """Whether the ends of each price range lie nearest to the mean of their own range (within 1 % of all prices' span).

    Equal thirds by count would not: prices are skewed. The trainer stops at a tolerance, hence ours.
    """
    prices = table(spark, folder, "orders").select(F.col("o_totalprice").cast("double").alias("v"))
    ranges = cluster.cluster_ranges(prices, "v", k=3).collect()  # three rows
    number = sum((F.col("v") >= r["range_min"]).cast("int") for r in ranges[1:])
    means = [r["m"] for r in prices.where(F.col("v").isNotNull()).groupBy(number.alias("c")).agg(F.avg("v").alias("m")).orderBy("c").collect()]
    slack = 0.01 * (ranges[-1]["range_max"] - ranges[0]["range_min"])
    nearest = all(
        abs(end - means[i]) <= abs(end - other) + slack for i, r in enumerate(ranges) for end in (r["range_min"], r["range_max"]) for other in means
    )
    return prices.agg(F.count("v").alias("n")).withColumn("nearest", F.lit(nearest))


# -- paths ---------------------------------------------------------------------------


def path_groups(spark, folder):
    """A page that is also a folder of more pages than fit keeps a NULL group."""
    return paths.path_groups(table(spark, folder, "pages"), 5, "url", strict=False)


def path_group_sizes(spark, folder):
    return paths.group_sizes(path_groups(spark, folder))


def path_conflicts(spark, folder):
    """Every tenth page gives its folder as a path of its own."""
    folders = F.when(F.col("page_id") % 10 == 0, F.regexp_replace("url", "/[^/]*/?$", "")).otherwise(F.col("url"))
    return paths.path_conflicts(table(spark, folder, "pages").select(folders.alias("path")))


def duplicate_paths(spark, folder):
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    return paths.duplicate_paths(table(spark, folder, "pages").select(host.alias("path")))


def ordered_events(spark, folder):
    """Position of each event in time order, without a single-task sort."""
    return ordered_index(table(spark, folder, "events").select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "idx")


_PREFIXES = """
WITH p AS (SELECT DISTINCT url AS path FROM pages),
x AS (SELECT path, substr(path, 1, n.n) AS prefix, n.n AS len FROM p, unnest(range(0, length(path) + 1)) AS n(n)),
c AS (SELECT prefix FROM x GROUP BY prefix HAVING count(*) <= 5),
g AS (SELECT path, arg_min(x.prefix, len) AS prefix FROM x JOIN c ON x.prefix = c.prefix GROUP BY path)
"""

_RANKS_OK = "SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS probability, true AS ok"

QUERIES = {
    "word_counts": (word_counts, _WORDS.format("documents")),
    "word_count_topk": (word_count_topk, _WORDS.format("documents") + " ORDER BY count DESC, word LIMIT 20"),
    "word_count_space": (word_count_space, """
SELECT word, count(*) AS count
FROM (SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []
                         ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents)
GROUP BY word"""),
    "word_count_user_code": (word_count_user_code, _WORDS.format("documents")),
    "first_events": (first_events, "SELECT * FROM events ORDER BY ts, event_id LIMIT 20"),
    "stream_static_left": (stream_static_left, """
SELECT user_id, event_id, c_name FROM events
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON c_custkey = user_id"""),
    "interval_join": (interval_join, """
SELECT i.event_id AS impression_id, i.user_id AS impression_ad_id, i.ts AS impression_time,
       c.event_id AS click_id, c.user_id AS click_ad_id, c.ts AS click_time
FROM events i JOIN events c ON i.user_id = c.user_id AND c.ts BETWEEN i.ts AND i.ts + INTERVAL 1 HOUR
WHERE i.event_type = 'view' AND c.event_type = 'click'"""),
    "set_state_merge": (set_state_merge, """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types,
       CAST(count(DISTINCT event_type) AS INTEGER) AS n
FROM events GROUP BY user_id"""),
    "latest_map_merge": (latest_map_merge, """
WITH e AS (SELECT user_id AS name, ts, event_id, ts >= TIMESTAMP '2024-01-16' AS late,
                  CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) END AS value FROM events),
h AS (SELECT name, late, value FROM
      (SELECT *, row_number() OVER (PARTITION BY name, late ORDER BY ts DESC, event_id DESC) AS rn FROM e) WHERE rn = 1)
SELECT coalesce(u.name, p.name) AS name, coalesce(u.value, p.value) AS value
FROM (SELECT * FROM h WHERE late) u FULL JOIN (SELECT * FROM h WHERE NOT late) p ON u.name = p.name"""),
    "agg_self_join": (agg_self_join, """
SELECT l_orderkey % 500 AS k, count(*) AS count,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) / count(*) AS avg_cents
FROM lineitem GROUP BY 1"""),
    "range_join": (range_join, """
WITH n AS (SELECT id % 500 AS k, count(*) AS count FROM range((SELECT max(o_orderkey) + 1 FROM orders)) r(id) GROUP BY 1),
a AS (SELECT o_orderkey % 500 AS k, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / count(*) AS avg_cents
      FROM orders GROUP BY 1)
SELECT k, count, true AS x_ok, avg_cents FROM n JOIN a USING (k)"""),
    "counts_by_type": (counts_by_type, "SELECT event_type, count(*) AS count FROM events GROUP BY 1"),
    "view_count": (view_count, "SELECT count(*) AS n FROM events"),
    "min_max_ts": (min_max_ts, "SELECT min(ts) AS min_value, max(ts) AS max_value FROM events"),
    "min_max_per_type": (min_max_per_type,
                         "SELECT event_type, min(ts) AS min_value, max(ts) AS max_value FROM events GROUP BY 1"),
    "bucket_sum": (bucket_sum, """
SELECT user_id, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') AS bucket_start,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS bucket_sum
FROM events GROUP BY 1, 2"""),
    "latest_by_key": (latest_by_key, "SELECT user_id, arg_max(value, (ts, -event_id)) AS latest FROM events GROUP BY 1"),
    "custom_avg": (custom_avg, """
SELECT event_type, round(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / count(value), 6) AS average
FROM events GROUP BY 1"""),
    "user_average": (user_average, """
SELECT event_type, round(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / count(value), 6) AS average
FROM events GROUP BY GROUPING SETS (event_type, ())"""),
    "user_average_sql": (user_average_sql, """
SELECT event_type, round(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / count(value), 6) AS average
FROM events GROUP BY 1"""),
    "user_latest": (user_latest, "SELECT user_id, arg_max(value, (ts, -event_id)) AS latest FROM events GROUP BY 1"),
    "theta_distinct_ok": (theta_distinct_ok, """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n, true AS ok FROM lineitem GROUP BY 1"""),
    "quantiles_exact": (quantiles_exact, """
SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS probability,
       unnest(quantile_disc(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0])) AS value FROM lineitem"""),
    "quantiles_approx_ok": (quantiles_approx_ok, _RANKS_OK),
    "kll_quantiles_ok": (kll_quantiles_ok, _RANKS_OK),
    "kll_merge_ok": (kll_merge_ok, _RANKS_OK),
    "value_histogram": (value_histogram, """
SELECT CAST((value >= 10)::INT + (value >= 50)::INT + (value >= 100)::INT AS INTEGER) AS bin, count(*) AS frequency,
       count(*) / (SELECT count(*) FROM events) AS mass
FROM events GROUP BY 1"""),
    "kll_histogram_ok": (kll_histogram_ok, "SELECT CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS bin, true AS ok"),
    "table_update": (table_update, """
SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_size + 100 ELSE p_size END AS p_size FROM part"""),
    "table_delete": (table_delete, """
SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey % 2 <> 0 OR p_partkey % 5 = 0"""),
    "table_upsert": (table_upsert, """
WITH s AS (SELECT p_partkey * 2 AS p_partkey, 'new ' || p_name AS p_name, p_size FROM part)
SELECT coalesce(s.p_partkey, t.p_partkey) AS p_partkey, CASE WHEN s.p_partkey IS NULL THEN t.p_name ELSE s.p_name END AS p_name,
       CASE WHEN s.p_partkey IS NULL THEN t.p_size ELSE s.p_size END AS p_size
FROM part t FULL JOIN s ON t.p_partkey = s.p_partkey"""),
    "table_version": (table_version, """
SELECT 0 AS version, p_partkey, p_name, p_size FROM part
UNION ALL SELECT 1, p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_size + 100 ELSE p_size END FROM part
UNION ALL SELECT 2, p_partkey, p_name, p_size FROM part WHERE p_partkey % 2 <> 0"""),
    "kmeans_ranges": (kmeans_ranges, f"""
SELECT low::DOUBLE / 100 AS range_min, high::DOUBLE / 100 AS range_max, n
FROM ({cluster.ranges_sql("SELECT round(o_totalprice * 100) AS v FROM orders", 3)})"""),
    "kmeans_time_ranges": (kmeans_time_ranges, f"""
SELECT make_timestamp_ms(low) AS left_bound, make_timestamp_ms(high) AS right_bound, n
FROM ({cluster.ranges_sql("SELECT epoch_us(ts) // 1000 AS v FROM events", 3)})"""),
    "kmeans_hex_ranges": (kmeans_hex_ranges, f"""
SELECT lower(hex(low)) AS left_hex, lower(hex(high)) AS right_hex, n
FROM ({cluster.ranges_sql("SELECT epoch_us(ts) // 1000000 AS v FROM events", 10)})"""),
    "kmeans_ranges_ok": (kmeans_ranges_ok, """
SELECT 'numbers' AS name, count(*) AS n, CAST(3 AS BIGINT) AS clusters, true AS disjoint FROM orders
UNION ALL SELECT 'times', count(*), 3, true FROM events UNION ALL SELECT 'ids', count(*), 10, true FROM events"""),
    "kmeans_means_ok": (kmeans_means_ok, "SELECT count(o_totalprice) AS n, true AS nearest FROM orders"),
    "path_groups": (path_groups, _PREFIXES + "SELECT p.path, g.prefix FROM p LEFT JOIN g ON p.path = g.path"),
    "path_group_sizes": (path_group_sizes, _PREFIXES + """
SELECT prefix, count(*) AS n_files, min(path) AS first_path FROM g GROUP BY prefix"""),
    "path_conflicts": (path_conflicts, """
WITH p AS (SELECT DISTINCT CASE WHEN page_id % 10 = 0 THEN regexp_replace(url, '/[^/]*/?$', '') ELSE url END AS path FROM pages)
SELECT a.path, min(b.path) AS first_below
FROM p a JOIN p b ON starts_with(b.path, a.path) AND a.path <> b.path GROUP BY a.path"""),
    "duplicate_paths": (duplicate_paths, """
SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS path, count(*) AS n FROM pages GROUP BY 1 HAVING count(*) > 1"""),
    "ordered_events": (ordered_events, """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events"""),
}
