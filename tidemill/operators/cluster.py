"""One-dimensional k-means by exact arithmetic, and the value range of each cluster.

Lloyd's rounds need only the count and sum of the values up to each of k - 1 bounds.
They come from histograms of whole numbers: one of the whole span, and finer ones of
the few buckets that a bound falls into. So a round reads at most those buckets from
a copy of the values sorted by range, nothing depends on partitions or on the order
of rows, and the result is the same on any cluster.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.timefn import hex_id_seconds, to_hex
from tidemill.session import scratch_path

#: Buckets of a histogram: what a job sends to the driver at most for each histogram it works out.
FANOUT = 1 << 16
#: Rounds after which something is wrong; every round lowers the sum of squares.
MOST_ROUNDS = 10_000
#: Buckets on either side of a foreseen bound that are read along with its own, and how many rounds are foreseen.
BESIDE, FORESEEN = 2, 50
#: Histograms that are picked by comparing ranges, which the scan can use to skip row groups.
FEW = 8
#: Parts of a value that occurs very often, in the sorted copy.
SALTS = 1024


class _Missing(Exception):
    """A histogram that has to be worked out first."""


class _Histogram:
    """Filled buckets of a histogram with the running counts and sums at their ends."""

    def __init__(self, rows):
        rows = sorted(rows)
        self.buckets = [b for b, _, _ in rows]
        self.counts = list(accumulate((n for _, n, _ in rows), initial=0))
        self.sums = list(accumulate((s for _, _, s in rows), initial=0))


class RunningCounts:
    """Counts and sums of a column ``v`` of whole numbers up to any value, and values by rank.

    Values count from the least one. Level 0 is one histogram of all with buckets of ``steps[0]`` values, and each bucket
    of a level is a histogram of the next, down to buckets of one value. The steps are powers of :data:`FANOUT`.
    """

    def __init__(self, values: DataFrame):
        spark = values.sparkSession
        path = scratch_path(spark, "values")
        # A value on very many rows is spread over several parts.
        salted = values.withColumn("salt", F.monotonically_increasing_id() % SALTS)
        salted.repartitionByRange("v", "salt").sortWithinPartitions("v").select("v").write.parquet(path)
        self.values = spark.read.schema("v bigint").parquet(path)
        self.low, self.high, self.total = self.values.agg(F.min("v"), F.max("v"), F.count("v")).first()
        self.known: dict[tuple[int, int], _Histogram] = {}
        self.steps = []
        # Powers of the fan-out, so that buckets of a level are whole ones of the next.
        if self.low is not None:
            levels = 1
            while FANOUT**levels <= self.high - self.low:
                levels += 1
            self.steps = [FANOUT**i for i in reversed(range(levels))]

    def _work_out(self, level: int, places: list[int]) -> None:
        """Histograms of some buckets of the level above, in one job."""
        v, step = F.col("v") - F.lit(self.low), self.steps[level]
        rows = self.values
        if level == 0:
            place, inside = F.lit(0).cast("bigint"), v
        else:
            above = self.steps[level - 1]
            place = F.expr(f"(v - {self.low}L) div {above}L")
            inside = v - place * above
            spans = [(self.low + p * above, self.low + (p + 1) * above - 1) for p in sorted(places)]
            if len(spans) <= FEW:
                chosen = F.lit(False)
                for low, high in spans:
                    chosen = chosen | F.col("v").between(low, high)
                rows = rows.where(chosen)
            else:
                rows = rows.where(F.col("v").between(spans[0][0], spans[-1][1]) & place.isin(places))
        placed = rows.select("v", place.alias("place"), inside.alias("inside")).withColumn("bucket", F.expr(f"inside div {step}L"))
        grouped = placed.groupBy("place", "bucket").agg(
            F.count("v").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")
        ).toArrow()  # at most FANOUT rows per histogram
        found = {p: [] for p in places}
        for p, bucket, n, s in zip(*(grouped.column(c).to_pylist() for c in ("place", "bucket", "n", "s"))):
            found[p].append((bucket, n, int(s)))
        for p, part in found.items():
            self.known[level, p] = _Histogram(part)

    def _histogram(self, level: int, place: int) -> _Histogram:
        if (level, place) not in self.known:
            raise _Missing(level, place)
        return self.known[level, place]

    def _answer(self, ask, values):
        """The answers of several look-ups; the histograms they lack are worked out together, level by level."""
        while True:
            answers, missing = [], {}
            for value in values:
                try:
                    answers.append(ask(value))
                except _Missing as problem:
                    level, place = problem.args
                    missing.setdefault(level, set()).add(place)
            if not missing:
                return answers
            for level, places in missing.items():
                self._work_out(level, sorted(places))

    def _up_to(self, bound: int) -> tuple[int, int]:
        count = sum_ = place = 0
        offset = bound - self.low
        if offset < 0:
            return 0, 0
        for level, step in enumerate(self.steps):
            bucket, offset = divmod(offset, step)
            whole = offset == step - 1 or bound >= self.high
            here = self._histogram(level, place)
            at = bisect_right(here.buckets, bucket) if whole else bisect_left(here.buckets, bucket)
            count, sum_ = count + here.counts[at], sum_ + here.sums[at]
            if whole or at == len(here.buckets) or here.buckets[at] != bucket:
                break
            place = self._place(level, bound)
        return count, sum_

    def _place(self, level: int, value: int) -> int:
        """Number of the bucket of a level that holds the value, over all its histograms."""
        return (value - self.low) // self.steps[level]

    def _at_rank(self, rank: int) -> int:
        value, place = self.low, 0
        for level, step in enumerate(self.steps):
            here = self._histogram(level, place)
            at = bisect_left(here.counts, rank) - 1
            rank -= here.counts[at]
            value += here.buckets[at] * step
            place = self._place(level, value)
        return value

    def up_to(self, bounds) -> list[tuple[int, int]]:
        """Count and sum of the values that are not above each bound."""
        return self._answer(self._up_to, bounds)

    def at_ranks(self, ranks) -> list[int]:
        """The values at ranks 1, 2, ..."""
        return self._answer(self._at_rank, ranks)

    def foresee(self, bounds: list[int]) -> None:
        """Read ahead: rounds on the coarse histogram alone tell which of its buckets the bounds will pass."""
        if len(self.steps) < 2 or not bounds:
            return
        self.up_to([self.high])
        root, step, places = self.known[0, 0], self.steps[0], set()

        def about(bound):
            at = bisect_right(root.buckets, (bound - self.low) // step)
            return root.counts[at], root.sums[at]

        for _ in range(FORESEEN):
            for bound in bounds:
                bucket = (bound - self.low) // step
                places.update(range(max(0, bucket - BESIDE), bucket + BESIDE + 1))
            moved = _moved([(0, 0), *map(about, [*bounds, self.high])])
            if moved == bounds:
                break
            bounds = moved
        filled = set(root.buckets)
        if new := sorted(p for p in places if p in filled and (1, p) not in self.known):
            self._work_out(1, new)


def _moved(ends) -> list[int]:
    """The next bounds: between two means, rounded down, from the counts and sums up to the present bounds."""
    clusters = [(n1 - n0, s1 - s0) for (n0, s0), (n1, s1) in zip(ends, ends[1:]) if n1 > n0]
    return [(s * m + t * n) // (2 * n * m) for (n, s), (m, t) in zip(clusters, clusters[1:])]


def whole_ranges(values: DataFrame, k: int) -> list[tuple[int, int, int]]:
    """Least value, greatest value and number of values of each cluster of a column ``v`` of whole numbers, in order.

    Rounds begin at the k-quantiles and end when no value changes its cluster. A value midway between two means belongs
    to the lower one. Equal values share a cluster, so there are fewer than ``k`` clusters if quantiles are equal.
    """
    counts = RunningCounts(values)
    if counts.low is None:
        return []
    starts = counts.at_ranks([-(-i * counts.total // k) for i in range(1, k)])
    bounds = sorted({b for b in starts if b < counts.high})
    counts.foresee(bounds)
    for _ in range(MOST_ROUNDS):
        ends = [(0, 0), *counts.up_to([*bounds, counts.high])]
        moved = _moved(ends)
        if moved == bounds:
            break
        bounds = moved
    else:
        raise RuntimeError("clusters did not settle")
    ranks = [n for n, _ in ends]
    edges = counts.at_ranks([r for a, b in zip(ranks, ranks[1:]) for r in (a + 1, b)])
    return [(edges[2 * i], edges[2 * i + 1], b - a) for i, (a, b) in enumerate(zip(ranks, ranks[1:]))]


def cluster_ranges(df: DataFrame, value: str, k: int = 3, per_unit: int = 100) -> DataFrame:
    """``range_min, range_max, n`` per cluster of a numeric column, in value order; nulls belong to none.

    Whole numbers are taken as they are, other values to the nearest ``1 / per_unit``.
    """
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    scale = 1 if whole else per_unit
    v = F.col(value).cast("bigint") if whole else F.round(F.col(value) * per_unit).cast("bigint")
    found = whole_ranges(df.select(v.alias("v")).where("v is not null"), k)
    rows = [(low / scale, high / scale, n) for low, high, n in found]
    return df.sparkSession.createDataFrame(rows, "range_min double, range_max double, n bigint")


def time_ranges(df: DataFrame, ts: str, k: int = 3) -> DataFrame:
    """``left_bound, right_bound, n`` per cluster of timestamps, clustered by milliseconds."""
    found = whole_ranges(df.select(F.unix_millis(ts).alias("v")).where("v is not null"), k)
    ranges = df.sparkSession.createDataFrame(found, "low bigint, high bigint, n bigint")
    return ranges.select(F.timestamp_millis("low").alias("left_bound"), F.timestamp_millis("high").alias("right_bound"), "n")


def hex_id_ranges(df: DataFrame, hex_id: str, k: int = 10) -> DataFrame:
    """``left_hex, right_hex, n`` per cluster of the creation times inside hex ids."""
    seconds = df.select(hex_id_seconds(F.col(hex_id)).cast("bigint").alias("v")).where("v is not null")
    ranges = df.sparkSession.createDataFrame(whole_ranges(seconds, k), "low bigint, high bigint, n bigint")
    return ranges.select(to_hex(F.col("low")).alias("left_hex"), to_hex(F.col("high")).alias("right_hex"), "n")


def ranges_sql(values: str, k: int, group: str = "") -> str:
    """DuckDB SQL for ``low, high, n`` of each cluster by the same rounds; ``values`` selects whole numbers ``v``.

    ``group`` names a further column of ``values`` (``part``): clusters are found in each of its groups.
    """
    comma, same = (f"{group}, ", f"AND it.{group} = vals.{group}") if group else ("", "")
    by = f"GROUP BY {group}" if group else ""
    return f"""
WITH RECURSIVE vals AS (SELECT {comma}v::HUGEINT AS v, count(*)::HUGEINT AS n FROM ({values}) WHERE v IS NOT NULL GROUP BY ALL),
ranked AS (SELECT {comma}v, sum(n) OVER ({f'PARTITION BY {group} ' if group else ''}ORDER BY v) AS upto, sum(n) OVER ({f'PARTITION BY {group}' if group else ''}) AS total,
                  max(v) OVER ({f'PARTITION BY {group}' if group else ''}) AS top FROM vals),
starts AS (SELECT {comma}r.i, min(v) AS b, any_value(top) AS top FROM ranked, range(1, {k}) r(i) WHERE upto >= (r.i * total + {k} - 1) // {k} GROUP BY {comma}r.i),
it AS (
  SELECT {comma}0 AS round, coalesce(list_sort(list_distinct(list(b) FILTER (WHERE b < top))), []::HUGEINT[]) AS bounds FROM starts {by}
  UNION ALL
  SELECT {comma}round + 1, moved FROM (
    SELECT {comma}round, bounds, list_transform(range(1, len(c)), lambda i: (c[i].s * c[i + 1].n + c[i + 1].s * c[i].n) // (2 * c[i].n * c[i + 1].n)) AS moved
    FROM (
      SELECT {comma}round, bounds, list({{'n': n, 's': s}} ORDER BY nr) AS c
      FROM (SELECT {f'it.{group}, ' if group else ''}round, bounds, len(list_filter(bounds, lambda b: vals.v > b)) AS nr, sum(n)::HUGEINT AS n, sum(v * n)::HUGEINT AS s
            FROM it, vals WHERE true {same} GROUP BY ALL)
      GROUP BY {comma}round, bounds))
  WHERE moved <> bounds
),
final AS (SELECT {comma}arg_max(bounds, round) AS bounds FROM it {by})
SELECT {f'final.{group}, ' if group else ''}min(v)::BIGINT AS low, max(v)::BIGINT AS high, sum(n)::BIGINT AS n
FROM final, vals {f'WHERE final.{group} = vals.{group}' if group else ''}
GROUP BY {f'final.{group}, ' if group else ''}len(list_filter(bounds, lambda b: vals.v > b))
"""
