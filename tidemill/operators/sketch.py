"""Mergeable sketches, quantiles and histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import cut


# -- distinct counts -------------------------------------------------------

def theta_sketches(df: DataFrame, keys: Sequence[str], column: str, log2_size: int = 12) -> DataFrame:
    """One theta sketch per key, as bytes of bounded size."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(column, log2_size).alias("sketch"))


def theta_union(sketches: DataFrame, keys: Sequence[str] = (), sketch: str = "sketch") -> DataFrame:
    """Union of stored sketches; NULL sketches are passed over."""
    return sketches.groupBy(*keys).agg(F.theta_union_agg(sketch).alias(sketch))


def theta_estimate(sketch: Column | str = "sketch") -> Column:
    return F.theta_sketch_estimate(sketch)


# -- quantiles -------------------------------------------------------------

def quantiles_approx(df: DataFrame, column: str, probabilities: Sequence[float], error: float) -> DataFrame:
    """Quantiles with a relative rank error, as ``probability, value`` rows."""
    if error <= 0:
        return quantiles_exact(df, column, probabilities)
    probs = [float(p) for p in probabilities]
    accuracy = max(1, math.ceil(1 / error))
    values = df.agg(F.percentile_approx(column, probs, accuracy).alias("v"))
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("probability"), F.col("v").alias("value"))
    return values.select(F.explode(pairs).alias("q")).select("q.probability", "q.value")


_BRACKET_ACCURACY = 1000  # a sketched quantile is at most 1 / 1000 of all ranks off


def quantiles_exact(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """The value at rank ``ceil(p * n)`` for each probability, at any size.

    A sketch brackets each quantile between two values; only the rows between
    them, some thousandths of all, are counted and sorted by range
    partitioning. The brackets are checked by counts, and if one should fail
    all rows are sorted instead. Neither rows nor a full summary reach the driver.
    """
    probs = [float(p) for p in probabilities]
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    slack = 2 / _BRACKET_ACCURACY
    edges = [min(1.0, max(0.0, edge)) for p in probs for edge in (p - slack, p + slack)]
    total, found = values.agg(
        F.count(F.lit(1)), F.percentile_approx("value", edges, _BRACKET_ACCURACY)
    ).first()
    if not total:
        return _at_ranks(values, [])
    ranks = {p: max(1, math.ceil(p * total - 1e-9)) for p in probs}
    intervals = _disjoint(sorted(zip(found[::2], found[1::2])))
    sizes = values.agg(*[
        count
        for low, high in intervals
        for count in (F.count_if(F.col("value") < low), F.count_if(F.col("value").between(low, high)))
    ]).first()
    targets, covered = [], set()
    for number, (below, size) in enumerate(zip(sizes[::2], sizes[1::2])):
        for p in probs:
            if below < ranks[p] <= below + size and p not in covered:
                covered.add(p)
                targets.append((number, ranks[p] - below, p))
    if len(covered) < len(set(probs)):
        return _at_ranks(values.withColumn("interval", F.lit(0)), [(0, ranks[p], p) for p in probs])
    number = F.coalesce(*[F.when(F.col("value").between(low, high), i) for i, (low, high) in enumerate(intervals)])
    inside = values.withColumn("interval", number).where(F.col("interval").isNotNull())
    return _at_ranks(inside, targets)


def _disjoint(brackets: list[tuple]) -> list[tuple]:
    """Sorted brackets with overlapping ones merged."""
    merged = []
    for low, high in brackets:
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _at_ranks(values: DataFrame, targets: list[tuple[int, int, float]]) -> DataFrame:
    """Values at ranks inside intervals: ``targets`` are (interval, rank, probability).

    Equal values are counted map-side first, so a value that fills a third of the rows is one row here.
    """
    if not targets:
        return values.select(F.lit(0.0).alias("probability"), "value").limit(0)
    spark = values.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = values.groupBy("interval", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = cut(counts.repartitionByRange(parts, "interval", "value").withColumn("part", F.spark_partition_id()))
    # One row per partition and interval.
    totals = sorted(placed.groupBy("interval", "part").agg(F.sum("n")).collect())
    wanted = []
    for interval, rank, p in targets:
        for at, part, n in totals:
            if at == interval:
                if rank <= n:
                    wanted.append((interval, part, rank, p))
                    break
                rank -= n
    goals = spark.createDataFrame(wanted, "interval int, part int, rank bigint, probability double")
    up_to = Window.partitionBy("interval", "part").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    hit_parts = sorted({part for _, part, _, _ in wanted})
    ranked = placed.where(F.col("part").isin(hit_parts)).withColumn("upto", F.sum("n").over(up_to))
    hit = (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))
    return ranked.join(F.broadcast(goals), ["interval", "part"]).where(hit).select("probability", "value")


def kll_sketches(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """One quantile sketch per key, as bytes of bounded size."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(column).cast("double")).alias("sketch"))


def kll_union(sketches: DataFrame, keys: Sequence[str] = (), sketch: str = "sketch") -> DataFrame:
    """Merge of stored quantile sketches."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(sketch).alias(sketch))


def kll_quantile(sketch: Column | str, probability: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(probability)))


def kll_rank(sketch: Column | str, value: float) -> Column:
    """Share of values at or below ``value``."""
    return F.kll_sketch_get_rank_double(sketch, F.lit(float(value)))


# -- histograms ------------------------------------------------------------

def histogram(df: DataFrame, column: str, splits: Sequence[float]) -> DataFrame:
    """Exact count and share per bin ``(-inf, s0), [s0, s1), ..., [sk, inf)``."""
    ordered = sorted(float(s) for s in splits)
    bin_number = F.lit(0)
    for split in ordered:
        bin_number = bin_number + (F.col(column) >= split).cast("int")
    per_bin = F.array(*[F.count_if(bin_number == i) for i in range(len(ordered) + 1)])
    counted = df.where(F.col(column).isNotNull()).agg(per_bin.alias("counts"), F.count(F.lit(1)).alias("total"))
    return counted.select(F.posexplode("counts").alias("bin", "frequency"), "total").select(
        "bin", "frequency", (F.col("frequency") / F.nullif("total", F.lit(0))).alias("mass")
    )


def kll_mass(sketch: Column | str, splits: Sequence[float]) -> Column:
    """Share per bin from a sketch, as an array; a bin's upper bound is exclusive.

    The sketch ranks values at or below its argument, so each split is moved to
    the next smaller double.
    """
    ranks = [kll_rank(sketch, math.nextafter(float(s), -math.inf)) for s in sorted(splits)]
    edges = [F.lit(0.0), *ranks, F.lit(1.0)]
    return F.array(*[upper - lower for lower, upper in zip(edges, edges[1:])])
