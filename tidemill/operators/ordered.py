"""Order-dependent operators without a single-task sort: row index and running sum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.skew import HOT_ROWS, hot_groups, split_hot
from tidemill.session import cut

_POSITION_BITS = 33  # row position bits of monotonically_increasing_id


def _partitions(df: DataFrame, parts: int | None) -> int:
    return parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ordered_index(df: DataFrame, order: Sequence[str], name: str = "idx", parts: int | None = None) -> DataFrame:
    """Add the row's position 0, 1, 2, ... in the total order of ``order`` (which must be unique).

    Range partitioning sorts in parallel. Its sampled bounds are frozen by a
    checkpoint, then each partition adds the row counts of those before it.
    """
    parts = _partitions(df, parts)
    placed = cut(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", _POSITION_BITS))
        .withColumn("_row", F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    )
    sizes = sorted(placed.groupBy("_part").count().collect())  # one row per partition
    first, offsets = 0, []
    for part, size in sizes:
        offsets.append((part, first))
        first += size
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _first bigint")
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_first") + F.col("_row"))
        .drop("_part", "_row", "_first")
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "running",
    hot_rows: int = HOT_ROWS,
    parts: int | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to this row, in a unique order.

    Ordinary keys use a window. A hot key is cut into ranges of its order; each
    range sums on its own and adds the totals of the ranges before it.
    """
    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        return windowed_sum(df, keys, order, value, name)
    ordinary, heavy = split_hot(df, keys, hot)
    return windowed_sum(ordinary, keys, order, value, name).unionByName(ranged_sum(heavy, keys, order, value, name, parts))


def windowed_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """:func:`running_sum` with one task per key."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(frame))


def ranged_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, parts: int | None = None
) -> DataFrame:
    """:func:`running_sum` with each key cut into ranges of its order."""
    placed = cut(df.repartitionByRange(_partitions(df, parts), *keys, *order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per hot key and range it reaches: fewer than keys + ranges.
    totals = (
        placed.groupBy(*keys, "_part")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .drop("_sum")
    )
    within = windowed_sum(placed, [*keys, "_part"], order, value, "_within")
    same = F.col("w._part") == F.col("t._part")
    for key in keys:
        same = same & F.col(f"w.{key}").eqNullSafe(F.col(f"t.{key}"))
    return (
        within.alias("w")
        .join(F.broadcast(totals).alias("t"), same)
        .select(*[F.col(f"w.{c}") for c in df.columns], (F.col("_within") + F.col("_before")).alias(name))
    )
