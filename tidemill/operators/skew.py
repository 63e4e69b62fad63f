"""Hot keys: finding them and splitting the work they cause."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut

#: A group of fewer rows is left to a single task.
HOT_ROWS = 10_000_000
#: Hot groups are broadcast up to this number.
BROADCAST_ROWS = 500_000


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Key groups of more than ``hot_rows`` rows as ``keys..., _splits``, None if there are none.

    The counts are combined map-side, so a hot key costs nothing here.
    """
    return hot_of_counts(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, hot_rows)


def hot_of_counts(counts: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """:func:`hot_groups` from counts ``keys..., _n`` that are there already.

    A group gets a split for every ``hot_rows`` rows of its own, at every size of the data. The groups number at most
    all rows / ``hot_rows``; they are written once, and joins broadcast them (see :func:`small`).
    """
    splits = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_splits")
    hot = cut(counts.where(F.col("_n") > hot_rows).select(*keys, splits))
    return None if hot.isEmpty() else hot


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A written frame, marked for broadcast if it has at most ``limit`` rows; beyond that Spark joins it as any other."""
    return F.broadcast(df) if df.count() <= limit else df


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows of other groups, rows of hot groups)``; ``hot`` comes from :func:`hot_groups`."""
    wanted = small(hot.drop("_splits")).alias("h")
    same = _same("d", "h", keys)
    return df.alias("d").join(wanted, same, "left_anti"), df.alias("d").join(wanted, same, "left_semi")


def equi_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: Sequence[str],
    right_id: Sequence[str],
    condition: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join on ``keys`` and ``condition`` (written over ``l.`` and ``r.``) that splits hot keys.

    For a hot key the left rows are cut into n parts and the right rows into m
    by a hash of their ids; each left part meets each right part in its own
    task. All other keys are joined once.
    """
    hot_left = hot_groups(left, keys, hot_rows)
    hot_right = hot_groups(right, keys, hot_rows)
    equal = F.lit(True)
    for name in keys:
        equal = equal & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    if hot_left is None and hot_right is None:
        return left.alias("l").join(right.alias("r"), equal & condition)
    grid = _grid(hot_left, hot_right, keys)
    left_salted = _salted(left, keys, grid, left_id, own="_n", other="_m", own_salt="_left_part", other_salt="_right_part")
    right_salted = _salted(right, keys, grid, right_id, own="_m", other="_n", own_salt="_right_part", other_salt="_left_part")
    equal = equal & (F.col("l._left_part") == F.col("r._left_part")) & (F.col("l._right_part") == F.col("r._right_part"))
    return left_salted.alias("l").join(right_salted.alias("r"), equal & condition)


def _grid(hot_left: DataFrame | None, hot_right: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Number of left and right parts per hot key."""
    sides = []
    for frame, name in ((hot_left, "_n"), (hot_right, "_m")):
        if frame is not None:
            other = "_m" if name == "_n" else "_n"
            sides.append(frame.withColumnRenamed("_splits", name).withColumn(other, F.lit(1)))
    both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    return both.groupBy(*keys).agg(F.max("_n").alias("_n"), F.max("_m").alias("_m"))


def _salted(
    df: DataFrame, keys: Sequence[str], grid: DataFrame, ids: Sequence[str],
    own: str, other: str, own_salt: str, other_salt: str,
) -> DataFrame:
    joined = df.alias("d").join(small(grid).alias("h"), _same("d", "h", keys), "left")
    parts = F.coalesce(F.col(f"h.{own}"), F.lit(1))
    copies = F.coalesce(F.col(f"h.{other}"), F.lit(1))
    return joined.select(
        "d.*",
        F.pmod(F.xxhash64(*[F.col(f"d.{c}") for c in ids]), parts).cast("int").alias(own_salt),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias(other_salt),
    )
