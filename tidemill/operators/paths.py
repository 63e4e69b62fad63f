"""Grouping of file paths by their shortest common prefix with few enough files.

Paths are sorted in parallel and numbered. A prefix holds more than ``limit``
paths exactly if some path and the one ``limit`` places further on share it, so
the common prefix lengths of such pairs are all that is needed. No path is ever
exploded into its prefixes, so the work does not grow with path length and a
prefix common to all paths is not hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.ordered import ordered_index

#: Rows in which neighbours are looked for together.
_BLOCK = 10_000


def common_prefix_length(left: Column, right: Column) -> Column:
    """Number of leading characters two texts share."""
    same = F.zip_with(F.split(left, ""), F.split(right, ""), lambda a, b: a.eqNullSafe(b))
    first_difference = F.array_position(same, F.lit(False))
    return F.when(first_difference > 0, first_difference - 1).otherwise(F.length(left)).cast("int")


def _numbered(df: DataFrame, path: str) -> DataFrame:
    distinct = df.select(F.col(path).alias("path")).where(F.col("path").isNotNull()).distinct()
    return ordered_index(distinct, ["path"])


def path_conflicts(df: DataFrame, path: str = "path") -> DataFrame:
    """Paths that are also a folder of another path, as ``path, first_below``.

    In sorted order everything below a path follows it at once, so looking at
    the next path is enough.
    """
    return _conflicts(_numbered(df, path))


def _conflicts(numbered: DataFrame) -> DataFrame:
    # The first row of a block also goes to the block before, so every row finds the next one in its block.
    block = F.floor(F.col("idx") / _BLOCK)
    at_border = F.col("idx") % _BLOCK == 0
    blocks = F.when(at_border, F.array(block, block - 1)).otherwise(F.array(block))
    placed = numbered.select("*", F.explode(blocks).alias("_block"))
    following = F.lead("path").over(Window.partitionBy("_block").orderBy("idx"))
    # A row sent to the block before is the last one there and has no following row.
    return (
        placed.withColumn("first_below", following)
        .where(F.startswith("first_below", "path"))
        .select("path", "first_below")
    )


def duplicate_paths(df: DataFrame, path: str = "path") -> DataFrame:
    """Paths listed more than once."""
    return df.groupBy(F.col(path).alias("path")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def path_groups(df: DataFrame, limit: int, path: str = "path", strict: bool = True) -> DataFrame:
    """Each distinct path with its group's prefix, as ``path, prefix``.

    The prefix is the shortest one with at most ``limit`` paths. ``strict``
    refuses a list with conflicts (:func:`path_conflicts`); otherwise a path
    that no prefix fits is kept with a NULL prefix.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    numbered = _numbered(df, path)
    if strict:
        conflict = _conflicts(numbered).first()
        if conflict is not None:
            raise ValueError(f"path {conflict.path} is also a folder of {conflict.first_below}")
    # Blocks of limit + 1 rows; each is worked on with the one before and the one after it, in one shuffle.
    size = limit + 1
    block = F.floor(F.col("idx") / size)
    near = numbered.withColumn("_block", block).withColumn("_near", F.explode(F.array(block - 1, block, block + 1)))
    in_order = Window.partitionBy("_near").orderBy("idx")
    ahead = near.withColumn("_ahead", F.lead("path", limit).over(in_order)).where(F.col("_block") <= F.col("_near"))
    # shared = length of the longest prefix common to paths idx .. idx + limit
    shared = F.when(F.col("_ahead").isNotNull(), common_prefix_length(F.col("path"), F.col("_ahead")))
    # Longest over the pairs idx-limit .. idx: the part in the own block is a running maximum, the part in the
    # block before a running maximum from its end. Blocks follow idx, so the maximum of (block, shared) is the
    # current block's, and one order each way is enough.
    from_end = Window.partitionBy("_near").orderBy(F.desc("idx"))
    running = (Window.unboundedPreceding, Window.currentRow)
    longest = (
        ahead.select("_near", "_block", "idx", "path", shared.alias("shared"))
        .withColumn("_own", F.max(F.struct("_block", "shared")).over(in_order.rowsBetween(*running))["shared"])
        .withColumn("_tail", F.max(F.struct(-F.col("_block"), "shared")).over(from_end.rowsBetween(*running))["shared"])
        .withColumn("_before", F.lead("_tail", limit).over(from_end))
        .where(F.col("_block") == F.col("_near"))
    )
    length = F.coalesce(F.greatest("_own", "_before"), F.lit(-1)) + 1
    return longest.select(
        "path", F.when(length <= F.length("path"), F.substring(F.col("path"), F.lit(1), length)).alias("prefix")
    )


def group_sizes(groups: DataFrame) -> DataFrame:
    """Number of paths per group and its first path."""
    return groups.where(F.col("prefix").isNotNull()).groupBy("prefix").agg(
        F.count(F.lit(1)).alias("n_files"), F.min("path").alias("first_path")
    )
