"""Joins of streams and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.sets import union_sets
from tidemill.operators.skew import HOT_ROWS, equi_join


def with_static(events: DataFrame, static: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left outer join with a static table; events without a partner keep NULLs.

    No broadcast hint: Spark broadcasts the table when its size allows and
    otherwise sorts, where AQE splits hot event keys. Works on streams too.
    """
    return events.join(static, on, "left_outer")


def within_interval(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_ts: str,
    right_ts: str,
    seconds: int,
    left_id: Sequence[str],
    right_id: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pairs with equal keys and ``left_ts <= right_ts <= left_ts + seconds``, for tables.

    Time is part of the join key: a left row sits in its own bucket of
    ``seconds``, a right row looks into its own and the one before, so each pair
    meets once and a key's rows far apart in time never meet. The two frames
    must not share column names.
    """
    width = F.lit(seconds * 1_000_000)

    def bucket(ts: str):
        micros = F.unix_micros(F.col(ts))
        return ((micros - F.pmod(micros, width)) / width).cast("bigint")

    lefts = left.where(F.col(left_key).isNotNull()).withColumn("_k", F.col(left_key)).withColumn("_b", bucket(left_ts))
    rights = (
        right.where(F.col(right_key).isNotNull())
        .withColumn("_k", F.col(right_key))
        .withColumn("_b", F.explode(F.array(bucket(right_ts), bucket(right_ts) - 1)))
    )
    in_time = (F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}")) & (
        F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + F.make_interval(secs=F.lit(seconds))
    )
    joined = equi_join(lefts, rights, ["_k", "_b"], left_id, right_id, in_time, hot_rows)
    return joined.select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in right.columns])


def merge_sets(new: DataFrame, kept: DataFrame, keys: Sequence[str], members: str) -> DataFrame:
    """Full outer join of two tables of small sets, with the union of both sets."""
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"n.{key}") == F.col(f"k.{key}"))
    return (
        new.alias("n")
        .join(kept.alias("k"), same, "full_outer")
        .select(
            *[F.coalesce(F.col(f"n.{key}"), F.col(f"k.{key}")).alias(key) for key in keys],
            union_sets(F.col(f"n.{members}"), F.col(f"k.{members}")).alias(members),
        )
    )


def on_derived_key(left: DataFrame, right: DataFrame, key: str = "k") -> DataFrame:
    """Inner join of two aggregates on a derived key."""
    return left.join(right, key)
