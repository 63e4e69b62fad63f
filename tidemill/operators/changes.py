"""Changes to a table: conditional update and delete, upsert, change-feed merge.

Each returns the table's new content.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows for which the condition is true."""
    return df.select([
        F.when(condition, assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
        if c in assignments
        else F.col(c)
        for c in df.columns
    ])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Without the rows for which the condition is true; an unknown condition keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, failing the query if a key occurs twice."""
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*[F.col(c) for c in rest])).alias("_row")
    )
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit("source has several rows for one key")).cast("boolean"))
    return grouped.where(checked.isNull()).select(*keys, "_row.*").select(df.columns)


def _key_match(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"t.{key}") == F.col(f"s.{key}"))
    return condition


def _pick(target: DataFrame, source: DataFrame, from_source: Column) -> list[Column]:
    """Target columns, taken from the source row where told so; absent source columns are NULL."""
    given = set(source.columns)
    return [
        F.when(from_source, F.col(f"s.{f.name}") if f.name in given else F.lit(None))
        .otherwise(F.col(f"t.{f.name}"))
        .cast(f.dataType)
        .alias(f.name)
        for f in target.schema.fields
    ]


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source's values, the others are inserted."""
    s = one_row_per_key(source, keys).withColumn("_s", F.lit(True)).alias("s")
    return target.alias("t").join(s, _key_match(keys), "full_outer").select(
        *_pick(target, source, F.col("s._s").isNotNull())
    )


def merge_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], op: str = "oc") -> DataFrame:
    """Apply one change per key: D deletes, U updates, anything but D inserts a missing row.

    An I on an existing row changes nothing, nor does a row without op.
    """
    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = changes.withColumn("_s", F.lit(True)).alias("s")
    op_col = F.col(f"s.{op}")
    in_target, in_source = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    both = in_target & in_source
    keep = (
        F.when(both, F.coalesce(op_col != "D", F.lit(True)))
        .when(in_target, F.lit(True))
        .otherwise(F.coalesce(op_col != "D", F.lit(False)))
    )
    from_source = F.when(both, F.coalesce(op_col == "U", F.lit(False))).otherwise(in_source)
    return t.join(s, _key_match(keys), "full_outer").where(keep).select(*_pick(target, changes, from_source))


def effective_changes(log: DataFrame, keys: Sequence[str], batch: str, op: str = "oc") -> DataFrame:
    """One change per key that does to a table what merging its changes in order of ``batch`` would do.

    ``log`` has at most one row per key and batch. A D or U settles a key whatever came before; of the changes after
    it only the first can insert, and only after a D. Rows without op change nothing. One shuffle, by the keys.
    """
    settles = F.col(op).isin("D", "U")
    after = Window.partitionBy(*keys).orderBy(F.desc(batch)).rowsBetween(Window.unboundedPreceding, -1)
    rest = [c for c in log.columns if c not in (*keys, batch)]
    row = F.struct(*rest)
    by_key = (
        log.where(F.col(op).isNotNull())
        .withColumn("_settled_later", F.coalesce(F.max(settles).over(after), F.lit(False)))
        .where(~F.col("_settled_later"))
        .groupBy(*keys)
        .agg(
            F.max_by(F.when(settles, row), F.when(settles, F.col(batch))).alias("_settled"),
            F.min_by(F.when(~settles, row), F.when(~settles, F.col(batch))).alias("_insert"),
        )
    )
    settled, insert = F.col("_settled"), F.col("_insert")
    inserts = insert.isNotNull() & (settled.isNull() | (settled[op] == "D"))
    picked = by_key.select(*keys, F.when(inserts, insert).otherwise(settled).alias("_row"), (inserts & settled.isNotNull()).alias("_anew"))
    return picked.select(*keys, *[
        F.when(F.col("_anew"), F.lit("U")).otherwise(F.col(f"_row.{c}")).alias(c) if c == op else F.col(f"_row.{c}").alias(c)
        for c in rest
    ])
