"""Newest row or value per key, per window, and maps of newest values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    The extreme row is found map-side first: one row per key and task is
    shuffled, so a hot key is no heavier than any other. The result stays
    partitioned by the keys. Give ``order`` a full tie-break; of equal rows the
    one with the greater other columns wins.
    """
    return _extreme_row(df, keys, order, F.max, F.max_by)


def oldest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key: first seen wins."""
    return _extreme_row(df, keys, order, F.min, F.min_by)


def _extreme_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], extreme, extreme_by) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = [c for c in order if c not in keys]
    if all(_orderable(df.schema[c].dataType) for c in rest):
        row = extreme(F.struct(*first, *rest))
    else:
        row = extreme_by(F.struct(*first, *rest), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def latest_value(value: str, *order: str) -> Column:
    """Aggregate: ``value`` of the row with the greatest order, NULL without rows."""
    return F.max_by(F.col(value), F.struct(*order))


def latest_first_seen(value: str, order: str, arrival: str) -> Column:
    """Aggregate: ``value`` of the greatest ``order``; of equal ones the first to arrive."""
    return F.max_by(F.col(value), F.struct(F.col(order), -F.col(arrival)))


def latest_per_window(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, order: Sequence[str],
    width: str, slide: str | None = None,
) -> DataFrame:
    """Latest value per key and event-time window, for tables and streams."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return (
        df.groupBy(*keys, window.alias("window"))
        .agg(latest_value(value, *order).alias(value))
        .select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), value)
    )


def merge_latest_map(previous: DataFrame, updates: DataFrame, key: str, value: str) -> DataFrame:
    """Map of newest values after an update: the new value wins, a new NULL does not."""
    return (
        updates.alias("u")
        .join(previous.alias("p"), F.col(f"u.{key}") == F.col(f"p.{key}"), "full_outer")
        .select(
            F.coalesce(F.col(f"u.{key}"), F.col(f"p.{key}")).alias(key),
            F.coalesce(F.col(f"u.{value}"), F.col(f"p.{value}")).alias(value),
        )
    )
