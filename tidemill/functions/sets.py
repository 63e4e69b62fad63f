"""Small sets held in array columns.

Only for sets whose domain is bounded (event types, flags). User sets stay in
rows, see :mod:`tidemill.operators.distinct`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_empty(array: Column) -> Column:
    """NULL as the empty set."""
    return F.coalesce(array, F.array().cast("array<string>"))


def union_sets(left: Column, right: Column) -> Column:
    """Union of two text sets, NULL counting as empty."""
    return F.array_union(or_empty(left), or_empty(right))
