"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.plans import feeds, relational, roundtrips, streamed, timed

_ALL = {**feeds.QUERIES, **relational.QUERIES, **timed.QUERIES, **streamed.QUERIES, **roundtrips.QUERIES}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to builder of its DataFrame from a table folder."""
    return {name: build for name, (build, _) in _ALL.items()}


def comparison_sql() -> dict[str, str]:
    """SQL with the same result, for the queries that have one."""
    return {name: sql for name, (_, sql) in _ALL.items() if sql is not None}
