"""JDBC scans that are split over tasks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, sql: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Result of one SQL text, read by a single connection: for small results."""
    return spark.read.format("jdbc").options(url=url, query=sql, **(options or {})).load()


def first_row(spark: SparkSession, url: str, sql: str, order_by: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """First row of a query in a stated order."""
    return read_query(spark, url, sql, options).orderBy(order_by).limit(1)


def column_bounds(
    spark: SparkSession, url: str, source: str, column: str, options: Mapping[str, str] | None = None
) -> tuple[int, int]:
    """Smallest and largest value of a numeric column, asked from the database."""
    sql = f"SELECT MIN({column}) AS LO, MAX({column}) AS HI FROM {source}"
    low, high = read_query(spark, url, sql, options).first()
    if low is None:
        return 0, 1
    return int(low), int(high) + 1


def read_strides(
    spark: SparkSession,
    url: str,
    source: str,
    column: str,
    partitions: int,
    bounds: tuple[int, int] | None = None,
    fetch_size: int = 10_000,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table or ``(subquery) alias`` in equal strides of a numeric column.

    Bounds only set the strides: rows outside are read by the first and last
    task. Without bounds they are the column's own minimum and maximum.
    """
    low, high = bounds or column_bounds(spark, url, source, column, options)
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=source, **(options or {}))
        .option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .option("fetchsize", fetch_size)
        .load()
    )


def read_predicates(
    spark: SparkSession,
    url: str,
    source: str,
    predicates: Sequence[str],
    fetch_size: int = 10_000,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One task per predicate; rows that match none are not read."""
    return spark.read.jdbc(
        url, source, predicates=list(predicates), properties={"fetchsize": str(fetch_size), **(options or {})}
    )
