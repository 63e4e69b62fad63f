"""Parquet tables and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import use_utc


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table as stored; timestamps without zone stay as they are."""
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def zoned(df: DataFrame) -> DataFrame:
    """Timestamps without zone as UTC instants, which event-time operators need."""
    return df.select([
        F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in df.schema.fields
    ])


def zoneless(df: DataFrame) -> DataFrame:
    """Inverse of :func:`zoned`, for results that leave Spark."""
    return df.select([
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table with zoned timestamps."""
    return zoned(raw_table(spark, folder, name))


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream of its files; a table may be one file or a folder of files."""
    schema = raw_table(spark, folder, name).schema
    return zoned(spark.readStream.schema(schema).parquet(f"{folder}/{name}.parquet*"))


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def save_as_table(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> None:
    """Parquet table of the catalog, managed unless ``path`` is given; fails if it exists unless ``mode`` says otherwise."""
    writer = df.write.mode(mode).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
