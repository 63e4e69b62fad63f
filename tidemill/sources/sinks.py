"""Batch writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.timefn import calendar_parts


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    df.write.mode(mode).options(**options).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    df.write.mode(mode).options(**options).json(path)


def envelope_json(envelope: DataFrame) -> DataFrame:
    """Records as the JSON sink writes them: binary columns in base64."""
    return envelope.select(F.to_json(F.struct(*envelope.columns)).alias("value"))


def with_time_folders(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add the ``day, hour, minute`` folder columns."""
    return df.select("*", *calendar_parts(F.col(ts)))


def append_rejects(rejects: DataFrame, path: str) -> None:
    """Append dead letters; the frame has a ``dead_letter`` text column."""
    rejects.select(F.col("dead_letter").alias("value")).write.mode("append").text(path)
