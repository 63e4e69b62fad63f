"""Activity sessions that end after an idle gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def idle_sessions(df: DataFrame, key: str, ts: str, gap: int) -> DataFrame:
    """Rows per session; a session ends once ``gap`` seconds pass without a row.

    Rows are first combined into (key, gap-wide bucket), where all of them are
    in one session by construction; only those few rows are ordered per key.
    """
    width = F.lit(gap * 1_000_000)
    micros = F.unix_micros(F.col(ts))
    cells = (
        df.where(F.col(ts).isNotNull())
        .groupBy(key, (micros - F.pmod(micros, width)).alias("_cell"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"))
    )
    by_time = Window.partitionBy(key).orderBy("_cell")
    idle = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(by_time))
    numbered = cells.withColumn("_new", (F.coalesce(idle, width) >= width).cast("int")).withColumn(
        "_session", F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            F.sum("_n").alias("count"),
        )
        .drop("_session")
    )
