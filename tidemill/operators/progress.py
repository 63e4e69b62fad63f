"""Stream progress records as a table of offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PROGRESS = """
    name string, batchId bigint, numInputRows bigint, durationMs map<string, bigint>,
    sources array<struct<
        description string, startOffset string, endOffset string, numInputRows bigint,
        inputRowsPerSecond double, processedRowsPerSecond double>>
"""
_OFFSETS = "map<string, map<string, bigint>>"


def progress_table(df: DataFrame, text: str = "value") -> DataFrame:
    """Progress JSON (offsets as JSON texts inside) to one row per topic partition.

    Batches without input are left out. ``start_offset`` is NULL in the first batch.
    """
    record = F.from_json(F.col(text), _PROGRESS)
    sources = (
        df.select(record.alias("p"))
        .where(F.col("p.numInputRows") > 0)
        .select(
            F.col("p.name").alias("query"),
            F.col("p.batchId").alias("batch_id"),
            F.col("p.numInputRows").alias("batch_rows"),
            F.element_at("p.durationMs", "latestOffset").alias("latest_offset_ms"),
            F.explode("p.sources").alias("s"),
        )
        .select(
            "query", "batch_id", "batch_rows", "latest_offset_ms",
            F.col("s.inputRowsPerSecond").alias("input_rate"),
            F.col("s.processedRowsPerSecond").alias("processed_rate"),
            F.from_json("s.startOffset", _OFFSETS).alias("starts"),
            F.from_json("s.endOffset", _OFFSETS).alias("ends"),
        )
    )
    fixed = [c for c in sources.columns if c != "ends"]
    per_topic = sources.select(*fixed, F.explode("ends").alias("topic", "topic_ends"))
    per_part = per_topic.select(
        *fixed, "topic", F.explode("topic_ends").alias("partition", "end_offset")
    )
    start = F.try_element_at(F.try_element_at("starts", F.col("topic")), F.col("partition"))
    return per_part.select(
        "query", "batch_id", "topic",
        F.col("partition").cast("int").alias("partition"),
        start.alias("start_offset"), "end_offset",
        "batch_rows", "latest_offset_ms", "input_rate", "processed_rate",
    )
