"""Stream start and cancel commands turned into actions, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.parse import dead_letter, parse_json
from tidemill.operators.latest import newest_per_key
from tidemill.schemas import COMMAND


def control_actions(commands: DataFrame, active: DataFrame, command: str = "value", *order: str) -> DataFrame:
    """What to do per topic after its newest command: ``topic_name, stream_name, action, reason``.

    ``active`` lists the running streams in a column ``stream_name``. Invalid
    commands are left out, see :func:`control_rejects`.
    """
    known = _parsed(commands, command).where(F.col("_fault").isNull())
    newest = newest_per_key(known.select("topic_name", "operation", *order), ["topic_name"], list(order)).withColumn(
        "stream_name", _stream_name()
    )
    running = active.select("stream_name").distinct().withColumn("_active", F.lit(True))
    is_active = F.col("_active").isNotNull()
    starting = F.col("operation") == "start"
    return newest.join(running, "stream_name", "left").select(
        "topic_name",
        "stream_name",
        F.when(starting & ~is_active, "start").when(~starting & is_active, "cancel").otherwise("skip").alias("action"),
        F.when(starting & is_active, "already active").when(~starting & ~is_active, "not active").alias("reason"),
    )


def control_rejects(commands: DataFrame, command: str = "value") -> DataFrame:
    """Dead letters of commands with an unknown operation or a missing field."""
    return (
        _parsed(commands, command)
        .where(F.col("_fault").isNotNull())
        .select(dead_letter(F.col(command), F.col("_fault")).alias("dead_letter"))
    )


def _stream_name():
    return F.concat(F.lit("Stream-for-"), F.col("topic_name"))


def _parsed(commands: DataFrame, command: str) -> DataFrame:
    parsed = commands.withColumn("_c", parse_json(F.col(command), COMMAND)).select(
        *[c for c in commands.columns if c not in ("topic_name", "operation")],
        F.col("_c.topic_name").alias("topic_name"),
        F.lower("_c.operation").alias("operation"),
    )
    fault = (
        F.when(F.col("topic_name").isNull(), F.lit("missing field: topic_name"))
        .when(F.col("operation").isNull(), F.lit("missing field: operation"))
        .when(~F.col("operation").isin("start", "cancel"), F.concat(F.lit("unknown operation: "), F.col("operation")))
    )
    return parsed.withColumn("_fault", fault)
