"""Kafka-shaped records, from a Kafka connector or from envelope tables.

The connector is an optional jar; its readers are thin option dicts. Every
offset rule is also available on an envelope table, batch or stream.
"""

from __future__ import annotations

import functools
import json
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EARLIEST = -2
LATEST = -1

#: topic -> partition -> offset
Offsets = Mapping[str, Mapping[int, int]]


def offsets_text(offsets: Offsets) -> str:
    """JSON text of offsets; -2 is earliest, -1 latest, lower values are refused."""
    for topic, parts in offsets.items():
        for part, offset in parts.items():
            if offset < EARLIEST:
                raise ValueError(f"offset of {topic}/{part} is below {EARLIEST}: {offset}")
    return json.dumps(
        {t: {str(p): o for p, o in sorted(parts.items())} for t, parts in offsets.items()},
        separators=(",", ":"),
    )


def uniform_offsets(topic: str, partitions: int, offset: int) -> dict[str, dict[int, int]]:
    """The same offset for partitions ``0..partitions-1`` of a topic."""
    return {topic: dict.fromkeys(range(partitions), offset)}


def from_earliest(topic: str, partitions: int) -> str:
    return offsets_text(uniform_offsets(topic, partitions, EARLIEST))


def from_latest(topic: str, partitions: int) -> str:
    return offsets_text(uniform_offsets(topic, partitions, LATEST))


def kafka_options(
    servers: str,
    topics: Sequence[str] = (),
    *,
    assign: Mapping[str, Sequence[int]] | None = None,
    starting: str | Offsets | None = None,
    starting_timestamps: Offsets | None = None,
    ending: str | Offsets | None = None,
    min_partitions: int | None = None,
    include_headers: bool = False,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a Kafka scan; ``extra`` carries security and tuning options."""
    if bool(topics) == bool(assign):
        raise ValueError("give either topics or assign")
    options = {"kafka.bootstrap.servers": servers}
    if assign:
        options["assign"] = json.dumps(
            {t: sorted(p) for t, p in assign.items()}, separators=(",", ":")
        )
    else:
        options["subscribe"] = ",".join(topics)
    for name, value in (("startingOffsets", starting), ("endingOffsets", ending)):
        if value is not None:
            options[name] = value if isinstance(value, str) else offsets_text(value)
    if starting_timestamps is not None:
        options["startingOffsetsByTimestamp"] = json.dumps(
            {t: {str(p): ms for p, ms in sorted(parts.items())} for t, parts in starting_timestamps.items()},
            separators=(",", ":"),
        )
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if include_headers:
        options["includeHeaders"] = "true"
    return {**options, **(extra or {})}


def read_kafka(spark: SparkSession, **kwargs) -> DataFrame:
    """Bounded scan, earliest to latest unless told otherwise."""
    return spark.read.format("kafka").options(**kafka_options(**kwargs)).load()


def stream_kafka(spark: SparkSession, **kwargs) -> DataFrame:
    """Unbounded scan, from the latest offset unless told otherwise."""
    return spark.readStream.format("kafka").options(**kafka_options(**kwargs)).load()


def _per_partition(offsets: Offsets, test) -> Column:
    conditions = [
        (F.col("topic") == topic) & (F.col("partition") == part) & test(offset)
        for topic, parts in offsets.items()
        for part, offset in parts.items()
    ]
    return functools.reduce(operator.or_, conditions, F.lit(False))


def offset_range(envelope: DataFrame, starts: Offsets, ends: Offsets) -> DataFrame:
    """Records with ``start <= offset < end`` in each named partition.

    -2 as start and -1 as end leave that side open. The condition uses plain
    columns only, so it reaches the scan.
    """
    def start_test(offset: int) -> Column:
        return F.lit(True) if offset == EARLIEST else F.col("offset") >= offset

    def end_test(offset: int) -> Column:
        return F.lit(True) if offset == LATEST else F.col("offset") < offset

    return envelope.where(_per_partition(starts, start_test) & _per_partition(ends, end_test))


def assign_partitions(envelope: DataFrame, assign: Mapping[str, Sequence[int]]) -> DataFrame:
    """Only the named partitions."""
    conditions = [
        (F.col("topic") == topic) & F.col("partition").isin(list(parts)) for topic, parts in assign.items()
    ]
    return envelope.where(functools.reduce(operator.or_, conditions, F.lit(False)))


def starts_at_timestamps(envelope: DataFrame, timestamps: Mapping[str, Mapping[int, str]]) -> DataFrame:
    """First offset at or after a time, per partition: ``topic, partition, start_offset``.

    A partition without a given time starts at its earliest offset, one whose
    records are all older gets no row and is not read.
    """
    given = functools.reduce(
        operator.or_,
        [
            (F.col("topic") == topic) & (F.col("partition") == part)
            for topic, parts in timestamps.items()
            for part in parts
        ],
        F.lit(False),
    )
    reached = functools.reduce(
        operator.or_,
        [
            (F.col("topic") == topic)
            & (F.col("partition") == part)
            & (F.col("timestamp") >= F.lit(moment).cast("timestamp"))
            for topic, parts in timestamps.items()
            for part, moment in parts.items()
        ],
        F.lit(False),
    )
    return envelope.where(~given | reached).groupBy("topic", "partition").agg(F.min("offset").alias("start_offset"))


def from_starts(envelope: DataFrame, starts: DataFrame) -> DataFrame:
    """Records at or after the start offset of their partition.

    ``starts`` has one row per topic partition, which a Kafka cluster bounds to
    some hundred thousand, so it is broadcast: the few and large partitions
    would be hot join keys.
    """
    one_each = starts.groupBy("topic", "partition").agg(F.min("start_offset").alias("start_offset"))
    return (
        envelope.join(F.broadcast(one_each), ["topic", "partition"])
        .where(F.col("offset") >= F.col("start_offset"))
        .select(envelope.columns)
    )


def from_timestamps(envelope: DataFrame, timestamps: Mapping[str, Mapping[int, str]]) -> DataFrame:
    """Records from the first offset at or after a time, per partition."""
    return from_starts(envelope, starts_at_timestamps(envelope, timestamps))


def spread(envelope: DataFrame, tasks: int, run: int = 100_000) -> DataFrame:
    """Split large partitions over more tasks, in runs of neighbouring offsets."""
    return envelope.repartition(tasks, "topic", "partition", F.floor(F.col("offset") / run))


def partition_offsets(envelope: DataFrame) -> DataFrame:
    """Earliest offset and end (last + 1) per topic partition."""
    return envelope.groupBy("topic", "partition").agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("end")
    )


def offsets_json(envelope: DataFrame, which: str = "earliest") -> DataFrame:
    """One JSON text per topic: ``earliest`` gives -2, ``latest`` -1, ``end`` last + 1.

    The list per topic has one entry per partition of the topic.
    """
    value = {
        "earliest": F.lit(EARLIEST).cast("bigint"),
        "latest": F.lit(LATEST).cast("bigint"),
        "end": F.col("end"),
    }[which]
    per_topic = (
        partition_offsets(envelope)
        .groupBy("topic")
        .agg(F.array_sort(F.collect_list(F.struct("partition", value.alias("offset")))).alias("parts"))
    )
    by_partition = F.map_from_entries(
        F.transform("parts", lambda p: F.struct(p["partition"].cast("string"), p["offset"]))
    )
    return per_topic.select("topic", F.to_json(F.create_map(F.col("topic"), by_partition)).alias("offsets"))
