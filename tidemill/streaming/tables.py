"""Streams that keep their state in tables, one folder per micro-batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.parse import cdc_records, cdc_rows
from tidemill.functions.predicates import Segment
from tidemill.operators import distinct
from tidemill.operators.cluster import time_ranges
from tidemill.operators.latest import newest_per_key
from tidemill.sources.batches import BatchFolder
from tidemill.sources.changelog import ChangeLog


@dataclass(frozen=True)
class CdcTarget:
    """Where the changes of one namespace go, and how its key and value texts read."""

    table: ChangeLog
    key_schema: T.StructType
    value_schema: T.StructType


class CdcMerge:
    """Logs the changes of a feed to tables; reading a table merges them."""

    def __init__(self, targets: Mapping[str, CdcTarget]):
        self.targets = dict(targets)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Log one micro-batch of envelope records; a repeat replaces its own changes."""
        records = cdc_records(batch)
        shared = len(self.targets) > 1  # one target reads them once
        if shared:
            records.persist()
        try:
            for namespace, target in self.targets.items():
                rows = cdc_rows(records, namespace, target.key_schema, target.value_schema)
                target.table.append(rows, ["timestamp", "partition", "offset"], batch_id)
        finally:
            if shared:
                records.unpersist()


class DistinctCounts:
    """Counts distinct users per segment and window over micro-batches.

    State are the user rows of the open windows. ``counts`` holds what each batch
    knows of its windows, open ones included; closed windows leave as metric
    points; rows that come later for a closed window are dropped.
    """

    _COUNTS = "user_type string, window_s int, start_time timestamp, distinct_users bigint"
    _METRICS = "metric string, ts timestamp, value double, tags string"

    def __init__(
        self, spark: SparkSession, path: str, segments: Sequence[Segment], widths: Sequence[int], ts: str, user: str,
        prefix: str = "events",
    ):
        self.segments, self.widths, self.ts, self.user, self.prefix = segments, widths, ts, user, prefix
        self.state = BatchFolder(spark, f"{path}/state", distinct.USER_ROWS)
        self.counts = BatchFolder(spark, f"{path}/counts", self._COUNTS)
        self.metrics = BatchFolder(spark, f"{path}/metrics", self._METRICS)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        kept = self.state.previous(batch_id)
        new = distinct.user_bits(batch, self.segments, self.widths, self.ts, self.user)
        users = distinct.merge_users(new, distinct.kept_bits(kept, self.segments), self.segments)
        # Kept rows are of the latest windows, so only new ones can be behind.
        merged = distinct.drop_behind(users, distinct.latest_windows(kept)).persist()
        try:
            self.counts.write(batch_id, distinct.count_users(merged))
            counts = self.counts.read(batch_id)
            latest = distinct.latest_windows(counts)
            self.metrics.write(batch_id, distinct.metric_points(distinct.closed(counts, latest), self.prefix))
            kept_users = distinct.still_open(merged, latest).select(*distinct.WINDOW, "user_id")
            self.state.write(batch_id, kept_users)
        finally:
            merged.unpersist()


class LatestMap:
    """Latest value per key over micro-batches; each batch adds the newest values it brought."""

    def __init__(self, spark: SparkSession, path: str, fields: T.StructType, key: str, value: str, order: Sequence[str]):
        self.key, self.value, self.order = key, value, list(order)
        self.updates = BatchFolder(spark, path, fields)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Write a micro-batch's newest value per key; a repeated batch replaces its own."""
        rows = batch.select(self.key, self.value, *self.order)
        self.updates.write(batch_id, newest_per_key(rows, [self.key], self.order).select(self.key, self.value))

    def read(self, last: int | None = None) -> DataFrame:
        """The map after batch ``last``, all batches by default: a later value wins, but NULL only if there is no other."""
        rows = self.updates.rows()
        if last is not None:
            rows = rows.where(F.col("batch") <= last)
        known = F.when(F.col(self.value).isNotNull(), F.col("batch"))
        return rows.groupBy(self.key).agg(F.max_by(self.value, known).alias(self.value))


class SavedMap:
    """Latest known value per key over micro-batches, with all of the map saved every ``every`` batches.

    The value of the greatest ``order`` wins, but a NULL only if there is no other, whatever batch brings it. A read opens
    the last saved map and the updates after it. The map of the batches before ``N`` is saved ahead of the updates of
    batch ``N`` and used once these are there, so a run that breaks off leaves no half map behind, and a repeated batch
    replaces its own updates only.
    """

    def __init__(
        self, spark: SparkSession, path: str, fields: T.StructType, key: str, value: str, order: Sequence[str], every: int = 10
    ):
        self.spark, self.key, self.value, self.order, self.every = spark, key, value, list(order), every
        self.updates, self.saved = BatchFolder(spark, f"{path}/updates", fields), BatchFolder(spark, f"{path}/saved", fields)

    def _newest(self, rows: DataFrame) -> DataFrame:
        known = rows.select(*self.updates.schema.names).withColumn("_known", F.col(self.value).isNotNull())
        return newest_per_key(known, [self.key], ["_known", *self.order]).drop("_known")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        written = self.updates.batches()
        if batch_id and batch_id % self.every == 0 and batch_id not in written:
            self.saved.write(batch_id - 1, self._newest(self.parts(batch_id - 1)))
        self.updates.write(batch_id, self._newest(batch))

    def parts(self, last: int | None = None) -> DataFrame:
        """The rows that a read after batch ``last`` merges: a saved map and the updates since."""
        written = [b for b in self.updates.batches() if last is None or b <= last]
        whole = set(self.updates.batches())
        saved = [b for b in self.saved.batches() if b + 1 in whole and (last is None or b <= last)]
        begin = saved[-1] if saved else -1
        rows = self.updates.of([b for b in written if b > begin])
        return rows.unionByName(self.saved.of([begin])) if saved else rows

    def read(self, last: int | None = None) -> DataFrame:
        """The map after batch ``last``, all batches by default."""
        return self._newest(self.parts(last)).select(self.key, self.value)


class SketchTable:
    """Distinct-count and quantile sketches per group, window and micro-batch; any range of windows rolls up from them.

    A batch writes one row of bytes per group and window it touches, so tables stay small however many rows pass, and late
    rows only add another sketch to their window.
    """

    def __init__(self, spark: SparkSession, path: str, group: str, ts: str, counted: str, measured: str, width: str):
        self.group, self.ts, self.counted, self.measured, self.width = group, ts, counted, measured, width
        fields = T.StructType([
            T.StructField(group, T.StringType()), T.StructField("window_start", T.TimestampType()), T.StructField("n", T.LongType()),
            T.StructField("theta", T.BinaryType()), T.StructField("kll", T.BinaryType()),
        ])
        self.sketches = BatchFolder(spark, path, fields)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        start = F.window(self.ts, self.width)["start"].alias("window_start")
        rows = batch.groupBy(F.col(self.group).cast("string").alias(self.group), start).agg(
            F.count(F.lit(1)).alias("n"), F.theta_sketch_agg(self.counted).alias("theta"),
            F.kll_sketch_agg_double(F.col(self.measured).cast("double")).alias("kll"),
        )
        self.sketches.write(batch_id, rows)

    def roll_up(self, begin: str, end: str, ranks: Sequence[float]) -> DataFrame:
        """Rows, distinct values and quantiles per group of the windows that start in ``[begin, end)``."""
        start = F.col("window_start")
        inside = self.sketches.rows().where((start >= F.lit(begin).cast("timestamp")) & (start < F.lit(end).cast("timestamp")))
        merged = inside.groupBy(self.group).agg(
            F.sum("n").alias("n"), F.theta_union_agg("theta").alias("theta"), F.kll_merge_agg_double("kll").alias("kll")
        )
        return merged.select(
            self.group, "n", F.theta_sketch_estimate("theta").alias("distinct_values"),
            F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(float(r))) for r in ranks]).alias("quantiles"),
        )


class TimeClusters:
    """Time ranges of k clusters in each micro-batch."""

    def __init__(self, spark: SparkSession, path: str, ts: str, k: int = 3):
        self.ts, self.k = ts, k
        self.ranges = BatchFolder(spark, path, "left_bound timestamp, right_bound timestamp, n bigint")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Cluster one batch; an empty batch leaves nothing."""
        batch.persist()
        try:
            if not batch.isEmpty():
                self.ranges.write(batch_id, time_ranges(batch, self.ts, self.k))
        finally:
            batch.unpersist()


def live_changes(records: DataFrame, key_schema: T.StructType, value_schema: T.StructType) -> DataFrame:
    """Change records of a single-table feed without deletes, flattened, for clustering."""
    parsed = cdc_records(records).where(F.col("oc") != "D")
    return parsed.select(
        F.from_json("pk", key_schema).alias("pk"), F.from_json("va", value_schema).alias("va")
    ).select("pk.*", "va.*")
