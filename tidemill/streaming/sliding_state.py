"""Sliding sum per event with state kept across micro-batches.

Two forms. :func:`sliding_sum_stream` keeps the buckets of a key in Spark's state
store. :class:`SlidingSumTable` keeps what each batch added to the buckets as rows of
a table and runs the table operator, which also splits a key that fills most of a
batch over many tasks. Without a delay they give the same sums; with one, a row out of
order may see buckets in the table that the state store has dropped.

For a batch sorted by time the sum after event i is the sum of all buckets, kept
or from this batch up to i, whose start lies in ``(bucket(t_i - window), bucket(t_i)]``.
The lower end only grows within a batch, so prefix sums give every event's value at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemill.functions.timefn import bucket_seconds
from tidemill.operators.sliding import check_widths, sliding_running_sum
from tidemill.operators.skew import HOT_ROWS
from tidemill.sources.batches import BatchFolder

_MICROS = 1_000_000
OUTPUT = "id string, timestamp timestamp, running_sum bigint"


def _prefix(values: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(values)))


def sums_after(
    starts: np.ndarray, sums: np.ndarray, micros: np.ndarray, values: np.ndarray, window: int, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Running sums of time-sorted events, and the buckets kept afterwards (sorted starts, sums).

    ``starts`` are sorted epoch seconds; all sums are whole numbers.
    """
    seconds = micros // _MICROS
    own = seconds // width * width
    floor = (seconds - window) // width * width
    kept = _prefix(sums)
    seen = _prefix(values)
    from_kept = kept[np.searchsorted(starts, own, "right")] - kept[np.searchsorted(starts, floor, "right")]
    from_batch = seen[1:] - seen[np.searchsorted(own, floor, "right")]
    all_starts, slot = np.unique(np.concatenate((starts, own)), return_inverse=True)
    all_sums = np.zeros(len(all_starts), dtype=np.int64)
    np.add.at(all_sums, slot, np.concatenate((sums, values)))
    alive = all_starts > floor[-1]
    return from_kept + from_batch, all_starts[alive], all_sums[alive]


class _SlidingSum(StatefulProcessor):
    """State per key: bucket starts and sums, at most window / width + 1 of them when events come in order.

    One timer per key ends the state: any event later than the last one by the
    window would drop all buckets anyway. It is set once and, when it fires
    after newer events came, set again, so a busy key does not renew it per batch.
    """

    def __init__(self, window: int, width: int):
        self.window, self.width = window, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("buckets", "starts array<bigint>, sums array<bigint>, last_s bigint")

    def _load(self) -> tuple[np.ndarray, np.ndarray, int | None]:
        starts, sums, last = self._state.get() if self._state.exists() else ([], [], None)
        return np.asarray(starts, dtype=np.int64), np.asarray(sums, dtype=np.int64), last

    def _end_millis(self, last: int) -> int:
        return (last + 1 + self.window) * 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows), ignore_index=True).sort_values(["micros", "tie"], kind="stable")
        if not len(events):
            return
        starts, sums, last = self._load()
        micros = events["micros"].to_numpy(np.int64)
        running, starts, sums = sums_after(
            starts, sums, micros, events["value"].to_numpy(np.int64), self.window, self.width
        )
        newest = int(micros[-1] // _MICROS)
        if last is None:
            self._handle.registerTimer(self._end_millis(newest))
        else:
            newest = max(newest, last)
        self._state.update((starts.tolist(), sums.tolist(), newest))
        yield pd.DataFrame({
            "id": key[0], "timestamp": pd.to_datetime(micros, unit="us"), "running_sum": running
        })

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        first = initialState.sort_values("bucket_s")
        starts = first["bucket_s"].to_numpy(np.int64)
        last = int(starts[-1]) + self.width
        self._state.update((starts.tolist(), first["bucket_sum"].to_numpy(np.int64).tolist(), last))
        self._handle.registerTimer(self._end_millis(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = self._end_millis(self._load()[2])
        if end > expiredTimerInfo.getExpiryTimeInMs():
            self._handle.registerTimer(end)
        else:
            self._state.clear()
        return iter(())

    def close(self) -> None:
        pass


def sliding_sum_stream(
    events: DataFrame, window: int, width: int, initial: DataFrame | None = None, delay: str = "0 seconds",
    tie_break: str | None = None,
) -> DataFrame:
    """``id, timestamp, running_sum`` for every event of ``id, timestamp, value``; update mode.

    ``initial`` holds the first state as ``id, bucket_start, bucket_sum`` rows.
    Rows behind the watermark are dropped. Needs the RocksDB state store. The
    rows of one key in one micro-batch are sorted in memory; bound the batch
    with the source's rate options.
    """
    check_widths(window, width)
    keyed = events.withWatermark("timestamp", delay).select(
        "id", "timestamp", F.unix_micros("timestamp").alias("micros"),
        F.col("value").cast("bigint").alias("value"),
        (F.col(tie_break) if tie_break else F.lit(0)).cast("bigint").alias("tie"),
    )
    start = None
    if initial is not None:
        start = initial.select("id", F.unix_timestamp("bucket_start").alias("bucket_s"), "bucket_sum").groupBy("id")
    return keyed.groupBy("id").transformWithStateInPandas(
        _SlidingSum(window, width), OUTPUT, "Update", "EventTime", initialState=start
    )


class SlidingSumTable:
    """``foreachBatch`` form: each batch writes what it adds to the buckets, in folders of the bucket's day.

    A batch reads the days its windows reach and no others, so neither idle keys nor old days cost anything. As in the
    stream, rows not newer than the newest one of the batches before, less ``delay`` seconds, are dropped, and so
    are rows without a time.
    """

    _STATE = "id string, bucket_s bigint, bucket_sum bigint, bucket_day bigint"
    _DAY = 86_400

    def __init__(self, spark: SparkSession, path: str, window: int, width: int, hot_rows: int = HOT_ROWS, delay: int = 0):
        check_widths(window, width)
        self.window, self.width, self.hot_rows, self.delay = window, width, hot_rows, delay
        self.state = BatchFolder(spark, f"{path}/state", self._STATE, ["bucket_day"])
        self.newest = BatchFolder(spark, f"{path}/newest", "micros bigint")
        self.output = BatchFolder(spark, f"{path}/output", OUTPUT)

    def bootstrap(self, initial: DataFrame) -> None:
        """Start from ``id, bucket_start, bucket_sum`` rows."""
        self._add(-1, initial.select("id", F.unix_timestamp("bucket_start").alias("bucket_s"), "bucket_sum"))

    def _add(self, batch_id: int, sums: DataFrame) -> None:
        self.state.write(batch_id, sums.withColumn("bucket_day", F.floor(F.col("bucket_s") / self._DAY)))

    def buckets(self, batch_id: int, first: int, last: int) -> DataFrame:
        """``id, bucket_s, bucket_sum`` of the buckets from ``first`` to ``last`` as batch ``batch_id`` finds them."""
        added = self.state.rows().where(
            (F.col("batch") < batch_id) & F.col("bucket_day").between(first // self._DAY, last // self._DAY)
            & F.col("bucket_s").between(first, last)
        )
        return added.groupBy("id", "bucket_s").agg(F.sum("bucket_sum").alias("bucket_sum"))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Handle one micro-batch of ``id, timestamp, value, tie``; a repeated batch overwrites its own output."""
        micros = F.unix_micros("timestamp")
        mark = self.newest.previous(batch_id)
        before = mark.agg(F.max("micros")).first()[0]
        on_time = batch.where(F.col("timestamp").isNotNull())
        if before is not None:
            on_time = on_time.where(micros > before // 1000 * 1000 - self.delay * _MICROS)
        now = on_time.select("id", "timestamp", F.col("value").cast("bigint").alias("value"),
                             F.col("tie").cast("bigint").alias("tie"), F.lit(False).alias("past")).persist()
        try:
            low, high = now.agg(F.min(micros), F.max(micros)).first()
            first, last = 0, -1  # an empty batch reaches no bucket
            if low is not None:
                first = (low // _MICROS - self.window) // self.width * self.width + self.width
                last = high // _MICROS // self.width * self.width
            # A kept bucket acts as an event at its start, ahead of all others there.
            past = self.buckets(batch_id, first, last).select(
                "id", F.timestamp_seconds("bucket_s").alias("timestamp"),
                F.col("bucket_sum").alias("value"), F.lit(None).cast("bigint").alias("tie"), F.lit(True).alias("past"),
            )
            touched = past.join(now.select("id").distinct(), "id", "left_semi")
            summed = sliding_running_sum(
                touched.unionByName(now), "id", "timestamp", "value", ["tie"], self.window, self.width,
                hot_rows=self.hot_rows,
            )
            self.output.write(batch_id, summed.where(~F.col("past")).select("id", "timestamp", "running_sum"))
            own = now.groupBy("id", bucket_seconds(F.col("timestamp"), self.width).alias("bucket_s"))
            self._add(batch_id, own.agg(F.sum("value").alias("bucket_sum")))
            newest = now.select(micros.alias("micros")).unionByName(mark)
            self.newest.write(batch_id, newest.agg(F.max("micros").alias("micros")))
        finally:
            now.unpersist()
