"""Row counts per key and activity session, emitted when the key has fallen silent, by event time or by the clock."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def idle_counts(df: DataFrame, key: str, ts: str, idle: str = "10 seconds", delay: str = "10 seconds") -> DataFrame:
    """``key, session_start, session_end, count`` of each session, ended by ``idle`` of event time without a row.

    Append mode: a session leaves, and its state with it, once the watermark has passed its last row by ``idle``.
    ``session_end`` is the time of that last row.
    """
    session = F.session_window(ts, idle).alias("session")
    counted = df.withWatermark(ts, delay).groupBy(session, key).agg(F.count(F.lit(1)).alias("count"), F.max(ts).alias("session_end"))
    return counted.select(key, F.col("session.start").alias("session_start"), "session_end", "count")


#: Groups of keys, each with one state and one timer.
GROUPS = 512


def _plain(key):
    """A key as a value that is equal where Spark's grouping is."""
    return (float("nan") if key != key else key + 0.0) if isinstance(key, float) else key


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key and Arrow batch, so that a hot key sends few rows through the shuffle."""
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by("key").aggregate([([], "count_all")])
        keys = [pickle.dumps(_plain(k), 4) for k in counts.column("key").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([zlib.crc32(k) % GROUPS for k in keys], pa.int32()), pa.array(keys, pa.binary()), pa.array(counts.column("count_all").to_pylist(), pa.int64())],
            names=["group", "key", "count"],
        )


class _Silence(StatefulProcessor):
    """State per group of keys: of each key its rows so far and when it counts as silent; one timer, for the first of them.

    A call of the state store or of a timer goes through a socket, so there are a few per group and batch, not per key.
    """

    def __init__(self, idle_millis: int, out: str):
        self.idle_millis, self.out = idle_millis, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getValueState("held", "keys binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, timer = pickle.loads(bytes(self._held.get()[0])) if self._held.exists() else ({}, None)
        due = timerValues.getCurrentProcessingTimeInMs() + self.idle_millis
        for part in rows:
            for name, n in zip(part["key"], part["count"].tolist()):
                name = bytes(name)
                held[name] = held[name][0] + n if name in held else n, due
        self._keep(held, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._held.exists():
            return
        held, timer = pickle.loads(bytes(self._held.get()[0]))
        now = timerValues.getCurrentProcessingTimeInMs()
        silent = [(pickle.loads(name), n) for name, (n, due) in held.items() if due <= now]
        left = {name: kept for name, kept in held.items() if kept[1] > now}
        if left:
            self._keep(left, timer if timer > now else None)
        else:
            self._held.clear()
        if silent:
            keys, counts = zip(*silent)
            yield pd.DataFrame({self.out: pd.Series(keys, dtype=object), "count": counts})

    def _keep(self, held: dict, timer: int | None) -> None:
        """Store the keys; a timer that is later than the first of them is replaced."""
        first = min(due for _, due in held.values())
        if timer is None or first < timer:
            if timer is not None:
                self._handle.deleteTimer(timer)
            self._handle.registerTimer(first)
            timer = first
        self._held.update((pickle.dumps((held, timer)),))

    def close(self) -> None:
        pass


def silence_counts(df: DataFrame, key: str, idle_seconds: float) -> DataFrame:
    """``key, count`` once a key has had no row for ``idle_seconds`` of processing time; its state ends with it. Append mode.

    Each batch with rows of a key moves the key's time. Timers fire in the batches of a processing-time trigger, with
    or without new rows; with ``availableNow`` such a query does not end (see :func:`tidemill.streaming.sinks.run_until_quiet`).
    Rows are counted before the shuffle. Keys are dealt into ``GROUPS`` groups by a hash; a task holds the keys of one
    group at a time, and a batch writes the state of the groups it has rows of. Needs the RocksDB state store.
    """
    kind = df.schema[key].dataType
    counted = df.select(F.col(key).alias("key")).mapInArrow(
        _counted, T.StructType().add("group", T.IntegerType()).add("key", T.BinaryType()).add("count", T.LongType())
    )
    out = T.StructType().add(key, kind).add("count", T.LongType())
    return counted.groupBy("group").transformWithStateInPandas(_Silence(round(idle_seconds * 1000), key), out, "Append", "ProcessingTime")
