"""Stream writers, triggers and the end of a run."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemill.operators.progress import progress_table
from tidemill.sources.batches import BatchFolder
from tidemill.sources.sinks import with_time_folders


def triggered(writer: DataStreamWriter, every: str | None = None) -> DataStreamWriter:
    """A batch per interval such as ``"5 seconds"``; without one, all available data and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_console(
    df: DataFrame, name: str, checkpoint: str, mode: str = "append", every: str | None = None, rows: int = 100
) -> StreamingQuery:
    """Untruncated rows on the driver's console, for looking at a stream."""
    writer = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    return triggered(writer.format("console").option("numRows", rows).option("truncate", False), every).start()


def to_json_folders(
    df: DataFrame, path: str, checkpoint: str, ts: str = "timestamp", every: str | None = None,
    folders: Sequence[str] = ("day", "hour", "minute"), name: str | None = None,
) -> StreamingQuery:
    """Append JSON files in folders of the record's own time; the sink's log makes each row appear once.

    At scale give ``("day", "hour")``: a folder per minute and task makes many small files.
    """
    placed = with_time_folders(df, ts)
    placed = placed.drop(*[c for c in ("day", "hour", "minute") if c not in folders])
    writer = placed.writeStream.format("json").partitionBy(*folders).option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, every).start()


def to_json(df: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None) -> StreamingQuery:
    """Append records as JSON lines; binary columns come out in base64."""
    writer = df.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, every).start()


def per_topic(
    envelope_of: Callable[[str], DataFrame], topics: Sequence[str], base: str, every: str | None = None
) -> list[StreamingQuery]:
    """One query per topic, each with its own output and checkpoint."""
    return [
        to_json(envelope_of(t), f"{base}/{t}", f"{base}/_checkpoints/{t}", every, f"ingest-{t}") for t in topics
    ]


def by_topic(df: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None) -> StreamingQuery:
    """All topics by one query, read once: JSON files in a folder per ``topic``; a topic that appears later gets its own.

    Records without topic go to Spark's folder for nulls.
    """
    writer = df.writeStream.format("json").partitionBy("topic").option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, every).start()


def each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "append", every: str | None = None, name: str | None = None,
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch; a batch may come again after a failure."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, every).start()


def with_dead_letters(
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    handle: Callable[[DataFrame, int], None],
    reject_path: str,
) -> Callable[[DataFrame, int], None]:
    """Batch handler that passes good rows on and keeps rejected ones as text, one folder per batch id."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good, bad = split(batch)
            bad.select(F.col("dead_letter").alias("value")).write.mode("overwrite").text(f"{reject_path}/batch={batch_id}")
            handle(good, batch_id)
        finally:
            batch.unpersist()
    return run


def with_row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Count the rows of each micro-batch on the way; read it from the progress' ``observedMetrics``."""
    return df.observe(name, F.count(F.lit(1)).alias("count"))


def stop_after(query: StreamingQuery, batches: int, timeout: float) -> None:
    """Stop a query once it has finished that many batches; an error if it hasn't within ``timeout`` seconds."""
    waited, step = 0.0, 0.2
    try:
        while not query.awaitTermination(step):
            last = query.lastProgress
            if last is not None and last["batchId"] >= batches - 1:
                return
            waited += step
            if waited >= timeout:
                raise TimeoutError(f"the query has not finished {batches} batches within {timeout} s")
    finally:
        query.stop()


class _Batches(StreamingQueryListener):
    """Tells when a query has finished so many batches with rows."""

    def __init__(self, batches: int):
        self.left, self.reached, self.query_id = batches, threading.Event(), None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.id == self.query_id and event.progress.numInputRows:
            self.left -= 1
            if self.left <= 0:
                self.reached.set()

    def onQueryTerminated(self, event) -> None:
        if event.id == self.query_id:
            self.reached.set()


def run_batches(writer: DataStreamWriter, batches: int, timeout: float) -> None:
    """Run a query until it has finished so many batches with rows, then end it; its checkpoint lets the next run go on.

    A batch that has begun by then is broken off and comes again. The source bounds a batch (``maxFilesPerTrigger``,
    ``maxOffsetsPerTrigger``). An error of the query is raised, as is a ``TimeoutError``.
    """
    spark = writer._spark
    listener = _Batches(batches)
    spark.streams.addListener(listener)
    query = None
    try:
        query = writer.trigger(processingTime="0 seconds").start()
        listener.query_id = query.id
        deadline = time.monotonic() + timeout
        while not listener.reached.wait(0.2):
            # Batches that ended before the id was known are in the records.
            if sum(1 for p in query.recentProgress if p["numInputRows"]) >= batches or not query.isActive:
                break
            if time.monotonic() > deadline:
                raise TimeoutError(f"the query has not finished {batches} batches within {timeout} s")
        if query.exception() is not None:
            raise query.exception()
    finally:
        if query is not None:
            query.stop()
        spark.streams.removeListener(listener)


def _millis(progress) -> int:
    return round(datetime.fromisoformat(_as_dict(progress)["timestamp"]).timestamp() * 1000)


def run_until_quiet(writer: DataStreamWriter, quiet_seconds: float, timeout: float, every: str = "1 second") -> None:
    """Run a query, a batch ``every`` so long, until one begins without rows over ``quiet_seconds`` after the last with rows.

    By then all timers of at most that long have fired. For queries that make batches without new rows, as those with
    processing-time timers do; its checkpoint lets the next run go on. Errors and timeouts as in :func:`run_batches`.
    """
    query = writer.trigger(processingTime=every).start()
    try:
        deadline, last, done = time.monotonic() + timeout, None, -1
        while True:
            for progress in map(_as_dict, query.recentProgress):
                if progress["batchId"] <= done:
                    continue
                done, begun = progress["batchId"], _millis(progress)
                if last is None or progress["numInputRows"]:
                    last = begun
                elif begun > last + quiet_seconds * 1000:
                    return
            if not query.isActive:
                if query.exception() is not None:
                    raise query.exception()
                return
            if time.monotonic() > deadline:
                raise TimeoutError(f"the query has not been quiet for {quiet_seconds} s within {timeout} s")
            time.sleep(0.2)
    finally:
        query.stop()


def _as_dict(progress) -> Mapping:
    return progress if isinstance(progress, Mapping) else json.loads(progress.json)


def progress_of(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The progress records Spark keeps of a query (a hundred at most) as offsets per topic partition; for all see :class:`ProgressLog`."""
    texts = [(json.dumps(_as_dict(p)),) for p in query.recentProgress]
    return progress_table(spark.createDataFrame(texts, "value string"))


class ProgressLog(StreamingQueryListener):
    """Writes the progress record of every batch of every query to folders ``<query id>/batch=N``.

    Register it with ``spark.streams.addListener``. Records arrive a moment after their batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _of(self, query_id) -> BatchFolder:
        return BatchFolder(self.spark, f"{self.path}/{query_id}", "value string")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        record = self.spark.createDataFrame([(progress.json,)], "value string").coalesce(1)
        self._of(progress.id).write(progress.batchId, record)

    def onQueryTerminated(self, event) -> None:
        pass

    def wait_for(self, query_id, batch_id: int, timeout: float) -> None:
        """Until the record of a batch is there; a ``TimeoutError`` if it does not come."""
        deadline = time.monotonic() + timeout
        while batch_id not in self._of(query_id).batches():
            if time.monotonic() > deadline:
                raise TimeoutError(f"no progress record of batch {batch_id} within {timeout} s")
            time.sleep(0.1)

    def texts(self, query_id) -> DataFrame:
        """``value``: the records of one query, over all its runs."""
        return self._of(query_id).all()

    def offsets(self, query_id) -> DataFrame:
        """The records of one query as offsets per topic partition."""
        return progress_table(self.texts(query_id))
