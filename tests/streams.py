"""Drive a stream from parquet files that are added one at a time."""

from __future__ import annotations

from pathlib import Path


class FileFeed:
    """A folder of parquet files in a fixed order, read as a stream."""

    def __init__(self, spark, folder: Path, schema: str):
        self.spark, self.folder, self.schema, self.count = spark, str(folder), schema, 0
        folder.mkdir(parents=True, exist_ok=True)

    def add(self, rows) -> None:
        """One more file with these rows (or the rows of a frame)."""
        frame = rows if hasattr(rows, "rdd") else self.spark.createDataFrame(rows, self.schema)
        frame.coalesce(1).write.mode("append").parquet(self.folder)
        self.count += 1

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.folder)


def run_all(df, tmp_path: Path, mode: str = "append", name: str = "out"):
    """All available files, one per batch; the rows each batch emitted, in batch order."""
    batches = {}

    def keep(batch, batch_id):
        batches[batch_id] = [tuple(r) for r in batch.collect()]

    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", str(tmp_path / f"cp-{name}"))
        .foreachBatch(keep)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [rows for _, rows in sorted(batches.items())]


class LiveRun:
    """A query with the default trigger: feed a file, wait until it and the empty batch after it are done."""

    def __init__(self, df, tmp_path: Path, mode: str, name: str = "live"):
        self.rows = []
        self.query = (
            df.writeStream.outputMode(mode)
            .option("checkpointLocation", str(tmp_path / f"cp-{name}"))
            .foreachBatch(lambda b, i: self.rows.extend(tuple(r) for r in b.collect()))
            .start()
        )

    def feed(self, source: FileFeed, rows) -> None:
        source.add(rows)
        self.query.processAllAvailable()
        self.query.processAllAvailable()

    def stop(self):
        self.query.stop()
        return self.rows
