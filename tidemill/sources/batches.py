"""Results and state of micro-batches, one folder per batch id."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class BatchFolder:
    """An ordinary parquet table in folders ``batch=N``; a batch that comes again replaces its own folder.

    ``folders`` are columns that make folders inside a batch, for filters that need not read the rest.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, folders: Sequence[str] = ()):
        self.spark, self.path, self.folders = spark, path.rstrip("/"), list(folders)
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        if "batch" in self.schema.names:
            raise ValueError("a column named batch would clash with the folders")

    def write(self, batch_id: int, df: DataFrame) -> None:
        writer = df.select(self.schema.names).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*self.folders).parquet(f"{self.path}/batch={batch_id}")

    def read(self, batch_id: int) -> DataFrame:
        """Rows of one batch; an error if it was never written."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch_id}")

    def previous(self, batch_id: int) -> DataFrame:
        """Rows of the batch before, none ahead of batch 0: Spark numbers the batches of a checkpoint without gaps."""
        return self.read(batch_id - 1) if batch_id > 0 else self.spark.createDataFrame([], self.schema)

    def rows(self) -> DataFrame:
        """Rows of all batches with their ``batch``; none if nothing was written yet."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def batches(self) -> list[int]:
        """Ids of the batches that were written, from the names of the folders."""
        found = (re.search(r"/batch=(\d+)/", path) for path in self.rows().inputFiles())
        return sorted({int(m[1]) for m in found if m})

    def of(self, batch_ids: Sequence[int]) -> DataFrame:
        """Rows of some batches; the folders of others are not even listed."""
        if not batch_ids:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/batch={b}" for b in batch_ids])

    def all(self) -> DataFrame:
        """Rows of all batches."""
        return self.rows().drop("batch")
