"""A table in buckets by its key, with a log of changes that is folded into the next base.

The base lies in catalog tables with ``bucketBy`` on the key. A merge shuffles the
changes to the buckets and leaves the base where it is, and a fold writes the
merged rows bucket by bucket without a shuffle of its own.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.changes import effective_changes, merge_changes
from tidemill.sources.changelog import ChangeLog


class BucketedTable:
    """Bases ``<name>_v0``, ``<name>_v1``, ... in the catalog and one :class:`ChangeLog` of all changes at ``path``.

    Base ``_vN`` holds the changes of the batches before ``N``. A base is there for readers once its write has finished;
    an older one stays until someone drops it, so a reader that has begun is not disturbed. Choose ``buckets`` so that one
    is a task's work at the size the table will reach: it cannot change later.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, keys: Sequence[str], buckets: int, op: str = "oc"):
        self.spark, self.name, self.path = spark, name, path
        self.keys, self.buckets, self.op = list(keys), buckets, op

    def create(self, rows: DataFrame) -> None:
        """The first base; shuffles the rows once, so that each bucket is one file."""
        self._save(rows.repartition(self.buckets, *self.keys), 0)

    def _save(self, rows: DataFrame, version: int) -> None:
        writer = rows.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.saveAsTable(f"{self.name}_v{version}")

    def versions(self) -> list[int]:
        """Batches at which a base begins."""
        database, _, plain = self.name.rpartition(".")
        shown = self.spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{plain}_v*'").collect()  # a row per base
        found = [re.fullmatch(re.escape(plain.lower()) + r"_v(\d+)", row["tableName"]) for row in shown]
        return sorted(int(m[1]) for m in found if m)

    def base(self, version: int) -> DataFrame:
        return self.spark.table(f"{self.name}_v{version}")

    @property
    def log(self) -> ChangeLog:
        return ChangeLog(self.base(self.versions()[0]), self.path, self.keys, self.op)

    def append(self, changes: DataFrame, order: Sequence[str], batch_id: int) -> None:
        """Log the newest change per key of a batch; the same batch again replaces its changes.

        A batch that a base already holds stays as it is: it has been logged before the fold.
        """
        if batch_id >= self.versions()[-1]:
            self.log.append(changes, order, batch_id)

    def read(self, last: int | None = None) -> DataFrame:
        """The table after batch ``last`` (all by default), from the newest base that is not beyond it.

        Only the changes after that base are read and shuffled, to the base's buckets.
        """
        fits = [v for v in self.versions() if last is None or v <= last + 1]
        if not fits:
            raise ValueError(f"no base goes back to batch {last}")
        logged = self.log.log.rows().where(F.col("batch") >= fits[-1])
        if last is not None:
            logged = logged.where(F.col("batch") <= last)
        changes = effective_changes(logged.repartition(self.buckets, *self.keys), self.keys, "batch", self.op)
        return merge_changes(self.base(fits[-1]), changes, self.keys, self.op)

    def fold(self, last: int) -> None:
        """Write the table after batch ``last`` as the next base; nothing to do if there is one."""
        if last + 1 not in self.versions():
            self._save(self.read(last), last + 1)

    def drop(self, version: int) -> None:
        """Remove a base that no reader needs any more; the newest one stays."""
        if version == self.versions()[-1]:
            raise ValueError("the newest base is in use")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_v{version}")
