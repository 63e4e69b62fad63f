"""A table as its first content and an append-only log of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.changes import effective_changes, merge_changes
from tidemill.operators.latest import newest_per_key
from tidemill.sources.batches import BatchFolder


class ChangeLog:
    """The rows of ``base`` and, per micro-batch, the newest change of each key it brought.

    An append writes the changes of its batch and nothing else; reading merges what was logged up to a batch into the
    base, which must stay as it is. A job that wants shorter reads now and then writes ``read()`` somewhere as the base
    of a new log. Changes with a NULL in the key count as those of one
    key that no row of the base has.
    """

    def __init__(self, base: DataFrame, path: str, keys: Sequence[str], op: str = "oc"):
        self.base, self.keys, self.op = base, list(keys), op
        fields = [T.StructField(f.name, f.dataType) for f in base.schema.fields if f.name != op]
        self.log = BatchFolder(base.sparkSession, path, T.StructType([*fields, T.StructField(op, T.StringType())]))

    def append(self, changes: DataFrame, order: Sequence[str], batch_id: int) -> None:
        """Log the newest change per key by ``order``; the same batch again replaces its changes.

        Values are cast to the types of the base (before keys are compared); columns that the changes lack are NULL.
        """
        types = {f.name: f.dataType for f in self.log.schema.fields}
        given = set(changes.columns)
        typed = [(F.col(c) if c in given else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        ranked = changes.select(*typed, *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)])
        newest = newest_per_key(ranked, self.keys, [f"_order_{i}" for i in range(len(order))])
        self.log.write(batch_id, newest)

    def read(self, last: int | None = None) -> DataFrame:
        """The table after batch ``last``: after all batches by default, as it began with -1."""
        logged = self.log.rows()
        if last is not None:
            logged = logged.where(F.col("batch") <= last)
        return merge_changes(self.base, effective_changes(logged, self.keys, "batch", self.op), self.keys, self.op)
