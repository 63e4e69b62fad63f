"""Aggregates of user code that merge: zero, reduce, merge, finish.

Each task reduces its rows to one buffer per key before anything is shuffled, so a
hot key sends one buffer per task. Buffers of a key then meet and are merged one
after the other; no group is held in memory.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

#: Buffers a task holds before it sends them on; a key may then have several of one task.
BUFFERS_A_TASK = 100_000
#: Rows that a task reduces at a time.
ROWS_AT_ONCE = 50_000
BUFFER = "_buffer"
_NAN = float("nan")


class UserAggregate:
    """An aggregate in user code. ``result`` is its type as DDL, ``columns`` are those it reads.

    ``merge`` must not care for order or grouping, and ``zero`` must change nothing. Buffers are what pickle can carry.
    """

    columns: Sequence[str]
    result: str

    def zero(self) -> Any:
        raise NotImplementedError

    def reduce(self, buffer: Any, rows: pa.RecordBatch) -> Any:
        """The buffer with some rows of its key added; ``rows`` has ``columns`` only."""
        raise NotImplementedError

    def reduce_runs(self, buffers: Sequence[Any], rows: pa.RecordBatch, starts: Sequence[int]) -> list[Any]:
        """The buffers of several keys with their rows added; those of key ``i`` begin at ``starts[i]``.

        Where keys have few rows each, an aggregate that does this for all of them at once saves a call per key.
        """
        ends = [*starts[1:], rows.num_rows]
        return [self.reduce(b, rows.slice(lo, hi - lo)) for b, lo, hi in zip(buffers, starts, ends)]

    def merge(self, left: Any, right: Any) -> Any:
        raise NotImplementedError

    def finish(self, buffer: Any) -> Any:
        raise NotImplementedError


class Average(UserAggregate):
    """Mean of a whole-number column; nulls don't count, NULL without values."""

    result = "double"

    def __init__(self, column: str):
        self.columns = [column]

    def zero(self):
        return 0, 0

    def reduce(self, buffer, rows):
        values = rows.column(0).drop_null()
        # Arrow adds up in 64 bits; decimals of 38 digits hold any sum of a batch.
        total = int(pc.sum(values.cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))).as_py() or 0)
        return buffer[0] + total, buffer[1] + len(values)

    def merge(self, left, right):
        return left[0] + right[0], left[1] + right[1]

    def finish(self, buffer):
        return buffer[0] / buffer[1] if buffer[1] else None


class Newest(UserAggregate):
    """``value`` of the greatest ``order``, ties to the smallest ``arrival``; rows without order or arrival don't count."""

    def __init__(self, value: str, order: str, arrival: str, result: str):
        self.columns, self.result = [value, order, arrival], result

    def zero(self):
        return None

    def reduce(self, buffer, rows):
        return self.reduce_runs([buffer], rows, [0])[0]

    def reduce_runs(self, buffers, rows, starts):
        run = np.repeat(np.arange(len(starts)), np.diff([*starts, rows.num_rows]))
        rows = pa.RecordBatch.from_arrays([*rows.columns, pa.array(run)], names=["value", "order", "arrival", "run"])
        rows = rows.filter(pc.and_(pc.is_valid(rows.column(1)), pc.is_valid(rows.column(2))))
        rows = rows.take(pc.sort_indices(rows, [("run", "ascending"), ("order", "descending"), ("arrival", "ascending")]))
        found, first = np.unique(rows.column(3).to_numpy(), return_index=True)
        merged = list(buffers)
        for i, newest in zip(found.tolist(), zip(*(c.to_pylist() for c in rows.take(pa.array(first)).columns[:3]))):
            merged[i] = self.merge(merged[i], newest)
        return merged

    def merge(self, left, right):
        if left is None or right is None:
            return left or right
        return right if (right[1], -right[2]) > (left[1], -left[2]) else left

    def finish(self, buffer):
        return buffer[0] if buffer else None


def _key_tuples(columns: Sequence[pa.Array], at: Sequence[int]) -> list[tuple]:
    """Keys as Python values; not-a-number is one value, as in Spark's grouping."""
    if not columns:
        return [()] * len(at)
    values = [column.take(pa.array(at, pa.int64())).to_pylist() for column in columns]
    return [tuple(_NAN if v != v else v for v in key) for key in zip(*values)]


def _runs(keys: Sequence[pa.Array], n: int) -> list[int]:
    """Where runs of equal keys begin; ``keys`` are sorted."""
    if not keys or n < 2:
        return [0]
    new = pa.array([False] * (n - 1))
    for column in keys:
        a, b = column.slice(0, n - 1), column.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), True)
        new = pc.or_(new, pc.and_not(differ, pc.and_(pc.is_null(a), pc.is_null(b))))
    return [0, *(i + 1 for i in pc.indices_nonzero(new).to_pylist())]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to ``ROWS_AT_ONCE`` rows or a few more, so that a key has its rows in fewer of them."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= ROWS_AT_ONCE:
            yield pa.concat_batches(waiting)
            waiting = []
    if waiting:
        yield pa.concat_batches(waiting)


def partial_buffers(df: DataFrame, keys: Sequence[str | Column], aggregate: UserAggregate) -> DataFrame:
    """The keys and ``_buffer``: what each task made of its rows. Such rows may be kept and merged with later ones."""
    named = df.select(*keys)
    names, n_keys = list(named.columns), len(keys)
    columns = list(aggregate.columns)
    rows = df.select(*[F.col(k) if isinstance(k, str) else k for k in keys], *[F.col(c).alias(f"_in_{i}") for i, c in enumerate(columns)])
    schema = T.StructType([*named.schema.fields, T.StructField(BUFFER, T.BinaryType())])
    arrow_keys = [pa.field(f"k{i}", pa.null()) for i in range(n_keys)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers: dict[tuple, Any] = {}
        types = None
        for batch in _gathered(batches):
            types = [batch.schema.field(i).type for i in range(n_keys)]
            if not batch.num_rows:
                continue
            if n_keys:
                plain = pa.RecordBatch.from_arrays(batch.columns[:n_keys], names=[f.name for f in arrow_keys])
                batch = batch.take(pc.sort_indices(plain, [(f.name, "ascending") for f in arrow_keys]))
            starts = _runs(batch.columns[:n_keys], batch.num_rows)
            own = pa.RecordBatch.from_arrays(batch.columns[n_keys:], names=columns) if columns else batch
            found = _key_tuples(batch.columns[:n_keys], starts)
            reduced = aggregate.reduce_runs([aggregate.zero() for _ in found], own, starts)
            for key, buffer in zip(found, reduced):  # a key may come twice: not-a-numbers differ for Arrow
                buffers[key] = aggregate.merge(buffers[key], buffer) if key in buffers else buffer
            if len(buffers) > BUFFERS_A_TASK:
                yield _batch(buffers, types, names)
                buffers = {}
        if buffers:
            yield _batch(buffers, types, names)

    return rows.mapInArrow(work, schema)


def _batch(buffers: dict[tuple, Any], types, names) -> pa.RecordBatch:
    columns = [pa.array([key[i] for key in buffers], kind) for i, kind in enumerate(types)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([pickle.dumps(b) for b in buffers.values()], pa.binary())], names=[*names, BUFFER])


def merged_buffers(partial: DataFrame, aggregate: UserAggregate, name: str) -> DataFrame:
    """The keys and the result ``name`` of the buffers of :func:`partial_buffers`, of one or of several runs.

    One shuffle by the keys; buffers are merged in sorted order as they come, so a task holds one at a time. Without keys
    and without rows the result is that of ``zero``, as for built-in aggregates.
    """
    keys = [f for f in partial.schema.fields if f.name != BUFFER]
    names = [f.name for f in keys]
    kind = T.StructType.fromDDL(f"result {aggregate.result}")["result"].dataType
    schema = T.StructType([*keys, T.StructField(name, kind)])
    result_type = to_arrow_type(kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, buffer, types, done = None, aggregate.zero(), None, []

        def flush():
            columns = [pa.array([k[i] for k, _ in done], t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([v for _, v in done], result_type)], names=[*names, name])

        for batch in batches:
            types = [batch.schema.field(i).type for i in range(len(names))]
            all_keys = _key_tuples(batch.columns[:-1], range(batch.num_rows))
            for k, b in zip(all_keys, batch.columns[-1].to_pylist()):
                if key is not None and k != key:
                    done.append((key, aggregate.finish(buffer)))
                    buffer = aggregate.zero()
                key, buffer = k, aggregate.merge(buffer, pickle.loads(b))
            if len(done) > 10_000:
                yield flush()
                done = []
        if key is not None or not names:
            types = types or []
            done.append((key or (), aggregate.finish(buffer)))
        if done:
            yield flush()

    if names:
        met = partial.repartition(*names).sortWithinPartitions(*names)
    else:
        met = partial.repartition(1)  # one buffer per task
    return met.mapInArrow(work, schema)


def user_aggregate(df: DataFrame, keys: Sequence[str | Column], aggregate: UserAggregate, name: str) -> DataFrame:
    """The keys and ``name``: the aggregate per key. Keys are grouped as by ``groupBy``: null is a key of its own."""
    return merged_buffers(partial_buffers(df, keys, aggregate), aggregate, name)


def register_aggregate(spark: SparkSession, name: str, aggregate: UserAggregate, keys: str, inputs: str) -> None:
    """The aggregate as two table functions of SQL, for keys and inputs given as DDL (``"kind string"``, ``"v bigint"``):

    ``SELECT * FROM name_merge(TABLE(SELECT * FROM name_partial(TABLE(SELECT kind, v FROM t))) PARTITION BY kind)``

    ``name_partial`` takes the keys and then the inputs and gives a buffer per key and task, ``name_merge`` the result.
    """
    key_names = T.StructType.fromDDL(keys).names
    columns = T.StructType.fromDDL(inputs).names
    if list(aggregate.columns) != columns:
        raise ValueError(f"the aggregate reads {list(aggregate.columns)}, not {columns}")
    schema = to_arrow_schema(T.StructType.fromDDL(inputs))
    n = len(key_names)

    class Partial:
        def __init__(self):
            self.waiting, self.rows, self.buffers = {}, 0, {}

        def _reduce(self):
            for key, rows in self.waiting.items():
                batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], names=columns)
                self.buffers[key] = aggregate.reduce(self.buffers[key] if key in self.buffers else aggregate.zero(), batch)
            self.waiting, self.rows = {}, 0

        def eval(self, row):
            values = tuple(row)
            self.waiting.setdefault(values[:n], []).append(values[n:])
            self.rows += 1
            if self.rows >= 10_000:
                self._reduce()
                if len(self.buffers) > BUFFERS_A_TASK:
                    yield from self._out()

        def _out(self):
            for key, buffer in self.buffers.items():
                yield (*key, pickle.dumps(buffer))
            self.buffers = {}

        def terminate(self):
            self._reduce()
            yield from self._out()

    class Merge:
        def __init__(self):
            self.key, self.buffer = None, aggregate.zero()

        def eval(self, row):
            values = tuple(row)
            self.key, self.buffer = values[:n], aggregate.merge(self.buffer, pickle.loads(bytes(values[n])))

        def terminate(self):
            if self.key is not None:
                yield (*self.key, aggregate.finish(self.buffer))

    spark.udtf.register(f"{name}_partial", F.udtf(Partial, returnType=f"{keys}, buffer binary", useArrow=True))
    spark.udtf.register(f"{name}_merge", F.udtf(Merge, returnType=f"{keys}, result {aggregate.result}", useArrow=True))
