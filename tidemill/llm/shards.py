"""Documents to shards by jump consistent hashing, with gapless slots inside each shard."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.frames import id_or_mark, mark_to_null, text_or_empty
from tidemill.session import cut

#: Fixed values of the published hash: its multiplier and the 31 bits of its quotient.
MULTIPLIER, QUOTIENT = 2862933555777941757, 1 << 31


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. With one more shard a key keeps its shard or goes to the new one."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    rows, at = np.arange(len(state)), np.zeros(len(state), np.int64)
    while len(rows):
        shard[rows] = at
        state = state * np.uint64(MULTIPLIER) + np.uint64(1)
        at = ((at + 1) * (QUOTIENT / ((state >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        jumps = at < shards
        rows, at, state = rows[jumps], at[jumps], state[jumps]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(), shards).astype(np.int32))

    return jump(key)


def with_slots(df: DataFrame, shard: str, order: Sequence[str], name: str = "slot", parts: int | None = None) -> DataFrame:
    """Add the position 0, 1, 2, ... of each row within its shard, in ``order``.

    Rows are range partitioned by ``order`` over all shards together, so neither a large shard nor one much repeated
    id fills a task. Each partition numbers its own rows and adds the counts of those before it: partitions x shards
    numbers, which are broadcast.
    """
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", 33))
    )
    earlier = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        placed.groupBy("_part", shard).agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", shard, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    own = Window.partitionBy("_part", shard).orderBy("_row")
    return (
        placed.withColumn("_own", F.row_number().over(own) - 1)
        .join(F.broadcast(counts), ["_part", shard])
        .withColumn(name, (F.col("_before") + F.col("_own")).cast("bigint"))
        .drop("_part", "_row", "_own", "_before")
    )


def shard_documents(docs: DataFrame, shards: int = 24, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, grown_shard and the columns ``keep``.

    The shard depends on doc_id and the number of shards alone; ``grown_shard`` is the shard with one shard more. size
    is the text's UTF-8 bytes plus 8; a null text has no bytes and the checksum 0. Slots follow doc_id, then checksum
    and size, and have no gaps. A null doc_id is hashed as the lowest 64-bit number, comes first in its shard and stays
    null; repeated rows share the shard and get one slot each. Other columns are not read.
    """
    rows = docs.select(
        id_or_mark().alias("_id"),
        (F.octet_length(text_or_empty()) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
        *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep],
    )
    placed = rows.withColumn("shard", shard_of(F.col("_id"), shards)).withColumn("grown_shard", shard_of(F.col("_id"), shards + 1))
    return with_slots(placed, "shard", ["_id", "text_crc32", "size"]).select(
        mark_to_null("_id").alias("doc_id"), "size", "text_crc32", "shard", "slot", "grown_shard",
        *[F.col(f"`_keep_{c}`").alias(c) for c in keep],
    )
