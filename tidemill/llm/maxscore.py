"""Exact top-k inner products of integer vectors by MaxScore over shards.

Every component is a query term, its postings the vectors of a shard with their value. Terms are ordered by how much
they can add over the least contribution they make in the shard. Terms whose gains together cannot lift a vector
to the k-th best score so far are non-essential: only the postings of the others are traversed, and the rest are probed
for the vectors that can still compete. Shards report their k best, which are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_VECTORS, QUERY_BLOCK = 8192, 1024
#: Vectors scored in full to find a first threshold, and terms probed between two looks at who still competes.
SEED_VECTORS, PROBE_TERMS = 1024, 16


def integers(vector: str, scale: int = 64) -> Column:
    """``floor(scale * x)`` of each component as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def usable(vector: str) -> Column:
    """Neither null nor holding nulls, NaN or infinities."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def _packed(rows: pd.DataFrame, kind: str) -> pd.DataFrame:
    """One row of a block: ids and a matrix of vectors, shorter ones filled up with zeros."""
    rows = rows.sort_values("vec_id")
    width = max(map(len, rows["v"]))
    matrix = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows["v"]):
        matrix[i, : len(v)] = v
    largest = int(np.abs(matrix).max()) if matrix.size else 0
    small = next(t for t in (np.int8, np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max)
    return pd.DataFrame({
        kind: [int(rows[kind].iloc[0])], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "width": [width],
        "bits": [np.dtype(small).itemsize], "matrix": [matrix.astype(small).tobytes()],
    })


def _unpacked(ids: bytes, width: int, bits: int, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(matrix, f"i{bits}").reshape(-1, width).astype(np.int64)


def top_of_shard(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per query its id, and ids and scores of its best k vectors of the shard, ties to smaller ids."""
    width = min(queries.shape[1], vectors.shape[1])
    queries, vectors = queries[:, :width], vectors[:, :width]
    reach = float(np.abs(queries.astype(np.float64)).max(initial=0)) * float(np.abs(vectors.astype(np.float64)).max(initial=0)) * max(1, width)
    kind = np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else object  # all sums are exact
    postings = np.ascontiguousarray(vectors.T).astype(kind)
    q = queries.astype(kind)
    high, low = postings.max(1), postings.min(1)
    most, least = np.maximum(q * high, q * low), np.minimum(q * high, q * low)
    gain = most - least
    seeds = np.concatenate([q @ postings[:, :SEED_VECTORS]])
    found = []
    for i in range(len(q)):
        own = ids == query_ids[i]
        first = seeds[i][~own[:SEED_VECTORS]]
        bar = np.sort(first)[-k] if len(first) >= k else None
        order = np.argsort(-gain[i].astype(np.float64), kind="stable")
        weights = q[i][order]
        rest = np.append(np.cumsum(most[i][order][::-1])[::-1], 0)  # the most that the terms from here on can add
        if bar is None:
            essential = width
        else:
            base = least[i].sum()
            lifts = np.append(np.cumsum(gain[i][order][::-1])[::-1], 0)
            essential = int(np.argmax(base + lifts < bar)) if (base + lifts < bar).any() else width
        # Traversal by term in steps: after each the vectors that cannot reach the bar drop out.
        step = order[:essential][: max(PROBE_TERMS, essential // 2)]
        score = q[i][step] @ postings[step]
        at, alive = len(step), np.flatnonzero(~own)
        while at < width:
            if bar is not None:
                alive = alive[score[alive] + rest[at] >= bar]
            step = order[at : at + PROBE_TERMS]
            if len(alive) * 4 > len(score):
                score = score + weights[at : at + PROBE_TERMS] @ postings[step]
            else:
                score[alive] += weights[at : at + PROBE_TERMS] @ postings[np.ix_(step, alive)]
            at += PROBE_TERMS
        own_scores = score[alive]
        if len(alive) > 4 * k and kind is not object:
            cut = np.partition(own_scores, -k)[-k]
            alive, own_scores = alive[own_scores >= cut], own_scores[own_scores >= cut]
        best = sorted(zip((-own_scores).tolist(), ids[alive].tolist()))[:k]
        found.append((query_ids[i], np.array([b[1] for b in best], np.int64), np.array([-int(b[0]) for b in best], np.int64)))
    return found


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, shard_vectors: int = SHARD_VECTORS, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: per query the ``k`` highest integer inner products with all other rows.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition over vec_id. Components become
    ``floor(scale * x)``. Ties go to the smaller vec_id; with fewer candidates all are returned. Vectors that are null
    or hold null or non-finite components take no part, nor do rows without vec_id. Of rows that share a vec_id the
    vector that comes first in order stands for all. Vectors of different lengths are multiplied as far as both go.

    Queries and candidates meet as packed blocks: each block of queries is scored against each shard once, and at most
    ``k`` rows per query leave a shard.
    """
    rows = (
        vectors.where(usable("embedding") & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), integers("embedding", scale).alias("v"))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )
    n = vectors.count()
    shards, blocks = n // shard_vectors + 1, n // (20 * query_block) + 1
    packed = "ids binary, width int, bits int, matrix binary"
    shard = (
        rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).groupBy("shard")
        .applyInPandas(lambda p: _packed(p, "shard"), f"shard int, {packed}")
    )
    block = (
        rows.where(is_query).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")).groupBy("block")
        .applyInPandas(lambda p: _packed(p, "block"), f"block int, {packed}")
        .toDF("block", "q_ids", "q_width", "q_bits", "q_matrix")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = _unpacked(row["ids"], row["width"], row["bits"], row["matrix"])
                asked = _unpacked(row["q_ids"], row["q_width"], row["q_bits"], row["q_matrix"])
                best = top_of_shard(*asked, *own, k)
                query = np.repeat([b[0] for b in best], [len(b[1]) for b in best])
                if len(query):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query.astype(np.int64)), pa.array(np.concatenate([b[1] for b in best])), pa.array(np.concatenate([b[2] for b in best]))],
                        names=["query_id", "vec_id", "score"],
                    )

    pairs = block.join(shard, "shard").repartition(F.xxhash64("shard", "block"))
    scored = pairs.mapInArrow(score, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_sql(k: int = 20, scale: int = 64) -> str:
    """DuckDB: the same over ``embeddings``, queries being the vec_ids divisible by 20."""
    return (
        f"WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale}.0::DOUBLE * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0), "
        "s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q, v c "
        "WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id) "
        "SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s "
        f"WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= {k}"
    )
