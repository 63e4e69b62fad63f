"""Near-duplicate documents: a similarity join of shingle sets along chosen paths, and its components.

In each of several independent trees a document walks from the root along the shingles that are minimal under a hash of
the path so far. Similar sets walk together. A node of few documents is compared exhaustively on full sets; a larger
one branches by the next shingle, and what is still large at the last depth is compared in a grid of blocks, so no
candidate is given up. Sets of similarity s share a node of depth d in one tree with probability about s^d.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.bytesmath import U, mix, string_bytes
from tidemill.llm.components import components
from tidemill.llm.frames import id_or_mark, mark_to_null, stored, text_or_empty
from tidemill.llm.words import shingle_sets

TREES, DEPTH = 12, 3
#: A node of more documents branches; at the last depth it is cut into blocks of this many.
SMALL_NODE, BLOCK_DOCUMENTS = 128, 512

_SEEDS = mix(np.arange(1, 65, dtype=np.uint64) * U(0x9E3779B97F4A7C15))


def paths_of(tokens: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Nodes of one set, per tree those of depth 1 to ``depth``."""
    node = _SEEDS[:trees].copy()
    out = np.empty((trees, depth), np.uint64)
    each = np.arange(trees)
    for d in range(depth):
        order = mix(tokens[:, None] ^ node[None, :])
        node = mix(node + order[order.argmin(0), each] * U(3))
        out[:, d] = node
    return out.ravel()


def _signatures(size: int, trees: int, depth: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            sizes, first, second, paths = [], [], [], []
            for tokens in shingle_sets(data, offsets, size):
                sizes.append(len(tokens))
                first.append(int(mix(tokens).sum(dtype=np.uint64)))
                second.append(int(mix(tokens ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)))
                paths.append(paths_of(tokens, trees, depth) if len(tokens) else np.zeros(0, np.uint64))
            ends = np.cumsum([0] + [len(p) for p in paths]).astype(np.int32)
            values = np.concatenate(paths) if paths else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("h"), pa.array(sizes, pa.int64()), pa.array(np.array(first, np.uint64).view(np.int64)),
                 pa.array(np.array(second, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))],
                names=["doc", "h", "n", "c1", "c2", "paths"],
            )

    return work


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def node_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is alike within a node. Pairs that earlier links connect already are not compared."""
    top = list(range(len(sets)))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    members: dict[int, list[int]] = {}
    found = []
    for i, own in enumerate(sets):
        for root in list(members):
            for j in reversed(members[root]):
                if _alike(own, sets[j], percent):
                    found.append((i, j))
                    break
            else:
                continue
            mine = find(i)
            top[root] = mine
            members[mine] = members.pop(root) + members.pop(mine, [])
        mine = find(i)
        members.setdefault(mine, []).append(i)
    return found


def _verified(size: int, percent: int):
    """Rows ``node, doc, text`` in order of node to confirmed links; a node's sets are in memory together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, docs, sets = None, [], []

        def links() -> list[tuple[int, int]]:
            order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
            return [(docs[order[i]], docs[order[j]]) for i, j in node_links([sets[i] for i in order], percent)]

        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            found = []
            for key, doc, tokens in zip(batch.column("node").to_pylist(), batch.column("doc").to_pylist(), shingle_sets(data, offsets, size)):
                if key != node:
                    found += links()
                    node, docs, sets = key, [], []
                docs.append(doc)
                sets.append(tokens)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
        if found := links():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return work


def near_duplicates(
    docs: DataFrame, size: int = 3, percent: int = 85, trees: int = TREES, small: int = SMALL_NODE, block: int = BLOCK_DOCUMENTS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of ``size``-word shingles have a Jaccard similarity of ``percent`` / 100 or
    more, confirmed on full sets (64-bit hashes of shingles); a component is what links connect, and its smallest
    doc_id is kept. Documents of equal sets are one member of the join.

    Null and empty texts, or texts without words, have no shingles and are linked with nothing. Fewer words than
    ``size`` make one shingle. Rows that share a doc_id are one document of the component. A null doc_id is the
    smallest id and stays null. Other columns are not read.
    """
    # A class is known by its smallest row (id, then text hash), so texts that share an id stay apart.
    rows = docs.select(id_or_mark().alias("doc"), text_or_empty().alias("text")).withColumn("h", F.xxhash64("text"))
    signed = stored(
        rows.mapInArrow(_signatures(size, trees, DEPTH), "doc long, h long, n long, c1 long, c2 long, paths array<long>"), "signatures"
    )
    named = signed.where("n > 0").groupBy("c1", "c2", "n").agg(F.min(F.struct("doc", "h")).alias("least"))
    named = named.select("c1", "c2", "n", F.col("least.doc").alias("rep"), F.col("least.h").alias("rep_h"))
    classes = signed.select("doc", "n", "c1", "c2").join(named, ["c1", "c2", "n"], "left")
    members = (
        signed.where("n > 0").join(named, ["c1", "c2", "n"]).where("doc = rep and h = rep_h")
        .select("rep", "rep_h", "n", "c1", "c2", "paths").dropDuplicates(["c1", "c2", "n"])
    )
    step = lambda t: F.struct(*[F.get("paths", t * DEPTH + d).alias(f"k{d}") for d in range(DEPTH)])
    walks = members.select("rep", "rep_h", F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), step)).alias("w")).select("rep", "rep_h", "w.*")
    counts = walks.groupBy("k0").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = stored(walks.join(counts, "k0"), "shared-nodes")
    leaves = shared.where(F.col("m") <= small).select("rep", "rep_h", F.col("k0").alias("node"), "m")
    wide = shared.where(F.col("m") > small).drop("m")
    for d in range(1, DEPTH):
        sizes = wide.groupBy(f"k{d}").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        branched = wide.join(sizes, f"k{d}")
        done = F.col("m") <= small if d < DEPTH - 1 else F.lit(True)
        leaves = leaves.unionByName(branched.where(done).select("rep", "rep_h", F.col(f"k{d}").alias("node"), "m"))
        wide = branched.where(~done).drop("m")
    # Trees often find the same group: one node of each set of members is enough.
    same = leaves.groupBy("node", "m").agg(F.sum(F.xxhash64("rep", "rep_h").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("rep", "rep_h", F.lit(1))).alias("x"))
    chosen = same.groupBy("m", "s", "x").agg(F.min("node").alias("node")).select("node")
    own = F.pmod(F.xxhash64("rep", "rep_h", F.lit(2)), F.ceil(F.col("m") / F.lit(block)))
    cells = F.transform(
        F.sequence(F.lit(0), F.ceil(F.col("m") / F.lit(block)).cast("int") - 1),
        lambda other: F.when(F.col("m") <= block, F.col("node")).otherwise(F.xxhash64("node", F.least(own, other.cast("bigint")), F.greatest(own, other.cast("bigint")))),
    )
    placed = leaves.join(chosen, "node").groupBy("rep", "rep_h").agg(F.array_distinct(F.flatten(F.collect_list(cells))).alias("nodes"))
    links = (
        rows.join(placed, (F.col("doc") == F.col("rep")) & (F.col("h") == F.col("rep_h"))).select("doc", "text", F.explode("nodes").alias("node"))
        .repartition("node").sortWithinPartitions("node", "doc").select("node", "doc", "text")
        .mapInArrow(_verified(size, percent), "a long, b long")
    )
    found = components(links)
    component = F.coalesce("component", "rep", "doc")
    return classes.join(found, F.col("rep") == F.col("node"), "left").select(
        mark_to_null("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(component != F.lit(-(2**63)), component).alias("component_id"), (F.col("doc") == component).alias("kept"),
    )
