"""Repeated byte strings across documents by a depth-limited radix sort of suffixes.

Suffixes are ordered only as far as the threshold length, most significant
digit first, and a group of one leaves the sort at once:

* Of all suffixes only those at anchors enter. The anchor of a window of
  ``length`` bytes is the place of its smallest digit hash, which the bytes of
  the window alone decide, so equal windows have equal anchors. About 3 % of
  the positions are anchors.
* First digit: the ``DIGIT`` bytes from the anchor on. Groups of one hold no
  repeated window.
* Second digit: all bytes reached by the windows of an anchor. Members of a
  group but the first repeat it wholly.
* Last digit: the single windows of what is left, by their offset from the
  anchor and all their bytes. Equal groups are exactly the repeated windows.

Strings are compared by two 64-bit hashes of different kind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.bytesmath import Prefix, U, byte_values, mix, sliding_min, string_bytes
from tidemill.llm.frames import id_or_mark, mark_to_null, stored, text_or_empty
from tidemill.operators.ordered import ordered_index
from tidemill.session import cut

DIGIT = 32
#: Positions worked on at a time.
BLOCK = 1 << 18
#: A first digit followed by more contexts than this is sorted by the windows themselves, over many tasks.
HOT_CONTEXTS = 20_000

ANCHORS = "digit long, reach long, doc long, at long"
GROUPS = "digit long, doc long, at long, kind int"
WINDOWS = "digit long, doc long, at long, bytes binary"
REPEATS = "doc long, at long, windows int"

# ``at`` holds tie (25 bits), start (31 bits) and windows - 1 (7 bits): the order of occurrences within a doc_id.
_TIE, _START = 38, 7
TIE_BITS = 25
#: Ranks of texts under shared ids that are broadcast: 32 bytes each.
BROADCAST_RANKS = 200_000


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _start_of(at: np.ndarray) -> np.ndarray:
    return (at >> _START) & 0x7FFFFFFF


def _windows_of(at: np.ndarray) -> np.ndarray:
    return (at & 127) + 1


def anchors(length: int):
    """Batches of ``doc, tie, text`` to the runs of windows that share an anchor (rows of ``ANCHORS``).

    Runs that repeat within a batch are resolved here; ``reach`` 0 marks them, spread over all partitions.
    """
    digit = min(DIGIT, length)

    def runs(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, tie: np.ndarray) -> list[np.ndarray]:
        found = []
        for begin in range(0, max(0, len(data) - length + 1), BLOCK):
            values = byte_values(data[begin : begin + BLOCK + length - 1])
            every = Prefix(values).every(digit)
            places = np.arange(len(every), dtype=np.uint64)
            least = sliding_min((mix(every) & U(0xFFFFFFFF00000000)) | places, length - digit + 1)
            anchor = (least & U(0xFFFFFFFF)).astype(np.int64)
            window = np.arange(len(anchor))
            row = np.searchsorted(offsets, window + begin, side="right") - 1
            inside = window + begin + length <= offsets[row + 1]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
            first = np.flatnonzero(new)
            after = np.append(first[1:], len(anchor))
            keep = inside[first]
            first, after = first[keep], after[keep]
            # Windows of one run start at most 100 - digit before the anchor; longer thresholds need shorter runs.
            size = after - first
            pieces = -(-size // 128)
            if len(size) and pieces.max() > 1:
                piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = np.repeat(first, pieces) + 128 * piece
                after = np.minimum(np.repeat(after, pieces), first + 128)
                size = after - first
            reach = Prefix(values, 1).of(first, after - 1 + length)
            shape = ((anchor[first] - first) * 256 + size).astype(np.uint64)
            reach = mix(reach + shape * U(0x9E3779B97F4A7C15)) | U(1)
            start = first + begin - offsets[row[first]]
            at = (tie[row[first]] << _TIE) | (start << _START) | (size - 1)
            found.append((every[anchor[first]], reach, doc[row[first]], at))
        return [np.concatenate(x) for x in zip(*found)] if found else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            got = runs(data, offsets, batch.column("doc").to_numpy(), batch.column("tie").to_numpy())
            if not got:
                continue
            every, reach, doc, at = got
            order = np.lexsort((at, doc, reach, every))
            every, reach, doc, at = every[order], reach[order], doc[order], at[order]
            again = np.zeros(len(at), bool)
            again[1:] = (every[1:] == every[:-1]) & (reach[1:] == reach[:-1])
            spread = mix(doc.astype(np.uint64) ^ at.astype(np.uint64))
            head = np.maximum.accumulate(np.where(again, 0, np.arange(len(at))))
            same_place = again & (doc == doc[head]) & (at == at[head])
            every, reach = np.where(again, spread, every), np.where(again, U(0), reach)
            out = ~same_place
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(every)[out]), pa.array(_signed(reach)[out]), pa.array(doc[out]), pa.array(at[out])],
                names=["digit", "reach", "doc", "at"],
            )

    return work


def grouped(hot: int):
    """Rows of ``ANCHORS`` in order of all columns to rows of ``GROUPS``.

    kind 0: its windows repeat earlier ones; 1: its windows have to be compared within the digit; 2: as 1, but
    the digit has over ``hot`` contexts. Holds at most ``hot`` rows.
    """

    def batch_of(digit, doc, at, kind) -> pa.RecordBatch:
        kinds = np.full(len(at), kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(digit), pa.array(doc), pa.array(at), pa.array(kinds)], names=["digit", "doc", "at", "kind"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = [np.zeros(0, np.int64)] * 3
        pending, hot_digit, head = empty, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            digit, reach, doc, at = (batch.column(c).to_numpy() for c in ("digit", "reach", "doc", "at"))
            done = reach == 0
            if done.any():
                yield batch_of(digit[done], doc[done], at[done], 0)
                digit, reach, doc, at = digit[~done], reach[~done], doc[~done], at[~done]
                if not len(at):
                    continue
            new = np.ones(len(at), bool)
            new[1:] = (digit[1:] != digit[:-1]) | (reach[1:] != reach[:-1])
            carried = head is not None and (digit[0], reach[0]) == head[:2]
            if carried:
                new[0] = False
            at_head = np.maximum.accumulate(np.where(new, np.arange(len(at)), -1))
            head_doc = np.where(at_head < 0, head[2] if carried else 0, doc[at_head])
            head_at = np.where(at_head < 0, head[3] if carried else 0, at[at_head])
            repeat = ~new & ((doc != head_doc) | (at != head_at))
            if repeat.any():
                yield batch_of(digit[repeat], doc[repeat], at[repeat], 0)
            head = (digit[-1], reach[-1], head_doc[-1], head_at[-1])
            firsts = [np.concatenate(x) for x in zip(pending, (digit[new], doc[new], at[new]))]
            if not len(firsts[0]):
                continue
            starts = np.flatnonzero(np.append(True, firsts[0][1:] != firsts[0][:-1]))
            sizes = np.diff(np.append(starts, len(firsts[0])))
            size = np.repeat(sizes, sizes)
            kind = np.where((size > hot) | (firsts[0] == hot_digit if hot_digit is not None else False), 2, 1)
            open_group = np.arange(len(size)) >= starts[-1]
            if kind[-1] == 2:
                hot_digit, open_group = firsts[0][-1], np.zeros(len(size), bool)
            ready = ~open_group & ((size > 1) | (kind == 2))
            if ready.any():
                yield batch_of(*[x[ready] for x in firsts], kind[ready])
            pending = [x[open_group] for x in firsts]
        if len(pending[0]) > 1:
            yield batch_of(*pending, 1)

    return work


def cut_out(length: int):
    """Documents with their open runs to rows of ``WINDOWS``: one per run, of hot digits one per window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            raw = data.tobytes()
            runs = batch.column("runs")
            rows = np.repeat(np.arange(batch.num_rows), runs.value_lengths().fill_null(0).to_numpy())
            flat = runs.flatten()
            digit, at, kind = (flat.field(c).to_numpy() for c in ("digit", "at", "kind"))
            doc = batch.column("doc").to_numpy()[rows]
            begin = offsets[rows] + _start_of(at)
            hot = np.flatnonzero(kind == 2)
            if len(hot):
                plain = np.flatnonzero(kind != 2)
                count = _windows_of(at[hot])
                of = np.repeat(hot, count)
                step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                where = begin[of] + step
                keys = np.zeros(len(of), np.uint64)
                for i, w in enumerate(where):
                    keys[i] = Prefix(byte_values(data[w : w + length])).sums[-1]
                single = ((at[of] >> _TIE) << _TIE) | ((_start_of(at[of]) + step) << _START)
                digit = np.concatenate([digit[plain], _signed(mix(keys))])
                doc = np.concatenate([doc[plain], doc[of]])
                at = np.concatenate([at[plain], single])
                begin = np.concatenate([begin[plain], where])
            end = begin + _windows_of(at) - 1 + length
            yield pa.RecordBatch.from_arrays(
                [pa.array(digit), pa.array(doc), pa.array(at),
                 pa.array([raw[b:e] for b, e in zip(begin.tolist(), end.tolist())], pa.binary())],
                names=["digit", "doc", "at", "bytes"],
            )

    return work


def repeated(length: int):
    """Rows of ``WINDOWS`` in order of digit, doc and at to runs of windows that an earlier place has too.

    Between batches only the hashes of the windows seen for the last digit are held.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
        for batch in batches:
            if not batch.num_rows:
                continue
            digit, doc, at = (batch.column(c).to_numpy() for c in ("digit", "doc", "at"))
            data, offsets = string_bytes(batch.column("bytes"))
            count = _windows_of(at)
            row = np.repeat(np.arange(len(at)), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            begin = offsets[row] + step
            values = byte_values(data)
            hashes = mix(Prefix(values, 1).of(begin, begin + length))
            place = ((at[row] >> _START) + step)
            keep = 0
            if last is not None and digit[0] == last:
                keep = len(seen[0])
            else:
                seen = tuple(x[:0] for x in seen)
            every = np.concatenate([np.full(keep, digit[0]), digit[row]])
            hashes, owner, place = (np.concatenate(x) for x in zip(seen, (hashes, doc[row], place)))
            order = np.lexsort((place, owner, hashes, every))
            e, h = every[order], hashes[order]
            first = np.ones(len(order), bool)
            first[1:] = (e[1:] != e[:-1]) | (h[1:] != h[:-1])
            head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            again = np.zeros(len(order), bool)
            again[order] = (owner[order] != owner[head]) | (place[order] != place[head])
            last = digit[-1]
            held = first & (e == last)
            seen = (h[held], owner[order][held], place[order][held])
            again = again[keep:]
            start = again.copy()
            start[1:] &= ~(again[:-1] & (row[1:] == row[:-1]))
            begins = np.flatnonzero(start)
            if not len(begins):
                continue
            stop = again.copy()
            stop[:-1] &= ~(again[1:] & (row[1:] == row[:-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[row[begins]]), pa.array(place[keep:][begins] << _START),
                 pa.array((np.flatnonzero(stop) - begins + 1).astype(np.int32))],
                names=["doc", "at", "windows"],
            )

    return work


def without_repeats(length: int):
    """Documents with their repeated runs to what is left of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            runs = batch.column("repeats")
            counts = runs.value_lengths().fill_null(0).to_numpy()
            flat = runs.flatten()
            start = _start_of(flat.field("at").to_numpy())
            end = start + flat.field("windows").to_numpy() - 1 + length
            removed, spans, digests, lists = [], [], [], []
            position = 0
            for i, count in enumerate(counts):
                text = data[offsets[i] : offsets[i + 1]]
                merged: list[list[int]] = []
                if count:
                    here = slice(position, position + count)
                    position += count
                    order = np.argsort(start[here], kind="stable")
                    begins, ends = start[here][order], np.maximum.accumulate(end[here][order])
                    new = np.append(True, begins[1:] > ends[:-1])
                    heads = np.flatnonzero(new)
                    merged = list(map(list, zip(begins[heads].tolist(), ends[np.append(heads[1:], count) - 1].tolist())))
                digest, at = hashlib.sha256(), 0
                for b, e in merged:
                    digest.update(text[at:b])
                    at = e
                digest.update(text[at:])
                removed.append(sum(e - b for b, e in merged))
                spans.append(len(merged))
                digests.append(digest.hexdigest())
                lists.append(merged)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(lists, pa.list_(pa.list_(pa.int64())))],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    return work


def ranked_rows(rows: DataFrame) -> DataFrame:
    """``doc, text, tie``: the rank of the text among the distinct texts of its doc_id, by two 64-bit hashes; 0 alone.

    Counting ids tells which are shared. Their texts are ranked over range partitions, so an id on very many rows (those
    without id) is no task of its own. The ranks go to all rows by a broadcast up to ``BROADCAST_RANKS`` of them; beyond
    that, the texts are shuffled once more.
    """
    shared = cut(rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"))
    if shared.isEmpty():
        # Always 0 and never null, but no constant: Spark would leave a constant out of the join keys and shuffle the texts once more.
        return rows.withColumn("tie", F.xxhash64("doc").bitwiseAND(F.lit(0).cast("bigint")))
    hashes = {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), F.col("text"))}
    distinct = rows.join(shared, "doc", "left_semi").select("doc", *[h.alias(c) for c, h in hashes.items()]).distinct()
    ordered = cut(ordered_index(distinct, ["doc", "h1", "h2"]))
    first = ordered.groupBy("doc").agg(F.min("idx").alias("first"))
    few = ordered.limit(BROADCAST_RANKS + 1).count() <= BROADCAST_RANKS
    small = F.broadcast if few else lambda df: df
    rank = F.col("idx") - F.col("first")
    checked = F.when(rank < 1 << TIE_BITS, rank).otherwise(F.raise_error(F.lit("too many texts share one doc_id")).cast("bigint"))
    ranks = ordered.join(small(first), "doc").select("doc", "h1", "h2", checked.alias("tie"))
    return rows.withColumns(hashes).join(small(ranks), ["doc", "h1", "h2"], "left").select("doc", "text", F.coalesce("tie", F.lit(0)).alias("tie"))


RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<array<long>>"


def repeated_substrings(docs: DataFrame, length: int = 100, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """One row per document: what is left once each byte of a repeated ``length``-byte string is removed.

    A byte goes if a string of ``length`` bytes over it also starts at an earlier place: a smaller doc_id, or an
    earlier start in the same document. Result: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``removed``,
    the maximal removed runs as ``[start, end)`` in bytes.

    Null or empty texts give a row with zero bytes. A null doc_id comes before all others and stays null. Rows that
    share a doc_id are ordered by two hashes of the text (at most 2^25 distinct texts an id, else an error); rows equal in doc_id and text count as one document and get the
    same result each. Other columns are not read. ``length`` is 8 or more.
    """
    if length < 8:
        raise ValueError("length must be 8 or more")
    rows = ranked_rows(docs.select(id_or_mark().alias("doc"), text_or_empty().alias("text")))
    first = (
        rows.mapInArrow(anchors(length), ANCHORS)
        .repartition("digit").sortWithinPartitions("digit", "reach", "doc", "at")
        .mapInArrow(grouped(hot_contexts), GROUPS)
    )
    groups = stored(first, "suffix-groups").withColumn("tie", F.shiftright("at", _TIE))
    texts = rows.repartition("doc", "tie")
    runs = groups.where("kind > 0").groupBy("doc", "tie").agg(F.collect_list(F.struct("digit", "at", "kind")).alias("runs"))
    windows = (
        texts.join(runs, ["doc", "tie"]).select("doc", "text", "runs")
        .mapInArrow(cut_out(length), WINDOWS)
        .repartition("digit").sortWithinPartitions("digit", "doc", "at")
        .mapInArrow(repeated(length), REPEATS)
        .withColumn("tie", F.shiftright("at", _TIE))
    )
    whole = groups.where("kind = 0").select("doc", "at", (F.col("at").bitwiseAND(127) + 1).cast("int").alias("windows"), "tie")
    repeats = whole.unionByName(windows).groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "windows")).alias("repeats"))
    return (
        texts.join(repeats, ["doc", "tie"], "left").select("doc", "text", "repeats")
        .mapInArrow(without_repeats(length), RESULT)
        .withColumn("doc", mark_to_null("doc")).withColumnRenamed("doc", "doc_id")
    )
