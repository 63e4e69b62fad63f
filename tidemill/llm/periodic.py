"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch of words in which words ``q`` apart are equal. At
each dyadic scale ``t`` a window of ``t`` words has a hash that depends on its
words alone. A position is selected if the least hash of the windows from it to
``t`` words on stands at either end, so equal contexts are selected alike.
Windows with a period of a third of their length or less take no part: they lie
in runs that smaller scales have found already. Selected positions with equal
contexts that follow each other propose their distance as a period.

Why none is missed: let a run of smallest period ``q`` hold three periods or
more, ``2t <= q < 4t``, and contexts have ``3t`` words for ``q < 3t``, else
``4t``. Were no position of its first ``2q - context`` words selected, these
words and ``2t - 1`` more would have a period of ``t / 3`` or less besides
``q``, hence a common divisor of both, against the choice of ``q``. The next
equal context after a selected position is exactly ``q`` words on: a nearer one
would again give a smaller period, as a context has ``q`` words or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tidemill.llm.bytesmath import U, mix, sliding_min, string_bytes
from tidemill.llm.words import document_groups

#: Periods below this are found by comparing the words themselves.
SMALL = 4
#: The proof above needs runs of three periods.
LEAST_EXPONENT = 3
_NEVER = np.iinfo(np.uint64).max

RUNS_TYPE = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))


def _reach(ids: np.ndarray, at: np.ndarray, distance: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on (by ``step``) equal those ``distance`` words after them, ``room`` at most."""
    done = np.zeros(len(at), np.int64)
    active, width = np.flatnonzero(room > 0), 8
    while len(active):
        ahead = done[active, None] + np.arange(width)
        inside = ahead < room[active, None]
        place = np.where(inside, at[active, None] + step * ahead, at[active, None])
        same = inside & (ids[place] == ids[place + distance[active, None]])
        full = same.all(axis=1)
        done[active] += np.where(full, width, same.argmin(axis=1))
        active, width = active[full], min(2 * width, 256)
    return done


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _highly_periodic(runs: list[np.ndarray], n: int, t: int) -> np.ndarray:
    """Positions whose window of ``t`` words lies in a known run of period ``t / 3`` or less."""
    marks = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        some = (3 * period <= t) & (length >= t) & (start + length <= n)
        np.add.at(marks, start[some], 1)
        np.add.at(marks, (start + length)[some] - t + 1, -1)
    return np.cumsum(marks)[: n - t + 1] > 0


def find_runs(ids: np.ndarray, bounds: np.ndarray, least_words: int, least_exponent: int) -> np.ndarray:
    """Runs as rows ``start, length, period``, sorted, of documents that lie one after the other, longest first.

    ``ids`` are word numbers, ``bounds`` the documents' first positions and the end of all.
    """
    lengths = np.diff(bounds)
    begin_of, end_of = np.repeat(bounds[:-1], lengths), np.repeat(bounds[1:], lengths)
    runs = []
    for q in range(1, SMALL):
        places = np.arange(max(0, len(ids) - q))
        begin, end = _stretches((ids[places] == ids[places + q]) & (places + q < end_of[places]))
        some = end - begin >= (LEAST_EXPONENT - 1) * q
        runs.append(np.stack((begin[some], (end - begin + q)[some], np.full(some.sum(), q))))
    t, names = 1, ids
    while True:
        n = int(bounds[np.searchsorted(-lengths, -LEAST_EXPONENT * 2 * t, side="right")])
        if not n:
            break
        double = np.unique(names[: n - 2 * t + 1] * np.int64(len(ids)) + names[t : n - t + 1], return_inverse=True)[1] if n >= 2 * t else names[:0]
        if 2 * t >= SMALL and len(double):
            hashes = mix(names[: n - t + 1].astype(np.uint64) ^ (U(t) << U(40))) >> U(1)
            hashes[_highly_periodic(runs, n, t)] = _NEVER
            least = sliding_min(hashes, t + 1)
            selected = np.flatnonzero(((least == hashes[: len(least)]) | (least == hashes[t : t + len(least)])) & (least != _NEVER))
            for most, after in ((3, names), (4, double)):
                context = most * t
                at = selected[selected + context <= end_of[selected]]
                key = double[at] * np.int64(len(ids)) + after[at + 2 * t]
                order = np.argsort(key, kind="stable")
                key, at = key[order], at[order]
                distance = np.diff(at)
                some = (key[1:] == key[:-1]) & (end_of[at[1:]] == end_of[at[:-1]]) & (distance >= (most - 1) * t) & (distance < context)
                at, distance = at[:-1][some], distance[some]
                if not len(at):
                    continue
                order = np.lexsort((at, distance))
                at, distance = at[order], distance[order]
                new = np.ones(len(at), bool)
                new[1:] = (distance[1:] != distance[:-1]) | (at[1:] > at[:-1] + context) | (end_of[at[1:]] != end_of[at[:-1]])
                first = np.flatnonzero(new)
                begin, end, period = at[first], at[np.append(first[1:], len(at)) - 1] + context, distance[first]
                end += _reach(ids, np.minimum(end, len(ids) - 1), period, end_of[begin] - period - end, 1)
                begin = begin - _reach(ids, np.maximum(begin - 1, 0), period, begin - begin_of[begin], -1)
                some = end - begin >= (LEAST_EXPONENT - 1) * period
                runs.append(np.stack((begin[some], (end - begin + period)[some], period[some])))
        t, names = 2 * t, double
    start, length, period = np.concatenate(runs, axis=1)
    some = length >= np.maximum(least_words, least_exponent * period)
    start, length, period = start[some], length[some], period[some]
    # The same stretch with a multiple of its smallest period is no other run.
    order = np.lexsort((period, length, start))
    found = np.stack((start, length, period), axis=1)[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _runs_of(texts: list[bytes], least_words: int, least_exponent: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs (by word numbers of the text) and kept words of each text."""
    words = [t.split() for t in texts]  # bytes split at ASCII white space alone
    order = sorted(range(len(words)), key=lambda k: -len(words[k]))
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for k in order for w in words[k]], np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(words[k]) for k in order])))
    found = find_runs(ids, bounds, least_words, least_exponent)
    at = np.searchsorted(found[:, 0], bounds)
    dropped = np.zeros(len(ids) + 1, np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(dropped) == 0
    results = [None] * len(words)
    for place, k in enumerate(order):
        lo, hi = at[place], at[place + 1]
        own = words[k]
        if hi > lo:
            own = [own[i] for i in np.flatnonzero(kept[bounds[place] : bounds[place + 1]]).tolist()]
        results[k] = (found[lo:hi] - np.array([bounds[place], 0, 0]), b" ".join(own))
    yield from results


def periodic_runs(docs: DataFrame, least_words: int = 6, least_exponent: int = 4) -> DataFrame:
    """``doc_id, runs, collapsed`` per row of ``docs``: runs (start, length, period in words) by start and period, and
    the words outside of repeated periods joined by one blank.

    Words are runs without ASCII white space, compared byte for byte. A run has ``least_words`` words and
    ``least_exponent`` (3 or more) periods at least. A word stays unless a run holds it after its first period.
    Texts that are null, empty or blank have no runs and an empty ``collapsed``. Each row stands for itself, so repeated
    rows, shared ids and null ids give a row each; columns other than doc_id and text are ignored whatever their names.
    An empty table gives an empty one. A text of any length is worked on as a whole, about 2 MB of shorter ones at a time.
    Nothing is shuffled.
    """
    if least_exponent < LEAST_EXPONENT:
        raise ValueError(f"runs of {LEAST_EXPONENT} periods or more only")

    def work(batches):
        for batch in batches:
            data, offsets = string_bytes(batch.column(1))
            for lo, hi in document_groups(offsets):
                texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(lo, hi)]
                runs, kept = zip(*_runs_of(texts, least_words, least_exponent))
                rows = np.concatenate(runs)
                ends = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
                struct = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(ends, struct), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    docs = docs.select("doc_id", "text")
    schema = StructType([docs.schema["doc_id"]]).add("runs", RUNS_TYPE).add("collapsed", "string")
    return docs.mapInArrow(work, schema)


def repeated_tails(text: str = "text", doc_id: str = "doc_id"):
    """Text whose words from word ``a`` on repeat the ``p`` words there, for ids whose crc32 is divisible by 10.

    With ``h = crc32(id)``, ``g = h / 10`` and ``n`` words, ``a = g % n`` and ``p = 1 + (n - a) / (3 + g % 8)`` in
    whole numbers. Other texts, those without words and those of a null id stay as they are.
    """
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))

    def repeat(ws):
        n, g = F.size(ws), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        again = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(ws, a + i % p))
        return F.when(n > 0, F.concat_ws(" ", F.slice(ws, F.lit(1), a), again)).otherwise(F.col(text))

    return F.when(h % 10 == 0, F.element_at(F.transform(F.array(words), repeat), 1)).otherwise(F.col(text))


def strongest(runs: str = "runs"):
    """The run of most periods (length / period, compared exactly), then smallest start, then smallest period."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"

    def better(best, run):
        more, as_many = run["length"] * best["period"], best["length"] * run["period"]
        earlier = (run["start"] < best["start"]) | ((run["start"] == best["start"]) & (run["period"] < best["period"]))
        return F.when(best.isNull() | (more > as_many) | ((more == as_many) & earlier), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(kind), better)
