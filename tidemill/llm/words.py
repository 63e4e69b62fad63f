"""Words and word shingles of Arrow text columns as arrays of hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemill.llm.bytesmath import BYTE_VALUES, Prefix, U, mix

#: Bytes worked on at a time.
BLOCK = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER_VALUES = BYTE_VALUES[_LOWER]
_PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


def document_groups(offsets: np.ndarray, limit: int = 2 * BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end, hash and document of all words: runs without ASCII white space, A-Z in lower case."""
    blank = _BLANK[data]
    begins, ends = ~blank, ~blank
    begins[1:] &= blank[:-1]
    ends[:-1] &= blank[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= ~blank[edges]
    ends[edges - 1] |= ~blank[edges - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(begin), np.uint64)
    lo = 0
    while lo < len(begin):
        hi = max(lo + 1, int(np.searchsorted(end, begin[lo] + BLOCK, side="right")))
        first = begin[lo]
        prefix = Prefix(_LOWER_VALUES[data[first : end[hi - 1]]])
        hashes[lo:hi] = mix(prefix.of(begin[lo:hi] - first, end[lo:hi] - first) + (end[lo:hi] - begin[lo:hi]).astype(np.uint64))
        lo = hi
    return begin, end, hashes, np.searchsorted(offsets, begin, side="right") - 1


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += mix(hashes[i : i + n] ^ U(i + 1)) * U(_PLACES[i % len(_PLACES)] + 2 * (i // len(_PLACES)))
    return mix(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Per document its sorted distinct shingles; all words as one if there are fewer than ``size``."""
    for lo, hi in document_groups(offsets):
        part = data[offsets[lo] : offsets[hi]]
        _, _, hashes, doc = words(part, offsets[lo : hi + 1] - offsets[lo])
        every = shingles(hashes, size)
        bounds = np.searchsorted(doc, np.arange(hi - lo + 1))
        for b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if e - b >= size:
                yield np.unique(every[b : e - size + 1])
            elif e > b:
                yield shingles(hashes[b:e], e - b)
            else:
                yield np.zeros(0, np.uint64)
