"""Document fingerprints: a Merkle tree over phrases, paragraphs and sections.

Leaves are phrases (up to eight words of a sentence), their parents paragraphs (lines), theirs sections (paragraphs up to and with an empty line).
Every character, blanks and line ends too, is in one leaf, so equal roots mean equal texts. Where two roots differ, only branches that differ
are opened, pair by pair, down to the edited phrases.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.frames import id_or_mark, mark_to_null, text_or_empty

_SECTIONS = re.compile(r"\n(?:[^\S\n]*\n)+")
_PARAGRAPHS = re.compile(r"[^\n]*\n|[^\n]+")
_SENTENCES = re.compile(r"[^.!?]*[.!?]+\s*|[^.!?]+")
_PHRASES = re.compile(r"\s*(?:\S+\s*){1,8}|\s+")

#: Kinds of nodes below the root, from the top; children of the last are none.
KINDS = ("section", "paragraph", "phrase")


def _hash(kind: bytes, parts: list[bytes]) -> bytes:
    return hashlib.blake2b(kind + b"".join(parts), digest_size=16).digest()


#: The end of a line is a leaf of its own.
_LINE_END = _hash(b"leaf", [b"\n"])


def _sections(text: str) -> Iterator[str]:
    begin = 0
    for gap in _SECTIONS.finditer(text):
        yield text[begin : gap.end()]
        begin = gap.end()
    if begin < len(text):
        yield text[begin:]


class Tree:
    """The tree of one text: the root's hash and, per kind of node, all hashes in order and where each node's children begin.

    ``first[k][i]`` is the first child of node ``i`` of kind ``k``, for phrases their first character; the last entry ends the list.
    """

    def __init__(self, text: str):
        sections, paragraphs, phrases = [], [], []
        of_section, of_paragraph, lengths = [0], [0], []
        for section in _sections(text):
            in_section = len(paragraphs)
            for paragraph in _PARAGRAPHS.findall(section):
                in_paragraph = len(phrases)
                ended = paragraph.endswith("\n")
                for sentence in _SENTENCES.findall(paragraph[:-1] if ended else paragraph):
                    for phrase in _PHRASES.findall(sentence):
                        phrases.append(_hash(b"leaf", [phrase.encode()]))
                        lengths.append(len(phrase))
                if ended:
                    phrases.append(_LINE_END)
                    lengths.append(1)
                paragraphs.append(_hash(b"paragraph", phrases[in_paragraph:]))
                of_paragraph.append(len(phrases))
            sections.append(_hash(b"section", paragraphs[in_section:]))
            of_section.append(len(paragraphs))
        self.hashes = (sections, paragraphs, phrases)
        self.first = (of_section, of_paragraph, [0, *accumulate(lengths)])
        self.n_chars = len(text)
        self.root = _hash(b"root", sections)

    def span(self, kind: int, begin: int, end: int) -> tuple[int, int]:
        """Characters of the nodes ``begin`` to ``end`` (exclusive) of one kind."""
        for first in self.first[kind:]:
            begin, end = first[begin], first[end]
        return begin, end

    def differences(self, new: Tree) -> list[list[tuple[int, int, int, int]]]:
        """Per kind, the runs of nodes ``(old begin, old end, new begin, new end)`` that differ.

        Roots that differ open all sections; nodes of equal hash that keep their order are closed, and the runs between them
        are opened in pairs: the children of the old run against those of the new.
        """
        found: list[list[tuple[int, int, int, int]]] = []
        runs = [] if self.root == new.root else [(0, len(self.hashes[0]), 0, len(new.hashes[0]))]
        for kind in range(len(KINDS)):
            if kind:
                old_first, new_first = self.first[kind - 1], new.first[kind - 1]
                runs = [(old_first[a], old_first[b], new_first[c], new_first[d]) for a, b, c, d in runs]
            opened = []
            for a, b, c, d in runs:
                for i, j in [*_kept(self.hashes[kind], new.hashes[kind], a, b, c, d), (b, d)]:
                    if i > a or j > c:
                        opened.append((a, i, c, j))
                    a, c = i + 1, j + 1
            found.append(opened)
            runs = opened
        return found

    def likeness(self, other: Tree) -> float:
        """Share of characters in branches that both have in the same order: 1 for equal roots only."""
        largest = max(self.n_chars, other.n_chars)
        return self.likeness_by(other, self.differences(other)[-1]) if largest else 1.0

    def likeness_by(self, other: Tree, phrases: list[tuple[int, int, int, int]]) -> float:
        starts = self.first[-1]
        largest = max(self.n_chars, other.n_chars)
        return (self.n_chars - sum(starts[b] - starts[a] for a, b, _, _ in phrases)) / largest if largest else 1.0


def _kept(old: list[bytes], new: list[bytes], a: int, b: int, c: int, d: int) -> list[tuple[int, int]]:
    """Pairs of equal nodes in ``old[a:b]`` and ``new[c:d]`` that rise in both: common begin and end, between them the
    longest rising chain of pairs that join a hash's n-th place in one with its n-th place in the other."""
    head, tail = [], []
    while a < b and c < d and old[a] == new[c]:
        head.append((a, c))
        a, c = a + 1, c + 1
    while a < b and c < d and old[b - 1] == new[d - 1]:
        b, d = b - 1, d - 1
        tail.append((b, d))
    if a == b or c == d:
        return head + tail[::-1]
    places = defaultdict(list)
    for j in range(d - 1, c - 1, -1):
        places[new[j]].append(j)
    pairs = [(i, places[old[i]].pop()) for i in range(a, b) if places.get(old[i])]
    ends: list[int] = []  # ends[n]: least new place that a chain of n + 1 pairs can end with
    last: list[int] = []  # the pair it is
    before = [-1] * len(pairs)
    for nr, (_, j) in enumerate(pairs):
        n = bisect_left(ends, j)
        before[nr] = last[n - 1] if n else -1
        ends[n : n + 1], last[n : n + 1] = [j], [nr]
    chain, nr = [], last[-1] if last else -1
    while nr >= 0:
        chain.append(pairs[nr])
        nr = before[nr]
    return head + chain[::-1] + tail[::-1]


def edited_places(old: str, new: str) -> list[tuple[str, int, int]]:
    """Places of ``new`` as ``(kind, begin, end)`` in branches that differ from ``old``, largest kinds first.

    Each node of a run that differs is a place; a run that is only left out is one empty place where it was.
    """
    after = Tree(new)
    found = []
    for kind, runs in enumerate(Tree(old).differences(after)):
        for _, _, begin, end in runs:
            nodes = [(i, i + 1) for i in range(begin, end)] or [(begin, begin)]
            found += [(KINDS[kind], *after.span(kind, *node)) for node in nodes]
    return found


RESULT = (
    "doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_edited_places int, edited_begin long, edited_end long"
)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row and the one after it, in order; the row with ``_head`` set only follows."""
    before = None
    for batch in batches:
        rows = []
        for doc, text, head in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "_head"))):
            tree = Tree(text)
            if before is not None:
                old_doc, old, old_tree = before
                cut = len(old) // 4
                edited = old[: len(old) - cut] + text[:cut]
                changed = Tree(edited) if cut else old_tree
                phrases = old_tree.differences(changed)[-1]
                begin, end = (changed.first[-1][phrases[0][2]], changed.first[-1][phrases[-1][3]]) if phrases else (None, None)
                rows.append((
                    old_doc, len(old), hashlib.sha256(edited.encode()).hexdigest(), old_tree.root.hex(), changed.root.hex(),
                    old_tree.likeness_by(changed, phrases), old_tree.likeness(tree),
                    sum(max(d - c, 1) for _, _, c, d in phrases), begin, end,
                ))
            before = None if head else (doc, text, tree)
        if rows:
            names = [f.split()[0] for f in RESULT.split(", ")]
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _bounds(rows: DataFrame, parts: int) -> list[tuple[int, int]]:
    """Up to ``parts - 1`` bounds of ranges of (doc, tie) with about as many rows each.

    Quantiles of the ids; where one id spans several of them, its ties, which are hashes, are cut evenly instead.
    """
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("doc", shares, 10_000)).first()[0] or []  # as many numbers as ranges
    bounds = []
    for doc, times in sorted(Counter(cuts).items()):
        bounds += [(doc, -(2**63) + 2**64 * nr // times - 1) for nr in range(1, times)] + [(doc, 2**63 - 1)]
    return bounds


def _range_of(bounds: list[tuple[int, int]]) -> Column:
    """How many bounds lie below (doc, tie), by halving steps."""
    if not bounds:
        return F.lit(0)
    docs, ties = F.array(*(F.lit(d) for d, _ in bounds)), F.array(*(F.lit(t) for _, t in bounds))
    steps = [2**k for k in reversed(range(len(bounds).bit_length()))]

    def step(at: Column, width: Column) -> Column:
        doc, tie = F.get(docs, at + width - 1), F.get(ties, at + width - 1)  # null beyond the last bound
        below = (doc < F.col("doc")) | ((doc == F.col("doc")) & (tie < F.col("tie")))
        return F.when(below, at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how alike fingerprints are.

    The edited text has its last quarter of characters (rounded down) replaced by as many first ones of the next
    document in order of doc_id (all of it, if it is shorter); the first document follows the last. Columns: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_edited_places (phrases that the
    descent finds edited; a run left out counts once), edited_begin and edited_end (from the first to the last of them
    in the edited text; null if there is none).

    Texts move once, into ranges of doc_id and the text's hash; the first document of each range also goes to the end of
    the range before, so every task sees each document's successor. A task holds two documents. Null texts are empty,
    and empty texts are 1.0 like one another. Rows that share a doc_id follow one another by a hash of the text, in as
    many ranges as their number asks for; repeated rows stay together. A null doc_id comes first. A single document
    follows itself. Columns other than doc_id and text are left out, whatever they are called.
    """
    parts = parts or max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(id_or_mark().alias("doc"), text_or_empty().alias("text")).withColumn("tie", F.xxhash64("text"))
    placed = rows.withColumn("range", _range_of(_bounds(rows, parts)))
    # The first row of every range, by id and tie: as many rows as ranges.
    heads = placed.groupBy("range").agg(F.min(F.struct("doc", "tie")).alias("h")).select("range", "h.doc", "h.tie").collect()
    if not heads:
        return docs.sparkSession.createDataFrame([], RESULT.replace("doc ", "doc_id ", 1))
    heads = sorted(heads)
    follows = [(before.range, head.doc, head.tie) for before, head in zip([heads[-1], *heads[:-1]], heads)]
    follow = docs.sparkSession.createDataFrame(follows, "to int, doc long, tie long")
    copies = (
        rows.join(F.broadcast(follow), ["doc", "tie"]).dropDuplicates(["to"])
        .select("doc", "text", "tie", F.col("to").alias("range"), F.lit(True).alias("_head"))
    )
    stream = placed.withColumn("_head", F.lit(False)).unionByName(copies)
    return (
        stream.repartitionById(parts, "range").sortWithinPartitions("range", "_head", "doc", "tie").select("doc", "text", "_head")
        .mapInArrow(_compared, RESULT)
        .withColumn("doc", mark_to_null("doc")).withColumnRenamed("doc", "doc_id")
    )
