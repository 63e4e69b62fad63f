"""Merkle trees: what the descent finds against plain comparison of phrases, and shared ids against brute force."""

import hashlib
import random

import pytest
from tidemill.llm.merkle import KINDS, Tree, _bounds, edited_places, fingerprints

DOCS = "doc_id bigint, text string"
WORDS = [f"w{i}" for i in range(40)]


def a_text(rnd, words=WORDS, sections=4):
    def line():
        return ". ".join(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 14))) for _ in range(rnd.randint(1, 4)))

    return rnd.choice(["\n\n", "\n \t\n", "\n\n\n"]).join(
        "\n".join(line() for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(0, sections))
    )


def leaves(text):
    tree = Tree(text)
    starts = tree.first[-1]
    return [text[b:e] for b, e in zip(starts, starts[1:])]


def longest_common(old, new):
    """Most characters that phrases in the same order can share, by the quadratic table."""
    best = [0] * (len(new) + 1)
    for phrase in old:
        row = [0]
        for j, other in enumerate(new):
            row.append(max(best[j + 1], row[j], best[j] + len(phrase) if phrase == other else 0))
        best = row
    return best[-1]


def edited(rnd, text):
    at = rnd.randrange(len(text) + 1)
    return rnd.choice([
        text[:at] + rnd.choice(["new", " ", "\n", "\n\n", "new words. And more"]) + text[at:],
        text[:at] + text[at + rnd.randint(1, 60):],
        text[at:] + text[:at],
    ])


def test_leaves_are_the_whole_text():
    rnd = random.Random(1)
    for text in ["", "\n", " ", "a", "...", "?!\n\n\n  ", "no end\n", "\r\n\r\nx", "\x00\x85\u2028 y"] + [a_text(rnd) for _ in range(200)]:
        assert "".join(leaves(text)) == text
        tree = Tree(text)
        for kind in range(len(KINDS)):
            assert tree.span(kind, 0, len(tree.hashes[kind])) == (0, len(text))


def test_equal_roots_are_equal_texts():
    rnd = random.Random(2)
    for _ in range(400):
        old = a_text(rnd, WORDS[:3], 3)
        new = edited(rnd, old)
        assert (Tree(old).root == Tree(new).root) == (old == new) == (Tree(old).likeness(Tree(new)) == 1.0) == (edited_places(old, new) == [])
    assert Tree("Alpha beta.\n\nGamma.").likeness(Tree("Alpha beta.\n \nGamma.")) < 1
    assert edited_places("Alpha beta.\n\nGamma.", "Alpha beta.\n \nGamma.")[-1] == ("phrase", 12, 13)
    assert Tree("").likeness(Tree("")) == 1.0 and Tree("").likeness(Tree("a")) == Tree("a").likeness(Tree("")) == 0.0


@pytest.mark.parametrize("words", [WORDS[:3], WORDS, [f"u{i}" for i in range(100_000)]])
def test_likeness_against_brute_force(words):
    rnd = random.Random(3)
    exact = 0
    for _ in range(300):
        old = a_text(rnd, words)
        new = edited(rnd, old)
        forced = longest_common(leaves(old), leaves(new)) / (max(len(old), len(new)) or 1) if old or new else 1.0
        got = Tree(old).likeness(Tree(new))
        assert got <= forced + 1e-9
        exact += abs(got - forced) < 1e-9
    assert exact >= (270 if len(words) > 40 else 150)


def test_closed_branches_are_equal_and_places_cover_all_changes():
    rnd = random.Random(4)
    for _ in range(300):
        old = a_text(rnd)
        new = edited(rnd, old)
        before, after = Tree(old), Tree(new)
        runs = before.differences(after)[-1]
        ends = [(0, 0, 0, 0), *runs, (len(before.hashes[-1]),) * 2 + (len(after.hashes[-1]),) * 2]
        for (_, b, _, d), (a, _, c, _) in zip(ends, ends[1:]):  # between two runs, both texts are the same
            assert old[slice(*before.span(2, b, a))] == new[slice(*after.span(2, d, c))]


def by_force(rows):
    texts = sorted((d if d is not None else -(2**63), t or "") for d, t in rows)
    out = {}
    for (doc, text), (_, after) in zip(texts, [*texts[1:], texts[0]]):
        cut = len(text) // 4
        changed = text[: len(text) - cut] + after[:cut]
        out[doc if doc != -(2**63) else None] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), Tree(text).root.hex(), Tree(changed).root.hex(),
            Tree(text).likeness(Tree(changed)), Tree(text).likeness(Tree(after)),
        )
    return out


COLUMNS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_rows_against_brute_force(spark, parts):
    rnd = random.Random(5)
    rows = [(3 * i - 50, a_text(rnd)) for i in range(120)] + [(None, "no id"), (1000, None), (1001, ""), (1002, "x y. " * 100_000)]
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in fingerprints(spark.createDataFrame(rows, DOCS), parts).collect()}
    assert got == by_force(rows)


def test_rows_of_one_id_spread_over_ranges(spark):
    """Each row is followed by one of its own id (or the next), and no range holds most of a hot id."""
    rows = [(None, f"text {i}") for i in range(3000)] + [(7, f"seven {i}") for i in range(500)] + [(8, "eight")] * 20
    frame = spark.createDataFrame(rows, DOCS)
    got = fingerprints(frame, 16).collect()
    assert len(got) == len(rows) and sorted(Tree(t).root.hex() for _, t in rows) == sorted(r.fingerprint for r in got)
    assert sum(r.near_next == 1.0 for r in got) >= 19  # repeated rows follow each other

    from pyspark.sql import functions as F
    from tidemill.llm.merkle import _range_of

    keyed = frame.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"), F.xxhash64("text").alias("tie"))
    bounds = _bounds(keyed, 16)
    assert len(bounds) == 15 and bounds == sorted(bounds)
    placed = keyed.select("doc", "tie", _range_of(bounds).alias("r")).collect()
    assert all(p.r == sum(b < (p.doc, p.tie) for b in bounds) for p in placed)
    sizes = [sum(p.r == r for p in placed) for r in range(16)]
    assert max(sizes) < 2 * len(rows) / 16
