"""Periodic runs, spelling variants and URL filters against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from tidemill.llm import periodic, spelling, url_trees
from tidemill.llm.queries import QUERIES

DOCS = "doc_id bigint, text string"


def runs_of(words, least_words=6, exponent=4):
    """All runs by comparing words at every distance; the smallest period of each stretch."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        k = 0
        while k + q < len(words):
            j = k
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > k and j - k + q >= max(least_words, exponent * q):
                found.setdefault((k, j - k + q), q)
            k = max(j, k + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def kept_of(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def nested(rnd, depth=0):
    kind = rnd.randrange(6)
    if depth > 3 or kind == 0:
        return [rnd.choice("ab") for _ in range(rnd.randrange(1, 9))]
    if kind <= 3:
        part = nested(rnd, depth + 1)
        whole = part * rnd.randrange(2, 7)
        return whole[: len(whole) - rnd.randrange(len(part))]
    return nested(rnd, depth + 1) + nested(rnd, depth + 1)


@pytest.mark.parametrize("exponent", [3, 4])
def test_runs_equal_those_of_all_distances(exponent):
    rnd = random.Random(exponent)
    for _ in range(150):
        texts = [nested(rnd)[:300] for _ in range(rnd.randrange(1, 6))]
        got = list(periodic._runs_of([" ".join(t).encode() for t in texts], 6, exponent))
        for words, (runs, kept) in zip(texts, got):
            want = runs_of(words, 6, exponent)
            assert [tuple(r) for r in runs.tolist()] == want
            assert kept.decode().split() == kept_of(words, want)


def test_runs_of_large_periods_and_long_texts():
    rnd = random.Random(1)
    block = [f"w{rnd.randrange(10**6)}" for _ in range(20_000)]
    words = block * 4 + block[:7] + [f"x{i}" for i in range(500_000)] + ["é"] * 9
    (runs, kept), = periodic._runs_of([" ".join(words).encode()], 6, 4)
    assert runs.tolist() == [[0, 80_007, 20_000], [580_007, 9, 1]]
    assert len(kept.split()) == 20_000 + 500_000 + 1
    thue = [0]
    for _ in range(13):
        thue += [1 - x for x in thue]
    (runs, _), = periodic._runs_of([" ".join(map(str, thue)).encode()], 6, 3)
    assert not len(runs)


def test_periodic_rows_of_odd_tables(spark):
    rows = [(1, "a b a b a b a b"), (1, "a b a b a b a b"), (None, "x " * 9), (2, None), (3, ""), (4, " \t\n"), (5, "A a A a")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"runs": F.lit(1), "collapsed": F.lit("own"), "best": F.lit(2)})
    got = Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic.periodic_runs(docs).collect())
    assert got == Counter([
        (1, ((0, 8, 2),), "a b"), (1, ((0, 8, 2),), "a b"), (None, ((0, 9, 1),), "x"),
        (2, (), ""), (3, (), ""), (4, (), ""), (5, (), "A a A a"),
    ])
    assert periodic.periodic_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, least_exponent=2)


def test_op13_equals_plain_python(spark, data):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    some = 0
    for row in QUERIES["op13_periodic_runs"][0](spark, data).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[row.doc_id])
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = runs_of(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (len(runs), *best, milli)
        assert row.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert row.collapsed_sha256 == sha(" ".join(kept_of(words, runs)))
        some += bool(runs)
    assert some > 5


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts, ratio=5):
    order = lambda w: (-counts[w], w)
    links = {w: sorted((v for v in counts if near(w, v)), key=order) for w in counts}
    form = {w: v[0] if v and counts[v[0]] >= ratio * counts[w] else None for w, v in links.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), counts[w], len(links[w]), counts[form[w]] if form[w] else 0) for w in counts)


def groups(frame):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in frame.collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_variants_equal_those_of_all_pairs(spark, parts):
    rnd = random.Random(parts)
    words = {"".join(rnd.choice("aab𝒳é") for _ in range(rnd.randrange(1, 7))) for _ in range(250)}
    counts = {w: rnd.choice([1, 2, 5, 10, 25, 125, 700]) for w in words}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = groups(spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n bigint")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain_groups(counts)


def test_variants_of_odd_tables(spark):
    long = "ab" * 4000
    rows = [("x", 3, 1), ("x", 2, 1), (None, 9, 1), ("", 9, 1), ("y", None, 1), ("xy", 1, 1), (long, 50, 1), (long[:-1], 2, 1)]
    words = spark.createDataFrame(rows, "word string, n bigint, id int").withColumns({c: F.lit("own") for c in ("path", "best", "p")})
    assert groups(spelling.variant_groups(words)) == plain_groups({"x": 5, "xy": 1, long: 50, long[:-1]: 2})
    assert groups(spelling.variant_groups(words.where("false"))) == []


def test_words_of_texts(spark):
    rows = [(7, "Straße ÀB ab×C l'x ſ"), (None, "Ab"), (8, None), (9, "")]
    runs = spelling.letter_runs(spark.createDataFrame(rows, DOCS))
    assert Counter((r.doc_id, r.run) for r in runs.collect()) == Counter(
        [(7, "straße"), (7, "Àb"), (7, "ab×c"), (7, "l"), (7, "x"), (None, "ab")]
    )
    slips = [r.word for r in spelling.with_slips(runs.where("doc_id = 7"), 1).collect()]
    want = []
    for run in ("straße", "Àb", "ab×c", "l", "x"):
        at = zlib.crc32(f"7:{run}".encode()) % len(run)
        want.append(run[:at] + run[at + 1 :])
    assert sorted(slips) == sorted(want)


URLS = [
    (1, "http://Example.COM/en/a?b=1#c", "example.com", "/en/a", "example.com/en/", "block"),
    (2, "https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    (3, "https://a.www.example.com/en/x", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (4, "ftp://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
    (5, "http://x.net/fr/?q=/es/", "x.net", "/fr/", "net/fr/", "block"),
    (6, "http://x.net?u=http://y.com/", "x.net", "", None, None),
    (7, "x.com/en/", "", "", None, None),
    (8, None, "", "", None, None),
    (9, "", "", "", None, None),
    (10, "http://example.com", "example.com", "", None, None),
    (11, "a#b://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
    (12, "http://" + "d/" * 20000, "d", "/" + "d/" * 19999, None, None),
]


def test_rules_and_odd_urls(spark):
    pages = spark.createDataFrame([(i, u, "own", 1) for i, u, *_ in URLS], "page_id bigint, url string, host string, score int")
    model = url_trees.learn(url_trees.labelled_by_rules(pages))
    got = {r.page_id: r for r in url_trees.judge(pages, model).collect()}
    assert len(got) == len(URLS)
    for page_id, _, host, path, rule, verdict in URLS:
        row = got[page_id]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert url_trees.judge(pages.where("false"), model).count() == 0


@pytest.mark.parametrize("blocked, verdict", [([], "allow"), ([True, True], "block"), ([False], "allow"), ([None], "allow")])
def test_without_both_labels(spark, blocked, verdict):
    labelled = spark.createDataFrame([(f"http://a.b/{i}", b) for i, b in enumerate(blocked)], "url string, blocked boolean")
    pages = spark.createDataFrame([(1, "http://z/"), (1, "http://z/")], "page_id bigint, url string")
    assert [r.verdict for r in url_trees.judge(pages, url_trees.learn(labelled), ()).collect()] == [verdict] * 2


def test_features_of_urls(spark):
    url = "https://ab.ab/a1/b.html?x=1&y=2#t"
    table = spark.createDataFrame([(url,)], "url string")
    host, path = url_trees.host_of(F.col("url")), url_trees.path_of(F.col("url"))
    row = table.select(*[c.alias(n) for n, c in url_trees.lexical_features(F.col("url"), host, path).items()]).first()
    assert (row.depth, row.parameters, row.labels, row.fragment, row.host_length) == (2, 2, 2, 1, 5)
    assert row.digits == pytest.approx(3 / len(url)) and row.host_entropy == pytest.approx(0.8 * 1.3219280948873623 + 0.2 * 2.321928094887362)
    suffix = table.select(*[c.alias(n) for n, c in url_trees.suffixes(host, path).items()]).first()
    assert tuple(suffix) == ("ab", "ab.ab", "ab.ab", "a1", "html")


def test_trees_on_urls_they_have_not_seen(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    labelled = url_trees.labelled_by_rules(pages)
    held = F.crc32(F.col("url").cast("binary")) % 4 == 0
    model = url_trees.learn(labelled.where(~held))
    test = labelled.where(held).select(F.col("blocked").alias("page_id"), "url")
    rows = [(r.page_id, r.verdict == "block") for r in url_trees.judge(test, model, ()).collect()]
    assert len(rows) > 200 and sum(a == b for a, b in rows) / len(rows) > 0.97


def test_op11_has_every_page_and_is_stable(spark, data):
    build = QUERIES["op11_url_filter"][0]
    rows = sorted(map(tuple, build(spark, data).collect()), key=str)
    assert rows == sorted(map(tuple, build(spark, data).collect()), key=str)
    assert len(rows) == spark.read.parquet(f"{data}/pages.parquet").count()
