"""Spelling variants: words one inserted, deleted or replaced code point apart, by a dictionary of trie node pairs.

The words form two tries, one of the words and one of their reversals. A node
of the first stands for a prefix, one of the second for a suffix; both are
numbered. A word cut at place ``i`` is the pair (prefix node, suffix node)
there, a *seam*. A word without the code point at ``i`` is the pair of the
nodes around it, a *hole*. Equal pairs are equal strings, so

* two holes with one pair are words that differ in one replaced code point,
* a hole and a seam with one pair are words of which the first has one more.

A pair has one seam at most, and its holes differ in the code point left out:
a group of equal pairs has at most one row per letter of the alphabet and one
more, however large the vocabulary. Neighbours are counted and the best of them
is chosen inside these groups; pairs of words are never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.frames import stored
from tidemill.session import cut

#: Letters of the Latin alphabet as the words of the query have them.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows that travel from Python to Spark at a time, counted in trie nodes.
NODES_A_BATCH = 1 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def letter_runs(docs: DataFrame, pattern: str = LETTERS) -> DataFrame:
    """``doc_id, run``: every maximal run of letters of every text, A-Z in lower case. A null text has none."""
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(pattern), F.lit(0))).alias("run"))


def with_slips(runs: DataFrame, one_in: int = 199) -> DataFrame:
    """``word``: each run, one code point left out where ``one_in`` divides the crc32 of ``doc_id:run``.

    A null doc_id counts as an empty one.
    """
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h = F.crc32(key.cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
    return runs.withColumn("h", h).withColumn("at", at).select(F.when(F.col("h") % one_in == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough. Counts are combined before the shuffle."""
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    most = min(len(a), len(b))
    for i in range(most):
        if a[i] != b[i]:
            return i
    return most


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the trie nodes of one sorted part: each word gets the numbers of its prefixes of length 0, 1, ...

    Nodes are numbered as they first appear; the path of the part's first word has the numbers 1, 2, ...
    """
    first, before, path, last = None, "", [0], 0
    names = ["part", "key", "word", "n", "path", "shared"]

    def flush(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names
        )

    kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int32()]
    rows, nodes = [], 0
    for batch in batches:
        for part, key, word, n in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "word", "n"))):
            if first is None:
                first = key
            depth = _shared(before, key)
            path = path[: depth + 1] + list(range(last + 1, last + 1 + len(key) - depth))
            last, before = last + len(key) - depth, key
            rows.append((part, key, word, n, path, _shared(first, key)))
            nodes += len(path)
            if nodes > NODES_A_BATCH:
                yield flush(rows)
                rows, nodes = [], 0
    if rows:
        yield flush(rows)


def trie_paths(words: DataFrame, key: Column, name: str) -> DataFrame:
    """``word, n, path``: numbers of the trie nodes of ``key``, from the root (0) to the whole key.

    The keys are ranged over sorted parts, and each part numbers its own nodes. Only nodes on the path of a part's first
    key can also belong to earlier parts. So one row per part (first key, last key and its path) goes to the driver, which
    follows these paths from part to part; its size is the number of shuffle partitions times the length of a word.
    Numbers grow with the order of the keys by code points and may have gaps.
    """
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = words.select(key.alias("key"), "word", "n").repartitionByRange(parts, "key").sortWithinPartitions("key")
    schema = "part int, key string, word string, n bigint, path array<bigint>, shared int"
    local = stored(ranged.withColumn("part", F.spark_partition_id()).mapInArrow(_paths, schema), name)
    edges = local.groupBy("part").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("path", "key").alias("path"),
        F.max_by("shared", "key").alias("shared"),
    )
    base, carried, before = 0, [], None
    for edge in edges.orderBy("part").collect():
        depth = _shared(before[0], edge["first"]) if before else 0
        start = [0] + (before[1][1 : depth + 1] if before else [])
        carried.append((edge["part"], base, start))
        path = [start[d] if d <= min(depth, edge["shared"]) else base + x for d, x in enumerate(edge["path"])]
        before, base = (edge["last"], path), base + max(edge["path"][-1], len(edge["first"]))
    carry = spark.createDataFrame(carried, "part int, base bigint, start array<bigint>")
    known = F.least("shared", F.size("start") - 1)
    numbered = F.transform("path", lambda x, d: F.when(d <= known, F.get("start", d)).otherwise(F.col("base") + x))
    # One row per shuffle partition.
    return local.join(F.broadcast(carry), "part").select("word", "n", numbered.alias("path"))


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n, id, n_near, best_id, best_n`` for distinct words ``word, n``.

    ``id`` numbers the words in code-point order; ``best_id`` is the near word of largest n, ties to the smallest in that
    order. Words without a near word have 0 and nulls.
    """
    forward = trie_paths(words, F.col("word"), "spelling-prefixes")
    backward = trie_paths(words, F.reverse("word"), "spelling-suffixes").select("word", F.col("path").alias("back"))
    both = forward.join(backward, "word").select(
        F.element_at("path", -1).alias("id"), "word", "n", "path", "back", F.split("word", "").alias("letters")
    )
    both = stored(both, "spelling-paths")
    size = F.size("path") - 1
    # A letter left out of several equal ones in a row gives one string: the last of them stands for all.
    holes = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.struct(
            F.get("path", i).alias("p"), F.get("back", size - 1 - i).alias("s"),
            (~F.get("letters", i).eqNullSafe(F.get("letters", i + 1))).alias("own"), F.lit(False).alias("seam"),
        ),
    )
    seams = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(
            F.get("path", i).alias("p"), F.get("back", size - i).alias("s"), F.lit(False).alias("own"), F.lit(True).alias("seam")
        ),
    )
    pairs = both.where(size > 0).select("id", "n", F.inline(F.concat(holes, seams)))
    group = Window.partitionBy("p", "s")
    shared = pairs.withColumn("rows", F.count(F.lit(1)).over(group)).where("rows > 1")
    every = group.orderBy(F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    word = F.struct("n", (-F.col("id")).alias("minus_id"))
    hole = F.when(~F.col("seam"), word)
    seen = shared.select(
        "id", "n", "own", "seam",
        F.count(hole).over(every).alias("holes"), F.count(F.when(F.col("own"), True)).over(every).alias("owns"),
        F.first(hole, ignorenulls=True).over(every).alias("best_hole"), F.nth_value(hole, 2, ignoreNulls=True).over(every).alias("next_hole"),
        F.first(F.when(F.col("own"), word), ignorenulls=True).over(every).alias("best_own"),
        F.first(F.when(F.col("seam"), word), ignorenulls=True).over(every).alias("the_seam"),
    )
    shorter = F.when(F.col("own"), F.col("the_seam"))
    other = F.when(F.col("best_hole")["minus_id"] == -F.col("id"), F.col("next_hole")).otherwise(F.col("best_hole"))
    per_group = seen.select(
        "id",
        F.when(F.col("seam"), F.col("owns")).otherwise(F.col("holes") - 1 + shorter.isNotNull().cast("int")).alias("near"),
        F.when(F.col("seam"), F.col("best_own")).otherwise(F.greatest(other, shorter)).alias("best"),
    )
    found = per_group.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    return both.select("id", "word", "n").join(found, "id", "left").select(
        "word", "n", "id", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        (-F.col("best")["minus_id"]).alias("best_id"), F.col("best")["n"].alias("best_n"),
    )


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for words and their counts ``word, n``.

    A word's ``form`` is its most frequent near word if that has at least ``ratio`` times the word's count, else null;
    ``root`` is where the forms end, the word itself if it has none. Ties go to the smallest word in code-point order.
    Repeated words of the input are added up first; null words, null counts and the empty word take no part. Other
    columns are ignored, an empty table gives an empty one. Words of any length are whole; the work is in proportion to
    their code points. Counts grow at least ``ratio``-fold along the forms, so roots are found in a few doublings.
    """
    words = words.where("word <> '' and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(words, "spelling-words")
    near = stored(neighbours(words), "spelling-near")
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_id"))
    named = near.select("word", "n", "id", "n_near", form.alias("form_id"), F.when(form.isNotNull(), F.col("best_n")).alias("form_n"))
    chains = cut(named.select("id", F.coalesce("form_id", "id").alias("root_id")))
    while True:
        ahead = chains.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        chains = cut(chains.join(ahead, "root_id").select("id", F.col("next_id").alias("root_id"), (F.col("next_id") != F.col("root_id")).alias("moved")))
        if not chains.where("moved").limit(1).count():
            break
        chains = chains.drop("moved")
    spelt = near.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    roots = near.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    return (
        named.join(spelt, "form_id", "left").join(chains.drop("moved"), "id").join(roots, "root_id")
        .select("word", "form", "root", "n", "n_near", "form_n")
    )


def variants_sql(least_length: int = 6, least_count: int = 5, one_in: int = 199, ratio: int = 5) -> str:
    """DuckDB SQL for the variant groups of ``documents``; crc32 is worked out byte by byte."""
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(0, 8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(0, 256)) AS b)
), runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents)
  GROUP BY ALL
), keyed AS (
  SELECT run, c, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x FROM runs
), hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
      lambda h, b: xor(h // 256, t[xor(h % 256, b) + 1]))) AS h
  FROM keyed, crc_table
), words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT CASE WHEN h % {one_in} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= {least_length} GROUP BY word HAVING sum(c) >= {least_count}
), holes AS (
  SELECT DISTINCT word, n, i, left(word, i) AS p, substr(word, i + 2) AS s
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION
  SELECT a.word, a.n, w.word, w.n FROM holes a JOIN words w ON a.p || a.s = w.word
  UNION
  SELECT w.word, w.n, a.word, a.n FROM holes a JOIN words w ON a.p || a.s = w.word
), near AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS best, max(other_n) AS best_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {ratio} * w.n THEN best END AS form,
    CASE WHEN best_n >= {ratio} * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT chain.word, f.form FROM chain JOIN forms f ON f.word = chain.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM forms f JOIN chain USING (word) JOIN forms r ON r.word = chain.at WHERE r.form IS NULL
"""
