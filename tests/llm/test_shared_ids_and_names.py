"""Shared and null ids against brute force, stages under clashing names, and workers without the package."""

import os
import random
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tidemill.llm import mixing, suffix_dedup
from tidemill.llm.near_dedup import near_duplicates
from tidemill.llm.suffix_dedup import repeated_substrings

ROOT = Path(__file__).resolve().parents[2]
DOCS = "doc_id bigint, text string"


def letters(rnd, n):
    return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n))


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_texts_of_one_id_do_not_take_each_other_for_themselves(spark, monkeypatch, broadcast):
    """No byte repeats inside or between these texts, whatever their hashes."""
    monkeypatch.setattr(suffix_dedup, "BROADCAST_RANKS", broadcast)
    rnd = random.Random(4)
    alone = [letters(rnd, 256) for _ in range(300)]
    shared = alone[0][:150]
    rows = [(None, t) for t in alone[:200]] + [(5, t) for t in alone[200:]] + [(None, alone[3]), (9, shared), (9, "x" + shared), (5, None)]
    got = repeated_substrings(spark.createDataFrame(rows, DOCS), 100).collect()
    assert len(got) == len(rows)
    assert sum(r.n_removed for r in got if r.doc_id != 9) == 0  # the repeated row of an id is the same document
    assert sorted((r.n_bytes, r.n_removed) for r in got if r.doc_id == 9) == [(150, 150), (151, 150)]


def test_near_copies_of_either_text_of_an_id_are_linked(spark):
    rnd = random.Random(3)
    texts = [[letters(rnd, 4) for _ in range(60)] for _ in range(2)]
    near = [" ".join(t[:-1] + ["other"]) for t in texts]
    rows = [(1, " ".join(t)) for t in texts] + [(7, near[0]), (8, near[1]), (9, "quite another text")]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(1, 1, True), (7, 1, False), (8, 1, False), (9, 9, True)}


def test_one_tiny_cell_changes_the_mix_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source", "lang")
    tiny = spark.createDataFrame([(10**6, "five words of another language", "src0", "xx")], docs.schema)
    shares = []
    for rows in (docs, docs.unionByName(tiny)):
        cells = mixing.mixed(rows, keep=mixing.KEPT_TOKENS).agg(
            (F.sum(F.col("_tokens") * F.col("_chance")) / F.sum("_tokens")).alias("share"), F.max("_residual").alias("residual")
        ).first()
        assert cells.residual < 1e-6
        shares.append(cells.share)
    assert abs(shares[0] - shares[1]) < 0.01 and abs(shares[0] - mixing.KEPT_TOKENS) < 0.01


OWN = ["_key", "_kinds", "_secrets", "_s", "_topic", "_kept", "_tokens", "_draw", "score", "rejected", "lang_pred", "_id", "_row", "_hash",
       "_nr", "_text", "h", "rep", "node", "key", "ids", "begins", "_chance", "_source", "_lang", "_weight", "_none"]


@pytest.mark.parametrize("name", ["language", "near_duplicates", "secrets", "mix"])
def test_stages_keep_columns_of_any_name(spark, data, name):
    """Odd rows and columns named like those inside the operators: values pass through."""
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(60)
    odd = spark.createDataFrame(
        [(None, None, None, None, 0), (900, "", "en", "s", 0), (901, "word " * 300_000, "en", None, 1), (902, "1 2 3", None, "s", 5),
         (903, "the same text of some words", "en", "s", 9), (903, "the same text of some words", "en", "s", 9)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs = docs.unionByName(odd).withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in OWN})
    result = dict(corpus_pipeline.STAGES)[name](spark, docs, data)
    assert result.columns == docs.columns
    rows = result.collect()
    assert rows
    for row in rows:
        mark = "-" if row.doc_id is None else str(row.doc_id)
        assert all(row[c] == c + mark for c in OWN)
    ids = [r.doc_id for r in rows]
    if name == "near_duplicates":
        assert ids.count(903) == 1 and {None, 900, 901, 902} <= set(ids)
    if name == "secrets":
        assert len(rows) == docs.count()
    if name == "language":
        assert not {None, 900, 902} & set(ids)


SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry_points
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())
spark.sparkContext.setLogLevel("OFF")
for name in sorted(n for n in entry_points.queries() if n.startswith("op")):
    assert entry_points.queries()[name](spark, sys.argv[2]).count() > 0
    print(name)
spark.stop()
print("done")
"""


def test_operators_run_where_workers_lack_the_package(tmp_path, data):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    result = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT), data, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert result.stdout.strip().endswith("done"), result.stdout + result.stderr[-2000:]
