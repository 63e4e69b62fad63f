"""The registered queries of this package: name to (builder, comparison SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import language, maxscore, mixing, periodic, secrets, shards, spelling, url_trees
from tidemill.llm.frames import documents
from tidemill.llm.merkle import fingerprints
from tidemill.llm.near_dedup import near_duplicates
from tidemill.llm.passages import repeated_passages
from tidemill.llm.pieces import decode_documents, encode_documents
from tidemill.llm.suffix_dedup import repeated_substrings

PIECE_MODEL, SHARDS = "piece_bpe_32k.model", 24


def piece_model(path: str | None = None) -> bytes:
    """Content of the model file, read on the driver and sent along with the tasks."""
    import public_tokenizers

    with open(path or public_tokenizers.path(PIECE_MODEL), "rb") as file:
        return file.read()


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_substrings(documents(spark, folder), 100).drop("removed")


def op2_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    model = piece_model()
    encoded = encode_documents(documents(spark, folder).select("doc_id", "text"), model, spans=True).select(
        "doc_id", "ids", F.xxhash64("begins", "ends").alias("spans_xxhash64")
    )
    return decode_documents(encoded, model).select(
        "doc_id", "spans_xxhash64",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_documents(documents(spark, folder), SHARDS).withColumn("law", F.lit("key"))


def op5_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(documents(spark, folder))


def op6_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return maxscore.top_k(vectors, F.col("vec_id") % 20 == 0, 20, 64)


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder), 3, 85)


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, folder).select("doc_id", "text"))
    base = len(secrets.BASE_RULES)
    ranks = F.transform("secrets", lambda s: s["rank"])
    counts = [
        F.size(F.array_compact(F.transform(ranks, lambda r: F.nullif(r == F.lit(rank), F.lit(False))))).cast("bigint").alias(f"n_{rule.kind}")
        for rank, rule in enumerate(secrets.BASE_RULES)
    ]
    own = F.filter("secrets", lambda s: s["rank"] < base)
    return found.select(
        "doc_id", *counts, F.sha2(secrets.joined(own), 256).alias("base_sha256"), secrets.joined(F.col("secrets")).alias("spans")
    )


def op9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(documents(spark, folder))


def op10_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "source", "lang")
    return mixing.mixed(docs, keep=mixing.KEPT_TOKENS).select(
        "doc_id", F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), F.round("_weight", 3).alias("weight"),
        F.round("_chance", 6).alias("chance"), F.col("_kept").alias("kept"),
        (F.col("_residual") < 1e-6).alias("settled"),
    )


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return url_trees.judge(pages, url_trees.learn(url_trees.labelled_by_rules(pages)))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    runs = spelling.letter_runs(documents(spark, folder))
    return spelling.variant_groups(spelling.vocabulary(spelling.with_slips(runs)))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", periodic.repeated_tails().alias("text"))
    best = periodic.strongest()
    found = periodic.periodic_runs(docs).withColumn("best", best)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_suffix_dedup": (op1_suffix_dedup, None),
    "op2_piece_encoding": (op2_piece_encoding, None),
    "op3_language": (op3_language, None),
    "op4_jump_shards": (op4_jump_shards, None),
    "op5_merkle_fingerprints": (op5_merkle_fingerprints, None),
    "op6_maxscore": (op6_maxscore, maxscore.top_k_sql()),
    "op7_near_dedup": (op7_near_dedup, None),
    "op8_secret_scan": (op8_secret_scan, secrets.secrets_sql()),
    "op9_passages": (op9_passages, None),
    "op10_mix": (op10_mix, mixing.mix_sql()),
    "op11_url_filter": (op11_url_filter, None),
    "op12_spelling_variants": (op12_spelling_variants, spelling.variants_sql()),
    "op13_periodic_runs": (op13_periodic_runs, None),
}
