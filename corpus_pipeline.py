"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm import language, mixing, secrets
from tidemill.llm.frames import documents, id_or_mark, stored
from tidemill.llm.near_dedup import near_duplicates
from tidemill.llm.pieces import encode_documents
from tidemill.llm.queries import piece_model

#: Share of the tokens that is expected to stay after mixing, whatever the cells are.
KEPT_TOKENS = 0.5


def set_aside(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns as they are and all others inside ``_row``, where no name can clash with an operator's own."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used] or [F.lit(None).alias("_none")]
    return docs.select(*[c for c in used if c in docs.columns], F.struct(*others).alias("_row"))


def put_back(kept: DataFrame, docs: DataFrame, *used: str, changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``docs`` from rows that were set aside, some of them changed."""
    changed = changed or {}
    return kept.select(*[
        (changed[c] if c in changed else F.col(c) if c in used else F.col("_row")[c]).alias(c) for c in docs.columns
    ])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models of these documents don't reject.

    Null texts and texts without a letter are rejected. Without any learned language all others stay. Rows are judged one
    by one, so repeated rows, null ids and ties need no rule; all columns keep their values, whatever their names.
    """
    model = language.learn(docs.select("doc_id", "text", "lang"))
    judged = language.identify(set_aside(docs, "doc_id", "text"), model)
    return put_back(judged.where(~F.col("rejected")), docs, "doc_id", "text")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    The smallest doc_id of a group stays. Rows that share an id are one document to the groups; of those that also share
    their text one stays, the first by its other columns' hash. Null ids count as the smallest id, and each of
    their different texts stays. Texts without words are in no group.
    """
    kept = near_duplicates(docs.select("doc_id", "text"), 5, 80).where("kept").select(id_or_mark().alias("_key")).distinct()
    rows = set_aside(docs, "doc_id", "text").withColumns({"_key": id_or_mark(), "_hash": F.xxhash64("text")})
    stays = rows.join(kept, "_key", "left_semi")
    first = Window.partitionBy("_key", "_hash").orderBy(F.xxhash64("_row"))
    return put_back(stays.withColumn("_nr", F.row_number().over(first)).where("_nr = 1"), docs, "doc_id", "text")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and n_chars counted again where there was one.

    Null and empty texts have no secrets and stay as they are, as do all other columns whatever their names; repeated
    rows are treated alike.
    """
    found = secrets.find_secrets(set_aside(docs, "doc_id", "text"), name="_secrets")
    text = secrets.redacted(F.col("text"), F.col("_secrets"))
    hit = F.size("_secrets") > 0
    changed = {"text": F.when(hit, text).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(hit, F.length(text).cast("bigint")).otherwise(F.col("_row")["n_chars"])
    return put_back(found, docs, "doc_id", "text", changed=changed)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that the tokens of sources, languages and topics come to their target weights as near as
    supply allows, and ``KEPT_TOKENS`` of all tokens stay.

    Null sources and languages are values of their own; documents without words stay. Rows of one id share their draw.
    Columns keep their values, whatever their names.
    """
    used = ("doc_id", "text", "source", "lang")
    return put_back(mixing.mixed(set_aside(docs, *used), keep=KEPT_TOKENS).where("_kept"), docs, *used)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, ids``: the piece ids of every document, the end id last.

    Null and empty texts have the end id alone; other columns are dropped.
    """
    return encode_documents(docs.select("doc_id", "source", "lang", "text"), piece_model()).select("doc_id", "source", "lang", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("secrets", without_secrets),
    ("mix", mixed_sources),
    ("encode", encoded),
]

#: Language models and near-duplicate trees have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
