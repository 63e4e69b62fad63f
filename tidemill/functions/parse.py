"""Record parsing: lenient JSON, two-stage change records, text lines, tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schemas import CDC_PAYLOAD

#: Java's whitespace class, spelt out so that other engines can use the same one.
WHITESPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"


def text_records(envelope: DataFrame, *keep: str) -> DataFrame:
    """Binary key and value as text, with the named envelope columns next to them."""
    return envelope.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), *keep
    )


def parse_json(text: Column, schema: T.DataType | str) -> Column:
    """Lenient parse: a wrong type or missing field becomes NULL, extra fields are dropped."""
    return F.from_json(text.cast("string"), schema, {"mode": "PERMISSIVE"})


def flatten(df: DataFrame, struct_col: str, *keep: str) -> DataFrame:
    """Fields of a struct next to the kept columns."""
    return df.select(*keep, f"{struct_col}.*")


def cdc_records(envelope: DataFrame) -> DataFrame:
    """First stage of a change feed: ``oc, ns, pk, va`` and the record's position.

    ``inline`` keeps a later filter above the parse; pushed below, it would
    parse every record a second time.
    """
    return envelope.select(
        F.inline(F.array(parse_json(F.col("value"), CDC_PAYLOAD))), "timestamp", "partition", "offset"
    )


def cdc_rows(changes: DataFrame, namespace: str, key_schema: T.StructType, value_schema: T.StructType) -> DataFrame:
    """Second stage: the changes of one target with its own key and value columns."""
    return (
        changes.where(F.col("ns") == namespace)
        .withColumn("pk", parse_json(F.col("pk"), key_schema))
        .withColumn("va", parse_json(F.col("va"), value_schema))
        .select("oc", "pk.*", "va.*", "timestamp", "partition", "offset")
    )


def header_texts(headers: Column) -> Column:
    """Headers with their binary values as text."""
    return F.transform(
        headers, lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))
    )


def first_header(headers: Column, name: str) -> Column:
    """Text of the first header called ``name``, NULL if there is none."""
    return F.get(F.filter(headers, lambda h: h["key"] == name), F.lit(0))["value"].cast("string")


def field(line: Column, position: int) -> Column:
    """Trimmed comma separated field, NULL if the line is too short."""
    return F.trim(F.get(F.split(line, ","), F.lit(position)))


def person_line(line: Column) -> list[Column]:
    """``name, age`` line."""
    return [field(line, 0).alias("name"), field(line, 1).try_cast("int").alias("age")]


def impression_line(line: Column) -> list[Column]:
    """``time, ad id, name`` line of a shown advertisement."""
    return _ad_line(line, "impression")


def click_line(line: Column) -> list[Column]:
    """``time, ad id, name`` line of a clicked advertisement."""
    return _ad_line(line, "click")


def _ad_line(line: Column, prefix: str) -> list[Column]:
    return [
        F.try_to_timestamp(field(line, 0)).alias(f"{prefix}_time"),
        field(line, 1).try_cast("int").alias(f"{prefix}_ad_id"),
        field(line, 2).alias("name"),
    ]


def timed_words(df: DataFrame, line: str = "value") -> DataFrame:
    """``time, w1 w2 ...`` lines to one row per word with the line's time."""
    return df.select(
        F.try_to_timestamp(field(F.col(line), 0)).alias("event_time"),
        F.explode(space_tokens(field(F.col(line), 1))).alias("word"),
    )


def space_tokens(text: Column) -> Column:
    """Split on every single space; empty tokens stay, except those at the end."""
    stripped = F.rtrim(text)
    no_words = F.array().cast("array<string>")
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(stripped == "", no_words)
        .otherwise(F.split(stripped, " "))
    )


def word_pieces(text: Column) -> Column:
    """Split on runs of whitespace; may hold an empty piece at either end, for callers that drop those later."""
    return F.split(text, WHITESPACE_RUN)


def words(text: Column) -> Column:
    """Split on runs of whitespace without empty words; NULL text has no words."""
    return F.filter(word_pieces(F.coalesce(text, F.lit(""))), lambda w: w != "")


def or_default(column: Column, default: str = "n/a") -> Column:
    """Default for a missing text field."""
    return F.coalesce(column, F.lit(default))


def dead_letter(orig_request: Column, failed_reason: Column) -> Column:
    """JSON text of a rejected record and the reason."""
    return F.to_json(F.struct(orig_request.alias("orig_request"), failed_reason.alias("failed_reason")))


def marked_incomplete(df: DataFrame, text: str, required: Sequence[str]) -> DataFrame:
    """All rows with a ``dead_letter`` made of their text where a required column is missing, else NULL."""
    missing = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name.split(".")[-1])) for name in required]))
    reason = F.concat(F.lit("missing or invalid: "), F.concat_ws(", ", missing))
    return df.withColumn("dead_letter", F.when(F.size(missing) > 0, dead_letter(F.col(text), reason)))


def split_incomplete(df: DataFrame, text: str, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns, and the others with a ``dead_letter`` made of their text."""
    marked = marked_incomplete(df, text, required)
    return marked.where(F.col("dead_letter").isNull()).drop("dead_letter"), marked.where(F.col("dead_letter").isNotNull())


def marked_rejects(df: DataFrame, text: str, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """Decoded JSON ``record`` of every row, and a ``dead_letter`` where it is no JSON object or lacks a required field.

    One frame for both kinds, so a job that writes both reads its input once.
    """
    decoded = df.withColumn("record", parse_json(F.col(text), schema))
    return marked_incomplete(decoded, text, [f"record.{name}" for name in required])


def split_rejects(
    df: DataFrame, text: str, schema: T.StructType, required: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The good and the bad rows of :func:`marked_rejects`; each half reads the input, persist it before."""
    marked = marked_rejects(df, text, schema, required)
    bad = F.col("dead_letter").isNotNull()
    return marked.where(~bad).drop("dead_letter"), marked.where(bad).drop("record")


def split_lines(
    df: DataFrame, columns: Sequence[Column], required: Sequence[str], text: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Parse text lines, such as with :func:`person_line`; lines that lack a field become dead letters."""
    good, bad = split_incomplete(df.select("*", *columns), text, required)
    return good.drop(text), bad.select(text, "dead_letter")


def checked_below(number: Column, limit: int = 10) -> Column:
    """The number itself when it is below ``limit``; fails the query otherwise."""
    return F.when(number < limit, number).when(
        number >= limit,
        F.raise_error(F.concat(F.lit(f"value is not below {limit}: "), number.cast("string"))).cast("int"),
    )
