"""Time buckets and conversions between timestamps and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A bucket is at most a day wide, and an epoch below this many
#: milliseconds is taken for seconds passed by mistake.
MAX_BUCKET_SECONDS = 86400
MIN_EPOCH_MILLIS = 20000000000

_ISO_WITH_ZONE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,9})?[+-]\d{2}:\d{2}$"


def bucket_seconds(ts: Column, width: int) -> Column:
    """Epoch second at which the bucket of ``ts`` starts."""
    seconds = F.unix_timestamp(ts)
    return seconds - F.pmod(seconds, F.lit(width))


def time_bucket(ts: Column, width: int) -> Column:
    """Start of the ``width`` second bucket that holds ``ts``."""
    return F.timestamp_seconds(bucket_seconds(ts, width))


def bucket_text(ts: Column, width: int) -> Column:
    """Bucket start as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(time_bucket(ts, width), "yyyy-MM-dd HH:mm:ss")


def guarded_bucket(epoch_millis: Column, width: int) -> Column:
    """Bucket start of an epoch in milliseconds; fails on seconds or on a width over a day."""
    if not 0 < width <= MAX_BUCKET_SECONDS:
        raise ValueError(f"bucket width must be within 1..{MAX_BUCKET_SECONDS} seconds, got {width}")
    checked = F.when(
        epoch_millis < MIN_EPOCH_MILLIS,
        F.raise_error(F.concat(F.lit("epoch is not in milliseconds: "), epoch_millis.cast("string"))).cast("bigint"),
    ).otherwise(epoch_millis)
    return time_bucket(F.timestamp_millis(checked), width)


def guarded_bucket_of(ts: Column, width: int) -> Column:
    """:func:`guarded_bucket` for a timestamp column."""
    return guarded_bucket(F.unix_millis(ts), width)


def iso_millis(text: Column) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm:ss[.fraction]+hh:mm``, NULL for any other text."""
    return F.when(text.rlike(_ISO_WITH_ZONE), F.unix_millis(F.try_to_timestamp(text)))


def shifted_millis(ts: Column, origin_millis: Column | int) -> Column:
    """Milliseconds since ``origin_millis`` as a double."""
    return (F.unix_millis(ts) - F.lit(origin_millis)).cast("double")


def from_shifted_millis(shift: Column, origin_millis: Column | int) -> Column:
    """Inverse of :func:`shifted_millis`."""
    return F.timestamp_millis(shift.cast("bigint") + F.lit(origin_millis))


def calendar_parts(ts: Column) -> list[Column]:
    """``day``, ``hour`` and ``minute`` columns used as folder keys by the ingest sinks."""
    return [F.to_date(ts).alias("day"), F.hour(ts).alias("hour"), F.minute(ts).alias("minute")]


def hex_id_seconds(hex_id: Column) -> Column:
    """Creation second held in the first eight hex digits of an id."""
    return F.conv(F.substring(hex_id, 1, 8), 16, 10).cast("bigint")


def to_hex(number: Column) -> Column:
    """Lower-case hex digits of a whole number."""
    return F.lower(F.hex(number.cast("bigint")))
