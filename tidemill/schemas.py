"""Explicit schemas of the records the jobs read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

HEADER = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
])

#: Record as a Kafka source delivers it.
KAFKA_ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

KAFKA_ENVELOPE_WITH_HEADERS = T.StructType(
    [*KAFKA_ENVELOPE.fields, T.StructField("headers", T.ArrayType(HEADER))]
)

#: Outer change record; ``pk`` and ``va`` are JSON texts of the target's own schema.
CDC_PAYLOAD = T.StructType([
    T.StructField("oc", T.StringType()),
    T.StructField("ns", T.StringType()),
    T.StructField("pk", T.StringType()),
    T.StructField("va", T.StringType()),
])

EMPLOYEE = T.StructType([
    T.StructField("emp_id", T.IntegerType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
])

API_EVENT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("params", T.StringType()),
])

SUM_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.LongType()),
])

COMMAND = T.StructType([
    T.StructField("topic_name", T.StringType()),
    T.StructField("operation", T.StringType()),
])

PERSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
])


def rows(spark: SparkSession, values: list, schema: T.StructType | str) -> DataFrame:
    """Typed table from literals; an empty list gives an empty typed table."""
    return spark.createDataFrame(values, schema)


