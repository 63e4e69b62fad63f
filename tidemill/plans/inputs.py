"""Record feeds that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.predicates import Segment, like_any, with_test_variants
from tidemill.sources.tables import table

TOPIC = "events"


def cents(amount: str) -> Column:
    """Money as a whole number, so that sums do not depend on row order."""
    return F.round(F.col(amount) * 100).cast("bigint")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("cents", cents("value"))


def envelope(spark: SparkSession, folder: str) -> DataFrame:
    return envelope_of(events(spark, folder))


def envelope_of(rows: DataFrame) -> DataFrame:
    """Events as Kafka records on three partitions."""
    value = F.struct(
        F.col("event_type").alias("name"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("cents").alias("value"),
        F.col("props").alias("params"),
    )
    return rows.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(value).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.array(
            F.struct(F.lit("header1").alias("key"), F.col("event_type").cast("binary").alias("value"))
        ).alias("headers"),
    )


PAYLOAD = "name string, user_id string, value bigint, params string"

NAMESPACE = "shop.orders"


def order_target(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a table that a change feed updates; orders in status P are not in it yet."""
    return (
        table(spark, folder, "orders")
        .where(F.col("o_orderstatus") != "P")
        .select("o_orderkey", F.col("o_orderstatus").alias("status"), cents("o_totalprice").alias("cents"))
    )


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    return order_changes_of(table(spark, folder, "orders"))


def order_changes_of(orders: DataFrame) -> DataFrame:
    """Change records of the orders: one each, a later second one for every seventh."""
    key = F.col("o_orderkey")
    op = F.when(key % 5 == 0, "D").when(key % 5 <= 2, "U").otherwise("I")

    def change(oc: Column, status: str, extra: int, when: Column, nr: int) -> Column:
        return F.struct(
            F.to_json(
                F.struct(
                    oc.alias("oc"),
                    F.when(key % 11 == 0, "shop.other").otherwise(NAMESPACE).alias("ns"),
                    F.to_json(F.struct(key)).alias("pk"),
                    F.to_json(
                        F.struct(F.lit(status).alias("status"), (F.col("c") + extra).alias("cents"))
                    ).alias("va"),
                )
            ).cast("binary").alias("value"),
            when.alias("timestamp"),
            (key * 2 + nr).alias("offset"),
        )

    first = change(op, "X", 1, F.col("o_orderdate"), 0)
    second = change(F.lit("U"), "Y", 2, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), 1)
    feed = F.when(key % 7 == 0, F.array(first, second)).otherwise(F.array(first))
    return (
        orders.select("o_orderkey", "o_orderdate", cents("o_totalprice").alias("c"))
        .select(F.explode(feed).alias("r"), (key % 3).cast("int").alias("partition"))
        .select("r.*", "partition")
    )


def event_segments() -> list[Segment]:
    """Segments of the event table, with and without test users."""
    name, user, params = F.col("event_type"), F.col("user_id").cast("string"), F.col("props")
    rules = [
        Segment("CLICK", name == "click"),
        Segment("BUY", like_any(name, ["%purchase%", "%sign%"]) | params.like('%"k": 7%')),
        Segment("FAULT", like_any(name, ["%error%"]) | params.like('%"k": 13%')),
        Segment("ALL", F.lit(True)),
    ]
    return with_test_variants(rules, like_any(user, ["9%", "88%"]))
