"""Small DataFrame helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import scratch_path

#: Stands for a missing id inside an operator; results show the null again.
NO_ID = -(2**63)

#: Lets Spark remove the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def id_or_mark(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID))


def mark_to_null(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def stored(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: later branches share the work, lost executors cost nothing.

    With ``release`` the shuffle files of this step go as soon as it is written, not when the driver happens to collect
    its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    if release:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove the files of stored tables that no later step reads."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
