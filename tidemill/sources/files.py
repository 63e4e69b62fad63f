"""File scans, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as rows of ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the text files that appear in a folder."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    *,
    max_files: int | None = None,
    latest_first: bool = False,
    **options: str,
) -> DataFrame:
    """Files that appear in a folder, with an explicit schema.

    Oldest file first unless ``latest_first``. ``key=value`` folders become
    columns when the schema names them.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    reader = reader.option("latestFirst", latest_first)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", **kwargs
) -> DataFrame:
    """CSV folder as a stream."""
    return stream_files(spark, path, schema, "csv", sep=sep, **kwargs)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file below a folder as ``path, length, modificationTime``.

    The content column is pruned, so no file is opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
