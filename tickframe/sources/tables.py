"""Parquet table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickframe.session import path_exists


def empty_table(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema=None, missing_ok: bool = False) -> DataFrame:
    """Scan a parquet directory, partition columns included.

    With a schema, partition columns keep the declared type: without one, Spark infers them from the directory
    names and a symbol such as ``005930`` becomes the number 5930. With ``missing_ok``, an absent path is an
    empty table, as on the first run of a job.
    """
    if missing_ok and schema is not None and not path_exists(spark, path):
        return empty_table(spark, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_layouts(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A stored table whose files were written in several layouts, united by their columns.

    The layouts are found in the files' footers; a column that a file lacks is null in its rows. Without files, and with a
    schema, it is an empty table.
    """
    if schema is not None and not path_exists(spark, path):
        return empty_table(spark, schema)
    return spark.read.option("mergeSchema", True).parquet(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows, as a frame rather than printed text."""
    return df.limit(n)
