"""Parquet and message sinks."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.session import new_path, path_exists, remove_own
from tickframe.sources.ledger import Ledger


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "append",
    sort: Sequence[str] = (),
    max_records: int | None = None,
    compression: str = "snappy",
    dynamic: bool = False,
) -> int:
    """Write ``df`` partitioned by ``by`` and return the number of rows written.

    Rebalancing brings the rows of a directory together so that it gets few files, and adaptive execution splits a
    directory that is much larger than the others over several tasks. Rows are sorted inside each file, so that page
    statistics let later reads skip what they filter out. The row count is observed during the write, so it costs no
    extra job.
    """
    rows = Observation()
    laid_out = (
        df.hint("rebalance", *by)
        .sortWithinPartitions(*by, *sort)
        .observe(rows, F.count(F.lit(1)).alias("rows"))
    )
    writer = laid_out.write.mode(mode).partitionBy(*by).option("compression", compression)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return int(rows.get["rows"])


def staged_overwrite(
    df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), replace: str = "partitions"
) -> int:
    """Overwrite ``path`` with rows that may have been read from ``path``.

    Spark deletes the target before it reads it, so the rows go to a staging table first. ``replace="partitions"``
    touches only the directories present in ``df``; ``"all"`` replaces the table. A ledger beside the target names the
    staging table from its last row on until the swap is done; a run that ended in between is finished by the next one
    (``finish_swaps``).
    """
    if replace not in ("partitions", "all"):
        raise ValueError(f"replace must be 'partitions' or 'all', not {replace!r}")
    spark = df.sparkSession
    finish_swaps(spark, path)
    ledger, staging = _swaps(spark, path), new_path(spark, "staging")
    last = ledger.last()
    number = last[0] + 1 if last else 0
    df.write.parquet(staging)
    plan = {"staging": staging, "replace": replace, "by": list(by), "sort": list(sort), "schema": df.schema.json()}
    ledger.commit(number, plan)
    rows = _swap(spark, path, plan)
    ledger.commit(number + 1, {"done": number})
    remove_own(spark, staging)
    return rows


def _swaps(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, f"{path.rstrip('/')}_swaps")


def _swap(spark: SparkSession, path: str, plan: dict) -> int:
    schema = T.StructType.fromJson(json.loads(plan["schema"]))
    staged = spark.read.schema(schema).parquet(plan["staging"])
    return write_partitioned(staged, path, plan["by"], "overwrite", plan["sort"], dynamic=plan["replace"] == "partitions")


def finish_swaps(spark: SparkSession, path: str) -> int | None:
    """Finish a swap that a run before left between its staging table and its target; returns the rows written, if any.

    Writing the same partitions from the same staging table again gives the same table, however far the first run came.
    """
    ledger = _swaps(spark, path)
    last = ledger.last()
    if last is None or "done" in last[1]:
        return None
    number, plan = last
    rows = _swap(spark, path, plan) if path_exists(spark, plan["staging"]) else None
    ledger.commit(number + 1, {"done": number})
    if rows is not None:
        remove_own(spark, plan["staging"])
    return rows


def encode_messages(df: DataFrame, key: str = "symbol", columns: Sequence[str] | None = None) -> DataFrame:
    """Rows to (key, value) messages; null fields are left out of the JSON text."""
    fields = list(columns or df.columns)
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
    )


def write_messages(df: DataFrame, format: str = "kafka", path: str | None = None, mode: str = "append", **options):
    """Send encoded messages to a topic, or to files when the format is a file format."""
    writer = df.write.format(format).mode(mode).options(**options)
    writer.save(path) if path else writer.save()
