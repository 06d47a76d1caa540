"""Duplicate cleanup, the quality gate and health checks of the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.operators.dedup import best_per_key
from tickframe.operators.quality import freshness, quality_report
from tickframe.schemas import ANALYZED_PARTITIONS, ANALYZED_SCHEMA, MINUTE_KEY
from tickframe.sources.sinks import finish_swaps, staged_overwrite
from tickframe.sources.tables import read_table


def duplicated_dates(df: DataFrame, keys: Sequence[str], date: str = "trade_date") -> DataFrame:
    """Dates in which some key occurs more than once."""
    repeated = df.groupBy(*dict.fromkeys([*keys, date])).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return repeated.select(date).distinct()


def run_cleanup(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = MINUTE_KEY,
    schema=ANALYZED_SCHEMA,
    by: Sequence[str] = ANALYZED_PARTITIONS,
) -> int:
    """Keep the best row per key and rewrite only the dates that held duplicates; returns the rows rewritten.

    Keys must include the partition columns, or copies in different directories would not meet.
    """
    missing = [c for c in by if c not in keys]
    if missing:
        raise ValueError(f"keys must include the partition columns {missing}")
    finish_swaps(spark, path)
    table = read_table(spark, path, schema)
    # One value per calendar date at most, so the list is small whatever the table's size.
    dates = [row[0] for row in duplicated_dates(table, keys, by[0]).collect()]
    if not dates:
        return 0
    affected = table.filter(F.col(by[0]).isin(dates))
    return staged_overwrite(best_per_key(affected, keys), path, by, ["symbol"])


def run_quality(spark: SparkSession, tables: dict[str, dict], **limits) -> DataFrame:
    """Verdict per table: ``tables`` maps a name to ``path`` and optional ``schema``, ``price`` and ``keys``."""
    verdicts = None
    for name, spec in tables.items():
        spec = dict(spec)
        df = read_table(spark, spec.pop("path"), spec.pop("schema", None))
        one = quality_report(df, **spec, **limits).select(
            F.lit(name).alias("dataset"), "total", "duplicates", "invalid_prices", "passed"
        )
        verdicts = one if verdicts is None else verdicts.unionByName(one)
    return verdicts


def run_freshness(frames: dict[str, tuple[DataFrame, str]], now: Column | None = None, **limits) -> DataFrame:
    """Freshness per dataset: ``frames`` maps a name to a frame and its time column."""
    checks = None
    for name, (df, at) in frames.items():
        one = freshness(df, name, at, now, **limits)
        checks = one if checks is None else checks.unionByName(one)
    return checks


def run_monitor(
    spark: SparkSession,
    analyzed_path: str,
    messages: DataFrame | None = None,
    now: Column | None = None,
    **limits,
) -> DataFrame:
    """Freshness of ANALYZED, read in its newest date only, and whether the topic holds any message."""
    analyzed = read_table(spark, analyzed_path, ANALYZED_SCHEMA, missing_ok=True)
    checks = freshness(analyzed, "analyzed", "collection_time", now, partition="trade_date", **limits)
    if messages is None:
        return checks
    arrived = not messages.isEmpty()
    topic = checks.limit(1).select(
        F.lit("topic").alias("dataset"),
        F.lit(arrived).alias("has_data"),
        F.lit(None).cast("timestamp").alias("latest"),
        F.lit(None).cast("bigint").alias("lag_seconds"),
        F.lit(arrived).alias("fresh"),
    )
    return checks.unionByName(topic)
