"""RAW to ANALYZED, and RAW to DAILY."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions.times import time_parts
from tickframe.operators.incremental import (
    FRAME_ROWS,
    analyze_new,
    continue_trailing,
    drop_processed,
    minute_rows,
    one_per_time,
    touched_dates,
)
from tickframe.operators.rollups import daily_average, daily_moving_average
from tickframe.schemas import ANALYZED_PARTITIONS, ANALYZED_SCHEMA, DAILY_SCHEMA, RAW_SCHEMA
from tickframe.session import cut_lineage
from tickframe.sources.sinks import finish_swaps, staged_overwrite, write_partitioned
from tickframe.sources.lake import lake_batches, read_batches
from tickframe.sources.tables import read_table
from tickframe.sources.tail_store import TailStore

_SORT = ["symbol", "collection_time"]
_TRAILING = ["moving_avg_7_days", "data_count_for_avg"]


def _raw_parts(spark: SparkSession, raw_path: str, since: str | None) -> DataFrame:
    raw = read_table(spark, raw_path, RAW_SCHEMA)
    if since:
        raw = raw.filter(F.col("batch_date") >= F.lit(since))
    return time_parts(raw)


def run_analyze(
    spark: SparkSession,
    raw_path: str,
    analyzed_path: str,
    mode: str = "append",
    since: str | None = None,
    dedup: dict | None = None,
    **trailing,
) -> int:
    """Analyse the minutes that ANALYZED lacks and add them; returns the number of rows written.

    ``append`` leaves written rows alone: a late minute gets the right figures itself, but later rows keep theirs.
    ``repair`` also recomputes everything from the earliest touched date on and replaces those dates. ``since`` skips
    older batches of RAW.
    """
    parts = _raw_parts(spark, raw_path, since)
    if mode == "append":
        return append_minutes(parts, analyzed_path, dedup, **trailing)
    finish_swaps(spark, analyzed_path)
    history = read_table(spark, analyzed_path, ANALYZED_SCHEMA, missing_ok=True)
    if mode == "repair":
        rows = repaired(parts, history, dedup, **trailing)
        if rows is None:
            return 0
        return staged_overwrite(
            rows.select(*ANALYZED_SCHEMA.fieldNames()), analyzed_path, ANALYZED_PARTITIONS, _SORT
        )
    raise ValueError(f"mode must be 'append' or 'repair', not {mode!r}")


def append_minutes(parts: DataFrame, analyzed_path: str, dedup: dict | None = None, bookmark=None, **trailing) -> int:
    """Add the minutes of ``parts`` that ANALYZED lacks, and move the tails beside it on; returns the rows written.

    Minutes already there are skipped, so a run that is repeated after it ended early adds only what is missing; the
    tails' entry is written last and names the table's size, so such a run finds them out of date and makes them anew.
    """
    spark = parts.sparkSession
    finish_swaps(spark, analyzed_path)
    history = read_table(spark, analyzed_path, ANALYZED_SCHEMA, missing_ok=True)
    order, price = trailing.get("order", ("collection_time",)), trailing.get("price", "average_price")
    store = TailStore(spark, analyzed_path, trailing.get("rows", FRAME_ROWS) - 1, price, order)
    stored = store.is_stored()
    # Made anew they would be computed for each use, and the table they come from is about to grow.
    tails = store.load(history) if stored else cut_lineage(store.load(one_per_time(history, price, order)))
    rows = cut_lineage(analyze_new(parts, history, dedup=dedup, tails=tails, **trailing).select(*ANALYZED_SCHEMA.fieldNames()))
    written = write_partitioned(rows, analyzed_path, ANALYZED_PARTITIONS, "append", _SORT)
    store.commit(tails, rows, stored, bookmark)
    return written


def run_analyze_lake(spark: SparkSession, lake: str, analyzed_path: str, dedup: dict | None = None, **trailing) -> int:
    """Analyse the batches of a lake that came after the last analysed one; returns the rows written.

    The bookmark is committed with the tails, after the rows. Only the folders of the new batches are listed and read.
    """
    store = TailStore(spark, analyzed_path, trailing.get("rows", FRAME_ROWS) - 1)
    new = lake_batches(spark, lake, after=store.bookmark(-1))
    if not new:
        return 0
    return append_minutes(time_parts(read_batches(spark, lake, new)), analyzed_path, dedup, bookmark=new[-1], **trailing)


def repaired(parts: DataFrame, history: DataFrame, dedup: dict | None = None, **trailing) -> DataFrame | None:
    """All rows from the earliest new date on, recomputed; ``None`` when nothing is new."""
    new = cut_lineage(drop_processed(minute_rows(parts, **(dedup or {})), history))
    dates = touched_dates(new)
    if not dates:
        return None
    low = dates[0]
    touched = history.filter(F.col("trade_date") >= F.lit(low)).drop(*_TRAILING)
    untouched = history.filter(F.col("trade_date") < F.lit(low))
    return continue_trailing(untouched, touched.unionByName(new.select(*touched.columns)), **trailing)


def run_daily(
    spark: SparkSession,
    raw_path: str,
    daily_path: str,
    price: str = "current_price",
    at: str = "processed_timestamp",
    schema=RAW_SCHEMA,
    exact: str | None = None,
) -> int:
    """Daily averages and their seven-row trailing average; replaces the DAILY table."""
    daily = daily_moving_average(daily_average(read_table(spark, raw_path, schema), price, at, exact=exact))
    return write_partitioned(
        daily.select(*DAILY_SCHEMA.fieldNames()), daily_path, ["trade_date"], "overwrite", ["symbol"]
    )
