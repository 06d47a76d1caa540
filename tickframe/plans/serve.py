"""Headline figures from the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.operators.dedup import serving_rows
from tickframe.operators.incremental import FRAME_ROWS, on_dates, touched_dates
from tickframe.operators.serving import KPI_COLUMNS, kpis
from tickframe.operators.tails import newest_times
from tickframe.schemas import ANALYZED_SCHEMA
from tickframe.sources.tables import read_layouts, read_table
from tickframe.sources.tail_store import TailStore


def newest_stored(spark: SparkSession, path: str) -> DataFrame:
    """Every symbol's newest row with the columns of the headline figures, from its own date only.

    The tails beside the table name each symbol's newest time, so a symbol that was last seen long ago costs one old date
    and not a search. Without tails that fit, the whole table is read, in whatever layouts its days were written.
    """
    store = TailStore(spark, path, FRAME_ROWS - 1)
    if not store.is_stored():
        return serving_rows(read_layouts(spark, path, ANALYZED_SCHEMA))
    table = read_table(spark, path, ANALYZED_SCHEMA)
    newest = newest_times(store.load(table), "collection_time").withColumnRenamed("_newest", "collection_time")
    newest = newest.withColumn("trade_date", F.to_date("collection_time"))
    dates = touched_dates(newest)
    rows = on_dates(table, dates).select("symbol", "trade_date", "collection_time", *KPI_COLUMNS)
    return rows.join(newest, ["symbol", "trade_date", "collection_time"], "left_semi")


def run_kpis(spark: SparkSession, path: str) -> DataFrame:
    """Headline figures of every symbol; none for a table that is not there yet."""
    return kpis(newest_stored(spark, path))
