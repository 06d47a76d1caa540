"""Shapes of executed plans that the results alone would not show."""

import re

import pytest
from conftest import START
from pyspark.sql import functions as F

from tickframe.functions.times import time_parts
from tickframe.operators.dedup import latest_per_minute
from tickframe.operators.incremental import drop_processed, on_dates, with_trailing
from tickframe.operators.quality import null_counts, quality_report
from tickframe.operators.rolling import trailing_range, trailing_rows, trailing_rows_plain
from tickframe.operators.rollups import daily_average, hourly_price
from tickframe.schemas import MINUTE_KEY
from tickframe.sources import read_table, write_partitioned

SCHEMA = "symbol string, collection_time timestamp, average_price double, note string, trade_date date"


def plan_of(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    rows = spark.range(2000).select(
        F.concat(F.lit("S"), F.col("id") % 7).alias("symbol"),
        (F.lit(START) + F.make_dt_interval(mins=F.col("id").cast("int") * 3)).alias("collection_time"),
        (F.col("id") / 4.0).alias("average_price"),
        F.lit("x").alias("note"),
    )
    write_partitioned(rows.withColumn("trade_date", F.to_date("collection_time")), path, ["trade_date"], sort=["symbol"])
    return read_table(spark, path, SCHEMA)


def test_filters_and_columns_reach_the_scan(stored):
    chosen = on_dates(stored, [START.date()]).filter("symbol = 'S1'").select("average_price")
    plan = plan_of(chosen)
    assert re.search(r"PartitionFilters: \[.*trade_date", plan)
    assert "EqualTo(symbol,S1)" in plan
    assert "ReadSchema: struct<symbol:string,average_price:double>" in plan
    assert "Exchange" not in plan


def test_deduplication_shuffles_once_and_the_anti_join_reuses_it(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ticks = time_parts(stored.drop("trade_date", "collection_time").withColumn(
            "processed_timestamp", F.lit(START)).withColumn("batch_timestamp", F.lit(START)))
        new = drop_processed(latest_per_minute(ticks), stored.withColumns(
            {"collection_hour": F.hour("collection_time"), "collection_minute": F.minute("collection_time")}))
        plan = plan_of(new)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One shuffle for each side; the deduplicated side is not moved again for the join.
    assert plan.count("Exchange hashpartitioning") == 2
    assert "LeftAnti" in plan
    assert MINUTE_KEY[0] == "symbol" and "hashpartitioning(symbol" in plan


def test_group_summaries_aggregate_before_the_shuffle(stored):
    for df in (daily_average(stored, "average_price", "collection_time"), hourly_price(stored)):
        plan = plan_of(df)
        assert plan.count("Exchange") == 1
        assert plan.rindex("partial_") > plan.index("Exchange")


def test_quality_is_one_pass(stored):
    assert plan_of(null_counts(stored)).count("FileScan") == 1
    report = plan_of(quality_report(stored, "average_price"))
    assert report.count("FileScan") == 1
    assert "Join" not in report


def test_trailing_rows_need_one_shuffle(stored):
    plan = plan_of(trailing_rows_plain(stored, "average_price", 7, "a", "n", exact="decimal(18,2)"))
    assert plan.count("Exchange") == 1


def test_range_frames_never_group_by_symbol_alone_on_rows(stored):
    """The only window over a whole symbol runs on one row per day."""
    df = trailing_range(stored, "average_price", 86400, "a", "n")
    df.collect()
    plan = plan_of(df)
    whole_symbol = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(symbol, \d+\)", line)]
    assert len(set(whole_symbol)) <= 2
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_minute_rows_of_a_range_frame_move_once(stored):
    plan = plan_of(with_trailing(stored, frame="range", exact="decimal(18,2)"))
    assert plan.count("Exchange") == 1 and "hashpartitioning(symbol, _block" in plan


def test_row_frames_move_counts_and_rows_by_pieces(spark, stored):
    """Rows meet the counts of their buckets and then their piece; no exchange of rows is by the symbol alone."""
    plan = plan_of(trailing_rows(stored, "average_price", 7, "a", "n", exact="decimal(18,2)"))
    by_symbol = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(symbol, \d+\)", line)]
    assert len(by_symbol) <= 1 and re.search(r"hashpartitioning\(symbol, _piece", plan)
