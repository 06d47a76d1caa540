import datetime as dt

from conftest import START, values
from pyspark.sql import functions as F

from tickframe.functions.times import time_parts
from tickframe.operators.dedup import (
    best_per_key,
    keep_first,
    last_rows,
    latest_per_minute,
    latest_per_symbol,
    serving_rows,
)
from tickframe.schemas import DAY_KEY

TICK = "symbol string, batch_timestamp timestamp, processed_timestamp timestamp, current_price double"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_later_poll_of_a_minute_wins_on_any_partitioning(spark):
    rows = [("A", at(999), at(10), 1.0), ("A", at(999), at(40), 2.0), ("B", at(999), at(5), 3.0)]
    df = time_parts(spark.createDataFrame(rows, TICK))
    for parts in (1, 3, 7):
        newest = latest_per_minute(df.repartition(parts))
        assert values(newest, "symbol", "current_price") == [("A", 2.0), ("B", 3.0)]


def test_reingested_messages_give_one_row(spark):
    rows = [("A", at(batch), at(60 * m), float(m)) for m in range(20) for batch in (5000, 6000)]
    newest = latest_per_minute(time_parts(spark.createDataFrame(rows, TICK)))
    assert newest.count() == 20
    assert newest.select("batch_timestamp").distinct().collect()[0][0] == at(6000)
    again = latest_per_minute(newest)
    assert values(again, "symbol", "current_price") == values(newest, "symbol", "current_price")


def test_equal_sort_keys_have_one_winner(spark):
    df = spark.range(1000).select(F.lit("A").alias("symbol"), F.lit(1).alias("rank"), F.col("id").alias("payload"))
    winners = {
        keep_first(df.repartition(n, "payload"), ["symbol"], [F.col("rank")]).first()["payload"] for n in (1, 2, 9)
    }
    assert len(winners) == 1


def test_best_prefers_known_and_larger_averages(spark):
    rows = [("A", 1, None, 9.0, 1), ("A", 1, 2.0, 1.0, 1), ("A", 1, 2.0, 3.0, 1), ("A", 2, None, 1.0, 1)]
    df = spark.createDataFrame(
        rows, "symbol string, trade_date int, moving_avg_7_days double, average_price double, data_points_per_minute int"
    )
    assert values(best_per_key(df, DAY_KEY), "trade_date", "average_price") == [(1, 3.0), (2, 1.0)]


def test_serving_key_follows_the_layout(spark):
    schema = "symbol string, trade_date int, collection_time int, moving_avg_7_days double, average_price double, data_count_for_avg long"
    df = spark.createDataFrame([("A", 1, 1, 1.0, 1.0, 1), ("A", 1, 2, 2.0, 1.0, 1)], schema)
    assert serving_rows(df).count() == 2
    assert serving_rows(df.drop("collection_time")).count() == 1


def test_last_rows_of_a_hot_symbol(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 == 0, "B").otherwise("HOT").alias("symbol"), F.col("id").alias("collection_time")
    ).repartition(16)
    last = last_rows(df, 216)
    assert values(last.groupBy("symbol").agg(F.count("*").alias("n"), F.min("collection_time").alias("low")),
                  "symbol", "n", "low") == [("B", 216, 2840), ("HOT", 216, 4761)]
    assert values(latest_per_symbol(df), "symbol", "collection_time") == [("B", 4990), ("HOT", 4999)]


def test_limit_reaches_the_input_side_of_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("symbol"), F.col("id").alias("collection_time"))
    plan = latest_per_symbol(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("Partial")
