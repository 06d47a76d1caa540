import datetime as dt
import json

from conftest import values
from pyspark.sql import functions as F

from tickframe.functions import numbers as N
from tickframe.functions.times import (
    epoch_text,
    in_collection_hours,
    in_market_session,
    ingest_stamps,
    minute_key_text,
)
from tickframe.operators.enrich import enrich, metric_rows, profile_rows, quote_rows
from tickframe.operators.indicators import derive_indicators
from tickframe.operators.universe import choose_universe, restrict
from tickframe.plans.ingest import decode, good_rows, quarantine_rows, stamp
from tickframe.sources.sinks import encode_messages


def column(spark, data, kind):
    return spark.createDataFrame([(v,) for v in data], f"x {kind}")


def test_safe_number(spark):
    texts = [None, "0", "null", "None", "", "abc", "1.5", " 2 ", "1_000", "1.5d", "0x10", "-3e2"]
    df = column(spark, texts, "string").select(N.safe_number(F.col("x")))
    assert [r[0] for r in df.collect()] == [0.0] * 6 + [1.5, 2.0, 1000.0, 0.0, 0.0, -300.0]
    numbers = column(spark, [None, 0.0, 2.5], "double").select(N.safe_number(F.col("x"), -1.0))
    assert [r[0] for r in numbers.collect()] == [-1.0, 0.0, 2.5]


def test_pe_bands(spark):
    df = column(spark, [None, 0.0, 14.99, 15.0, 25.0, 25.01, float("nan"), -3.0], "double")
    bands = [r[0] for r in df.select(N.pe_band(F.col("x"))).collect()]
    assert bands == [None, None, "low", "fair", "fair", "high", None, None]


def test_half_even(spark):
    df = column(spark, [0.5, 1.5, 2.5, -0.5], "double").select(N.half_even(F.col("x"), 0))
    assert [r[0] for r in df.collect()] == [0.0, 2.0, 2.0, 0.0]


def test_number_texts_match_python(spark):
    data = [0.0, 1.005, 0.125, 1234567.5, -0.5, 99.995, 1e9 + 0.25]
    rows = column(spark, data, "double").select(
        N.two_decimals_text(F.col("x")), N.grouped_text(F.col("x")), N.signed_percent_text(F.col("x"))
    ).collect()
    assert [tuple(r) for r in rows] == [(f"{v:.2f}", f"{v:,.0f}", f"{v:+.2f}%") for v in data]


def test_indicators(spark):
    rows = [(12.0, 10.0, 13.0, 11.0), (12.0, 0.0, 13.0, 11.0), (12.0, None, 13.0, 11.0), (12.0, 16.0, 12.0, 12.0)]
    df = spark.createDataFrame(
        rows, "current_price double, previous_close double, high_price double, low_price double"
    )
    found = derive_indicators(df).select("daily_return", "volatility", "price_range", "price_position").collect()
    assert [tuple(r) for r in found] == [
        (0.2, 0.2, 2.0, 0.5), (None,) * 4, (None,) * 4, (-0.25, 0.25, 0.0, 0.5),
    ]


def test_decode_and_quarantine(spark):
    tick = {"symbol": "A", "current_price": 1.5, "timestamp": "2024-01-01T00:00:00.5", "market_timestamp": "t"}
    texts = [
        json.dumps(tick),
        "{bad",
        json.dumps({**tick, "current_price": "x", "symbol": "B"}),
        None,
        "",
        json.dumps({"current_price": 2}),
        json.dumps({**tick, "timestamp": "xx"}),
        "[1]",
    ]
    df = spark.createDataFrame([(t.encode() if t is not None else None,) for t in texts], "value binary")
    stamped = stamp(decode(df), F.lit("2024-02-01 10:20:30").cast("timestamp"))
    good = good_rows(stamped)
    assert values(good, "symbol", "current_price") == [("A", 1.5), ("B", None)]
    first = good.first()
    assert (first["batch_date"], first["batch_hour"]) == ("2024-02-01", 10)
    assert first["processed_timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    reasons = values(quarantine_rows(stamped), "reason")
    assert reasons == [(r,) for r in sorted(["malformed", "malformed", "no_value", "no_symbol", "no_symbol", "no_time"])]


def test_messages_are_parsed_once(spark):
    df = spark.createDataFrame([(b"{}",)], "value binary")
    plan = good_rows(stamp(decode(df)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_leaves_out_nulls(spark):
    df = spark.createDataFrame([("A", 1.5, None)], "symbol string, current_price double, beta double")
    row = encode_messages(df).first()
    assert (row["key"], json.loads(bytes(row["value"]))) == ("A", {"symbol": "A", "current_price": 1.5})


def test_stamps_of_one_run_agree(spark):
    df = column(spark, ["2024-01-01T00:00:00"] * 100, "string").withColumnRenamed("x", "timestamp").repartition(5)
    assert ingest_stamps(df).select("batch_timestamp").distinct().count() == 1


def test_minute_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("A", 1, 2), (None, 1, 2), ("A", None, 2)], "s string, h int, m int")
    keys = df.select(minute_key_text(F.col("s"), F.lit("d"), F.col("h"), F.col("m"))).collect()
    assert [r[0] for r in keys] == ["A_d_1_2", None, None]


def test_epoch_text(spark):
    assert column(spark, [0], "long").select(epoch_text(F.col("x"))).first()[0] == "1970-01-01T00:00:00"


def test_sessions(spark):
    times = [
        "2024-01-05 23:00:00",  # Friday night
        "2024-01-06 03:00:00",  # Saturday
        "2024-01-08 07:00:00",
        "2024-01-08 14:29:59",  # 09:29:59 in New York
        "2024-01-08 14:30:00",
        "2024-01-08 21:00:00",  # 16:00
        "2024-07-08 13:30:00",  # summer time
    ]
    df = column(spark, times, "string").select(F.col("x").cast("timestamp").alias("x"))
    found = df.select(in_collection_hours(F.col("x")), in_market_session(F.col("x"))).collect()
    assert [tuple(r) for r in found] == [
        (True, False), (False, False), (False, False), (False, False), (False, True), (False, False), (False, True),
    ]


def test_quotes_profiles_and_metrics(spark):
    quotes = spark.createDataFrame(
        [("A", "10", "9", 5), ("ZERO", "0", "9", 5), ("NONE", None, "9", 5), ("BAD", "x", "9", 5)],
        "symbol string, c string, pc string, t long",
    ).withColumn("polled_at", F.lit("2024-01-01 03:00:00").cast("timestamp"))
    ticks = quote_rows(quotes)
    assert values(ticks, "symbol", "current_price", "open_price", "market_timestamp") == [
        ("A", 10.0, 0.0, "1970-01-01T00:00:05"), ("NONE", 0.0, 0.0, "1970-01-01T00:00:05"),
    ]
    profiles = profile_rows(
        spark.createDataFrame([("A", "Alpha", "5"), ("A", "Alpha", "5")], "symbol string, name string, marketCapitalization string")
    )
    metrics = metric_rows(spark.createDataFrame([("A", "none", 2.0)], "symbol string, beta string, `52WeekHigh` double"))
    joined = enrich(ticks, profiles, metrics)
    assert values(joined, "symbol", "company_name", "currency", "market_cap", "beta", "week_52_high", "pe_ratio") == [
        ("A", "Alpha", "USD", 5.0, 0.0, 2.0, 0.0), ("NONE", None, None, None, None, None, None),
    ]
    odd_hour = enrich(ticks, profiles, metrics, profile_every_hours=2)
    assert values(odd_hour.filter("symbol = 'A'"), "company_name", "week_52_high") == [(None, 2.0)]


def test_universes(spark):
    assert values(choose_universe(spark, "manual", " A, B ,C"), "rank_no", "symbol") == [(1, "A"), (2, "B"), (3, "C")]
    assert choose_universe(spark).count() == 8
    assert choose_universe(spark, "trending").count() == 8
    large = [r["symbol"] for r in choose_universe(spark, "large_cap").orderBy("rank_no").collect()]
    assert (len(large), large[0], large[-1]) == (10, "AAPL", "UNH")
    df = column(spark, ["AAPL", "AAPL", "??"], "string").withColumnRenamed("x", "symbol")
    assert restrict(df, choose_universe(spark)).count() == 2
