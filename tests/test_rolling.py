import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import START, values
from pyspark.sql import functions as F

from pyspark.sql import Window

from tickframe.operators.rolling import (
    EXACT,
    moving_average,
    trailing_range,
    trailing_range_blocks,
    trailing_rows,
    trailing_rows_chunked,
    trailing_rows_plain,
)
from tickframe.operators.rollups import daily_average, daily_moving_average

NAMES = ("average", "n")


def trailing_range_plain(df, value, seconds, average, count, at, exact=EXACT):
    """The window form of the range frame."""
    frame = Window.partitionBy("symbol").orderBy("_at").rangeBetween(-seconds * 1_000_000, 0)
    number = F.col(value).try_cast(exact)
    total = F.sum(number).over(frame).cast("double") / F.col(count)
    return (
        df.withColumn("_at", F.unix_micros(F.col(at)))
        .withColumn(count, F.count(number).over(frame))
        .withColumn(average, F.when(F.col(count) > 0, total))
        .select(*df.columns, average, count)
    )


def prices(spark, n=600, seed=1, gaps=True):
    """Three symbols, one of them with most of the rows; repeated instants, missing prices and a null symbol."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        symbol = rng.choices(["HOT", "B", "C", None], [12, 2, 1, 1])[0]
        at = START + dt.timedelta(hours=rng.randrange(24 * 30), microseconds=rng.choice([0, 0, 1, 999_999]))
        price = None if gaps and rng.random() < 0.1 else rng.randrange(1, 10_000) / 100
        rows.append((i, symbol, at, price))
    df = spark.createDataFrame(rows, "id long, symbol string, at timestamp, price double")
    return rows, df.repartition(5)


def expect_rows(rows, frame):
    result = {}
    for symbol in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == symbol), key=lambda r: (r[2], r[0]))
        for i, row in enumerate(mine):
            held = [Decimal(str(r[3])) for r in mine[max(0, i - frame + 1) : i + 1] if r[3] is not None]
            result[row[0]] = (float(sum(held)) / len(held) if held else None, len(held))
    return result


def expect_range(rows, seconds):
    result = {}
    for i, symbol, at, _ in rows:
        if symbol is None:
            result[i] = (None, None)
            continue
        low = at - dt.timedelta(seconds=seconds)
        held = [Decimal(str(p)) for _, s, t, p in rows if s == symbol and low <= t <= at and p is not None]
        result[i] = (float(sum(held)) / len(held) if held else None, len(held))
    return result


def got(df):
    return {row["id"]: (row["average"], row["n"]) for row in df.collect()}


@pytest.mark.parametrize("frame", [1, 2, 7, 40])
def test_rows_plain(spark, frame):
    rows, df = prices(spark)
    exact = trailing_rows_plain(df, "price", frame, *NAMES, order=("at", "id"), exact="decimal(18,2)")
    assert got(exact) == expect_rows(rows, frame)


@pytest.mark.parametrize(("frame", "chunk"), [(1, 1), (2, 3), (7, 7), (7, 50), (40, 41)])
def test_rows_chunked_equals_brute_force(spark, frame, chunk):
    rows, df = prices(spark, seed=frame)
    cut = trailing_rows_chunked(
        df, "price", frame, *NAMES, order=("at", "id"), exact="decimal(18,2)", chunk_rows=chunk
    )
    assert cut.columns == [*df.columns, *NAMES]
    assert got(cut) == expect_rows(rows, frame)


def test_rows_chunked_doubles_equal_plain(spark):
    _, df = prices(spark, seed=9)
    plain = trailing_rows_plain(df, "price", 7, *NAMES, order=("at", "id"))
    cut = trailing_rows_chunked(df, "price", 7, *NAMES, order=("at", "id"), chunk_rows=20)
    assert got(cut) == got(plain)


def test_hot_instant(spark):
    """All rows of the symbol carry one time."""
    df = spark.range(500).select(
        F.col("id"), F.lit("HOT").alias("symbol"), F.lit(START).alias("at"), (F.col("id") / 4.0).alias("price")
    )
    cut = trailing_rows_chunked(df, "price", 5, *NAMES, order=("at", "id"), chunk_rows=30)
    assert got(cut) == got(trailing_rows_plain(df, "price", 5, *NAMES, order=("at", "id")))


@pytest.mark.parametrize("seconds", [60, 3600, 86400, 10**8])
@pytest.mark.parametrize("chunk", [7, 25, 10_000])
def test_symbols_of_all_sizes_take_one_way(spark, seconds, chunk):
    rows, df = prices(spark, seed=3)
    mixed = trailing_rows(
        df, "price", 7, *NAMES, order=("at", "id"), exact="decimal(18,2)", chunk_rows=chunk, bucket_seconds=seconds
    )
    assert got(mixed) == expect_rows(rows, 7)


def test_planning_starts_no_job_and_pieces_stay_small(spark):
    """A symbol with most of the rows is spread over tasks by pieces, found without looking at the data first."""
    hot = spark.range(4000).select(
        F.col("id"),
        F.when(F.col("id") % 10 == 0, "COLD").otherwise("HOT").alias("symbol"),
        (F.lit(START) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("at"),
        (F.col("id") / 4.0).alias("price"),
    )
    spark.sparkContext.setJobGroup("planning", "planning")
    found = trailing_rows(hot, "price", 7, *NAMES, order=("at", "id"), exact="decimal(18,2)", chunk_rows=100)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") == []
    spark.sparkContext.setJobGroup("other", "other")
    assert got(found) == got(trailing_rows_plain(hot, "price", 7, *NAMES, order=("at", "id"), exact="decimal(18,2)"))


def test_orders_without_a_time(spark):
    df = spark.createDataFrame([("A", i, f"n{i:03}", float(i)) for i in range(-20, 60)] + [("A", None, None, 7.0)], "symbol string, at int, name string, price double")
    rows = df.withColumn("id", F.coalesce(F.col("at"), F.lit(-1000)))
    expected = got(trailing_rows_plain(rows, "price", 5, *NAMES, order=("at",)))
    assert got(trailing_rows_chunked(rows, "price", 5, *NAMES, order=("at",), chunk_rows=9, bucket_seconds=4)) == expected
    by_name = got(trailing_rows_plain(rows, "price", 5, *NAMES, order=("name",)))
    assert got(trailing_rows_chunked(rows, "price", 5, *NAMES, order=("name",), chunk_rows=9)) == by_name


def test_chunk_must_hold_a_frame(spark):
    with pytest.raises(ValueError):
        trailing_rows_chunked(prices(spark, 5)[1], "price", 7, *NAMES, chunk_rows=6)


@pytest.mark.parametrize("seconds", [0, 3600, 7 * 86400])
def test_range_equals_brute_force(spark, seconds):
    rows, df = prices(spark, seed=4)
    found = trailing_range(df, "price", seconds, *NAMES, at="at", exact="decimal(18,2)")
    assert found.columns == [*df.columns, *NAMES]
    assert got(found) == expect_range(rows, seconds)


@pytest.mark.parametrize("seconds", [0, 3600, 7 * 86400])
def test_range_blocks_equal_brute_force(spark, seconds):
    rows, df = prices(spark, seed=4)
    found = trailing_range_blocks(df, "price", seconds, *NAMES, at="at", exact="decimal(18,2)")
    assert found.columns == [*df.columns, *NAMES]
    assert got(found) == expect_range(rows, seconds)


def extremes(spark):
    """NaN, infinities, a value of 22 digits, nine decimals, and one too large for the type."""
    odd = [1.5, float("nan"), 2.5, float("inf"), 0.123456789, float("-inf"), 1e21, None, 0.000000001, 1e40, 3.25, -1e21]
    rows = [(i, "A", START + dt.timedelta(minutes=i), odd[(i // 3) % len(odd)] if i % 3 == 0 else float(i)) for i in range(90)]
    return rows, spark.createDataFrame(rows, "id long, symbol string, at timestamp, price double")


def expect_extremes(rows, frame):
    result = {}
    for i, _, _, _ in rows:
        held = [r[3] for r in rows[max(0, i - frame + 1) : i + 1] if r[3] is not None]
        finite = [Decimal(repr(v)) for v in held if v == v and abs(v) != float("inf")]
        inf = {v for v in held if abs(v) == float("inf")}
        if any(v != v for v in held) or len(inf) == 2:
            mean = "nan"
        elif inf:
            mean = inf.pop()
        else:
            mean = None if not held or any(abs(v) >= Decimal(10) ** 27 for v in finite) else float(sum(finite)) / len(held)
        result[i] = (mean, len(held))
    return result


@pytest.mark.parametrize("frame", [1, 2, 5, 13])
def test_no_value_is_lost_in_any_frame(spark, frame):
    """What is no finite number shows while it is in the frame, and is gone without a trace after it."""
    rows, df = extremes(spark)
    seconds = (frame - 1) * 60
    found = [
        trailing_rows_plain(df, "price", frame, *NAMES, order=("at",), exact=EXACT),
        trailing_rows_chunked(df, "price", frame, *NAMES, order=("at",), exact=EXACT, chunk_rows=max(frame, 6), bucket_seconds=120),
        trailing_range(df, "price", seconds, *NAMES, at="at"),
        trailing_range_blocks(df, "price", seconds, *NAMES, at="at"),
    ]
    for one in found:
        assert {k: ("nan" if a is not None and a != a else a, n) for k, (a, n) in got(one).items()} == expect_extremes(rows, frame)


def test_daily_averages_show_what_is_no_number(spark):
    _, df = extremes(spark)
    by = {r["symbol"]: (r["daily_avg_price"], r["data_count_for_avg"]) for r in daily_average(df.withColumn("symbol", F.col("id").cast("string")), "price", "at", exact=EXACT).collect()}
    assert str(by["3"][0]) == "nan" and by["9"][0] == float("inf") and by["15"][0] == float("-inf") and by["21"] == (None, 0) and by["27"] == (None, 1)
    assert by["18"][0] == 1e21 and by["24"][0] == 1e-9


@pytest.mark.parametrize("widths", [(), (1_000_000,), (7, 70), (1_000_000, 3_600_000_000)])
def test_range_does_not_depend_on_bucket_widths(spark, widths):
    _, df = prices(spark, seed=5)
    known = df.filter("symbol IS NOT NULL")
    plain = trailing_range_plain(known, "price", 86400, *NAMES, at="at")
    assert got(trailing_range(known, "price", 86400, *NAMES, at="at", widths=widths)) == got(plain)


def test_range_before_the_epoch(spark):
    rows = [(i, "A", dt.datetime(1969, 12, 31, 23, 59, 58) + dt.timedelta(seconds=i), float(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, symbol string, at timestamp, price double")
    assert got(trailing_range(df, "price", 2, *NAMES, at="at")) == expect_range(rows, 2)


def test_golden_seven_day_average(spark):
    rows = [("TEST", 100.0 + i, START + dt.timedelta(days=i)) for i in range(10)]
    df = spark.createDataFrame(rows, "symbol string, price double, timestamp timestamp")
    daily = daily_moving_average(daily_average(df, "price", "timestamp"))
    averages = {str(r["trade_date"]): r["7_day_moving_average"] for r in daily.collect()}
    assert averages["2024-01-01"] == 100.0
    assert averages["2024-01-02"] == 100.5
    assert averages["2024-01-07"] == pytest.approx(103.0)
    assert averages["2024-01-10"] == pytest.approx(106.0)


def test_moving_average_order(spark):
    df = spark.createDataFrame([("A", 2, 20.0), ("A", 1, 10.0), ("B", 1, 5.0)], "symbol string, trade_date int, p double")
    assert values(moving_average(df, "p", 2, "m"), "symbol", "trade_date", "m") == [
        ("A", 1, 10.0), ("A", 2, 15.0), ("B", 1, 5.0),
    ]
