"""Grouped summaries. All of them aggregate partially before the shuffle, so a hot group stays small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.functions.numbers import exact_avg, percent
from tickframe.operators.rolling import moving_average


def daily_average(
    df: DataFrame,
    price: str = "current_price",
    at: str = "processed_timestamp",
    symbol: str = "symbol",
    exact: str | None = None,
) -> DataFrame:
    """Average price and number of prices per symbol and day."""
    return (
        df.groupBy(F.col(symbol).alias("symbol"), F.to_date(at).alias("trade_date"))
        .agg(
            exact_avg(F.col(price), exact).alias("daily_avg_price"),
            F.count(price).alias("data_count_for_avg"),
        )
    )


def daily_moving_average(daily: DataFrame, rows: int = 7, name: str = "7_day_moving_average") -> DataFrame:
    return moving_average(daily, "daily_avg_price", rows, name)


def daily_summary(
    df: DataFrame,
    keys: Sequence[str] = ("symbol", "trade_date"),
    price: str = "average_price",
    trailing: str = "moving_avg_7_days",
    at: str = "collection_time",
    exact: str | None = None,
) -> DataFrame:
    """Mean price and first known trailing average per day."""
    known = F.when(F.col(trailing).isNotNull(), F.col(at))
    return df.groupBy(*keys).agg(
        exact_avg(F.col(price), exact).alias(price),
        F.min_by(trailing, known).alias(trailing),
    )


def _by_hour(df: DataFrame, at: str, keys: Sequence[str]) -> DataFrame:
    return df.filter(F.col(at).isNotNull()).groupBy(*keys, F.hour(at).alias("hour"))


def hourly_price(
    df: DataFrame,
    price: str = "average_price",
    at: str = "collection_time",
    keys: Sequence[str] = ("symbol",),
    exact: str | None = None,
) -> DataFrame:
    """Mean price per hour of day."""
    return _by_hour(df, at, keys).agg(exact_avg(F.col(price), exact).alias(price))


def hourly_volatility(
    df: DataFrame,
    volatility: str = "avg_volatility",
    at: str = "collection_time",
    keys: Sequence[str] = ("symbol",),
    exact: str | None = None,
) -> DataFrame:
    """Mean volatility per hour of day, as a ratio and in percent."""
    means = _by_hour(df, at, keys).agg(exact_avg(F.col(volatility), exact).alias(volatility))
    return means.withColumn(f"{volatility}_pct", percent(F.col(volatility)))


def run_summary(df: DataFrame, symbol: str = "symbol", date: str = "trade_date") -> DataFrame:
    """Number of symbols (a null symbol counts as one), latest date and row count, in one row.

    Counting per symbol first keeps the distinct count out of a single task.
    """
    per_symbol = df.groupBy(symbol).agg(F.max(date).alias("_latest"), F.count(F.lit(1)).alias("_rows"))
    return per_symbol.agg(
        F.count(F.lit(1)).alias("total_symbols"),
        F.max("_latest").alias("latest_date"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
    )


def symbols(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    return df.select(symbol).distinct()
