"""Schemas, keys and layouts of the tick tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(kind: T.DataType, names: list[str]) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name in names]


# Column names and types of one tick message.
TICK_SCHEMA = T.StructType(
    _fields(T.StringType(), ["symbol"])
    + _fields(
        T.DoubleType(),
        [
            "current_price",
            "open_price",
            "high_price",
            "low_price",
            "previous_close",
            "price_change",
            "percent_change",
        ],
    )
    + _fields(T.StringType(), ["timestamp", "company_name", "industry"])
    + _fields(T.DoubleType(), ["market_cap"])
    + _fields(T.StringType(), ["country", "currency", "exchange", "ipo_date"])
    + _fields(
        T.DoubleType(),
        [
            "pe_ratio",
            "pb_ratio",
            "eps_ttm",
            "dividend_yield",
            "beta",
            "week_52_high",
            "week_52_low",
            "volume_10day_avg",
            "daily_return",
            "volatility",
            "price_range",
            "price_position",
        ],
    )
)

# RAW: the tick plus ingest stamps.
RAW_SCHEMA = T.StructType(
    TICK_SCHEMA.fields
    + [
        T.StructField("batch_timestamp", T.TimestampType(), True),
        T.StructField("batch_date", T.StringType(), True),
        T.StructField("batch_hour", T.IntegerType(), True),
        T.StructField("processed_timestamp", T.TimestampType(), True),
    ]
)

# ANALYZED: one row per symbol and minute.
ANALYZED_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField("trade_date", T.DateType(), True),
        T.StructField("collection_time", T.TimestampType(), True),
        T.StructField("collection_hour", T.IntegerType(), True),
        T.StructField("collection_minute", T.IntegerType(), True),
        T.StructField("average_price", T.DoubleType(), True),
        T.StructField("avg_market_cap", T.DoubleType(), True),
        T.StructField("avg_pe_ratio", T.DoubleType(), True),
        T.StructField("avg_volatility", T.DoubleType(), True),
        T.StructField("avg_daily_return", T.DoubleType(), True),
        T.StructField("data_points_per_minute", T.IntegerType(), True),
        T.StructField("moving_avg_7_days", T.DoubleType(), True),
        T.StructField("data_count_for_avg", T.LongType(), True),
    ]
)

# DAILY: one row per symbol and day.
DAILY_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("trade_date", T.DateType(), True),
        T.StructField("daily_avg_price", T.DoubleType(), True),
        T.StructField("data_count_for_avg", T.LongType(), True),
        T.StructField("7_day_moving_average", T.DoubleType(), True),
    ]
)

MINUTE_KEY = ["symbol", "trade_date", "collection_hour", "collection_minute"]
DAY_KEY = ["symbol", "trade_date"]

# The message layout partitions RAW by symbol as well; with many symbols that makes one small file per
# symbol and hour, so symbol is a sort column here unless a caller asks for SYMBOL_PARTITIONS.
RAW_PARTITIONS = ["batch_date", "batch_hour"]
SYMBOL_PARTITIONS = ["batch_date", "batch_hour", "symbol"]
ANALYZED_PARTITIONS = ["trade_date"]

# Copies the analyzed table carries under its own names.
METRIC_COPIES = {
    "average_price": "current_price",
    "avg_market_cap": "market_cap",
    "avg_pe_ratio": "pe_ratio",
    "avg_volatility": "volatility",
    "avg_daily_return": "daily_return",
}
