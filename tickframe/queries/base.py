"""Registry of queries over the given tables, and the tick view they share.

``events`` serves as a tick table: ``event_type`` is the symbol of minute-level queries and ``user_id`` that of daily
ones, ``value`` is the price and ``ts`` the event time. The further tick columns are expressions of ``value`` and of the
number in ``props``, written once here for Spark and once for SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.functions.times import time_parts
from tickframe.operators.incremental import minute_rows, with_trailing
from tickframe.operators.indicators import derive_indicators

CENTS = "decimal(18,2)"


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        in_utc.__doc__ = run.__doc__
        QUERIES[run.__name__] = Query(in_utc, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number_in_props() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def base_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under tick names, without indicators."""
    k = F.col("k")
    close = F.col("value") * (F.lit(50) + k) / F.lit(100.0)
    step = F.when(k % 3 == 0, 1.0).otherwise(0.0)
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", number_in_props())
        .select(
            "event_id",
            F.col("event_type").alias("symbol"),
            "ts",
            F.col("ts").cast("timestamp").alias("processed_timestamp"),
            F.col("value").alias("current_price"),
            close.alias("previous_close"),
            (F.greatest("value", close) + step).alias("high_price"),
            (F.least("value", close) - step).alias("low_price"),
            F.when(F.col("event_id") % 50 != 7, k * F.lit(1000.5)).alias("market_cap"),
            (k / F.lit(3.0)).alias("pe_ratio"),
        )
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_indicators(base_ticks(spark, sf_dir))


def dedup_options() -> dict:
    return {"recency": ("processed_timestamp",), "tie": F.col("event_id").desc()}


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute_rows(time_parts(ticks(spark, sf_dir)), **dedup_options())


def analyzed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_trailing(minutes(spark, sf_dir), exact=CENTS)


def naive(name: str, alias: str | None = None):
    """A UTC instant as a zone-free timestamp, the type the tables use."""
    return F.col(name).cast("timestamp_ntz").alias(alias or name)


def whole(name: str, alias: str | None = None):
    return F.col(name).cast("bigint").alias(alias or name)


TICKS_SQL = """
base AS (
  SELECT event_id, event_type AS symbol, ts, value AS current_price, k,
         value * (50 + k) / 100.0::DOUBLE AS previous_close
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
quoted AS (
  SELECT event_id, symbol, ts, current_price, previous_close,
         greatest(current_price, previous_close) + CASE WHEN k % 3 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS high_price,
         least(current_price, previous_close) - CASE WHEN k % 3 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS low_price,
         CASE WHEN event_id % 50 <> 7 THEN k * 1000.5::DOUBLE END AS market_cap,
         k / 3.0::DOUBLE AS pe_ratio
  FROM base
),
ticks AS (
  SELECT *,
         CASE WHEN previous_close > 0 THEN (current_price - previous_close) / previous_close END AS daily_return,
         CASE WHEN previous_close > 0 THEN abs((current_price - previous_close) / previous_close) END AS volatility,
         CASE WHEN previous_close > 0 THEN high_price - low_price END AS price_range,
         CASE WHEN previous_close > 0 THEN
           CASE WHEN high_price - low_price > 0 THEN (current_price - low_price) / (high_price - low_price)
                ELSE 0.5::DOUBLE END END AS price_position
  FROM quoted
)"""

MINUTES_SQL = (
    TICKS_SQL
    + """,
minutes AS (
  SELECT *, CAST(ts AS DATE) AS trade_date, ts AS collection_time,
         hour(ts) AS collection_hour, minute(ts) AS collection_minute,
         current_price AS average_price, market_cap AS avg_market_cap, pe_ratio AS avg_pe_ratio,
         volatility AS avg_volatility, daily_return AS avg_daily_return
  FROM ticks
  QUALIFY row_number() OVER (
    PARTITION BY symbol, date_trunc('minute', ts) ORDER BY ts DESC, event_id DESC) = 1
)"""
)

ANALYZED_SQL = (
    MINUTES_SQL
    + """,
analyzed AS (
  SELECT *,
         CAST(sum(CAST(average_price AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(average_price) OVER w
           AS moving_avg_7_days,
         count(average_price) OVER w AS data_count_for_avg
  FROM minutes
  WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)
)"""
)


def sql_avg(value: str, decimal: str = "DECIMAL(18,2)") -> str:
    return f"CAST(sum(CAST({value} AS {decimal})) AS DOUBLE) / count({value})"
