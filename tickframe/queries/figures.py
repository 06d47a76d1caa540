"""Serving and quality queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.operators import quality as Q
from tickframe.operators import rollups as R
from tickframe.operators import serving as S
from tickframe.plans.upkeep import run_freshness
from tickframe.queries.base import ANALYZED_SQL, CENTS, TICKS_SQL, analyzed, naive, query, sql_avg, table, ticks, whole
from tickframe.session import cut_lineage
from tickframe.sources.tables import preview


def _by_event():
    return F.col("event_id").desc()


_NEWEST_SQL = f"""WITH {ANALYZED_SQL},
newest AS (
  SELECT * FROM analyzed QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) = 1
),
kpis AS (
  SELECT symbol, average_price AS price, average_price * 1350.0::DOUBLE AS price_krw,
         avg_daily_return * 100.0::DOUBLE AS return_pct,
         CASE WHEN avg_market_cap > 0 THEN avg_market_cap / 1000.0::DOUBLE END AS cap_billion_usd,
         CASE WHEN avg_market_cap > 0 THEN avg_market_cap / 1000.0::DOUBLE * 1.35::DOUBLE END AS cap_trillion_krw,
         CASE WHEN avg_pe_ratio > 0 THEN avg_pe_ratio END AS pe_ratio,
         CASE WHEN avg_pe_ratio > 0 THEN CASE WHEN avg_pe_ratio < 15 THEN 'low' WHEN avg_pe_ratio <= 25 THEN 'fair'
              ELSE 'high' END END AS pe_band,
         CASE WHEN avg_volatility > 0 THEN avg_volatility * 100.0::DOUBLE END AS volatility_pct
  FROM newest
)"""


@query(f"{_NEWEST_SQL} SELECT * FROM kpis")
def latest_kpi(spark, sf_dir):
    return S.kpis(analyzed(spark, sf_dir), tie=_by_event())


@query(f"""{_NEWEST_SQL}
SELECT symbol, '$' || printf('%.2f', price) AS price_text,
       format('{{:,}}', CAST(round_even(price_krw, 0) AS BIGINT)) AS price_krw_text,
       printf('%.2f', return_pct) || '%' AS return_text,
       coalesce('$' || printf('%.1f', cap_billion_usd) || 'B', 'N/A') AS cap_text,
       printf('%.1f', cap_trillion_krw) AS cap_krw_text,
       coalesce(printf('%.1f', pe_ratio), 'N/A') AS pe_text,
       coalesce(printf('%.2f', volatility_pct) || '%', 'N/A') AS volatility_text
FROM kpis""")
def latest_kpi_texts(spark, sf_dir):
    return S.kpi_texts(S.kpis(analyzed(spark, sf_dir), tie=_by_event()))


def _placed(series):
    """A series with the place of each row in the order it comes in: partitions in turn, and rows within them."""
    rows = cut_lineage(series.withColumn("_number", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_number").alias("_low"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", (F.coalesce(before, F.lit(0)) - F.col("_low") + 1).alias("_shift"))
    placed = rows.join(F.broadcast(starts), "_part").withColumn("place", F.col("_number") + F.col("_shift"))
    return placed.withColumn("collection_time", naive("collection_time")).drop("_number", "_part", "_shift")


@query(f"""WITH {ANALYZED_SQL}
SELECT symbol, collection_time, average_price, moving_avg_7_days, row_number() OVER (ORDER BY symbol, collection_time) AS place
FROM analyzed ORDER BY symbol, collection_time""")
def price_series(spark, sf_dir):
    return _placed(S.price_series(analyzed(spark, sf_dir)))


@query(f"""WITH {ANALYZED_SQL}
SELECT symbol, trade_date, collection_time, avg_market_cap / 1000.0::DOUBLE AS cap_billion_usd,
       row_number() OVER (ORDER BY symbol, collection_time) AS place
FROM analyzed""")
def market_cap_series(spark, sf_dir):
    return _placed(S.market_cap_series(analyzed(spark, sf_dir)))


@query(f"""WITH {ANALYZED_SQL}
SELECT symbol, trade_date, collection_time, avg_pe_ratio, row_number() OVER (ORDER BY symbol, collection_time) AS place FROM analyzed""")
def pe_series(spark, sf_dir):
    return _placed(S.pe_series(analyzed(spark, sf_dir)))


@query(f"""WITH {ANALYZED_SQL}
SELECT event_id, symbol, collection_time, average_price FROM analyzed
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) <= 216
ORDER BY symbol, collection_time""")
def recent_216(spark, sf_dir):
    rows = S.recent_history(analyzed(spark, sf_dir), tie=_by_event()).orderBy("symbol", "collection_time")
    return rows.select("event_id", "symbol", naive("collection_time"), "average_price")


@query(f"""WITH {ANALYZED_SQL}
SELECT symbol, trade_date, {sql_avg("average_price")} AS average_price,
       arg_min(moving_avg_7_days, ts) FILTER (moving_avg_7_days IS NOT NULL) AS moving_avg_7_days
FROM analyzed GROUP BY 1, 2""")
def daily_summary(spark, sf_dir):
    return R.daily_summary(analyzed(spark, sf_dir), exact=CENTS)


@query(f"""WITH {ANALYZED_SQL}
SELECT symbol, hour(ts) AS hour, {sql_avg("average_price")} AS average_price FROM analyzed GROUP BY 1, 2""")
def hourly_price(spark, sf_dir):
    return R.hourly_price(analyzed(spark, sf_dir), exact=CENTS).withColumn("hour", whole("hour"))


@query(f"""WITH {ANALYZED_SQL},
hourly AS (
  SELECT symbol, hour(ts) AS hour, {sql_avg("avg_volatility", "DECIMAL(18,6)")} AS avg_volatility
  FROM analyzed GROUP BY 1, 2)
SELECT *, avg_volatility * 100.0::DOUBLE AS avg_volatility_pct FROM hourly""")
def hourly_volatility(spark, sf_dir):
    return R.hourly_volatility(analyzed(spark, sf_dir), exact="decimal(18,6)").withColumn("hour", whole("hour"))


_SYMBOL = "purchase"


@query(f"""WITH {ANALYZED_SQL}
SELECT symbol AS "종목", collection_time AS "수집시간", trade_date AS "날짜", collection_hour AS "시",
       collection_minute AS "분", average_price AS "평균가격", moving_avg_7_days AS "7일이평",
       round_even(avg_market_cap, 0)::DOUBLE AS "시가총액(M)", avg_pe_ratio AS "P/E비율",
       round_even(avg_volatility * 100.0::DOUBLE, 2)::DOUBLE AS "변동성(%)"
FROM analyzed WHERE symbol = '{_SYMBOL}' ORDER BY collection_time DESC""")
def detail_table(spark, sf_dir):
    """Detail rows of one symbol, newest first."""
    rows = S.detail_table(S.one_symbol(analyzed(spark, sf_dir), _SYMBOL))
    labels = S.KOREAN_LABELS
    return rows.withColumns(
        {
            labels["collection_time"]: naive(labels["collection_time"]),
            labels["collection_hour"]: whole(labels["collection_hour"]),
            labels["collection_minute"]: whole(labels["collection_minute"]),
        }
    )


@query("SELECT event_id, ts, value FROM events WHERE event_type = 'click'")
def symbol_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumnRenamed("event_type", "symbol")
    return S.one_symbol(rows, "click").select("event_id", "ts", "value")


@query("SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def top_latest(spark, sf_dir):
    return Q.newest_rows(table(spark, sf_dir, "events"), 5, "ts", _by_event()).select("event_id", "ts", "value")


@query("SELECT event_id, ts, value FROM events ORDER BY event_id LIMIT 20")
def preview_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "events").select("event_id", "ts", "value").orderBy("event_id"), 20)


@query(f"WITH {ANALYZED_SQL} SELECT collection_time, symbol, average_price FROM analyzed ORDER BY 1 DESC, 2")
def newest_first(spark, sf_dir):
    rows = analyzed(spark, sf_dir).orderBy(F.col("collection_time").desc_nulls_last(), "symbol")
    return rows.select(naive("collection_time"), "symbol", "average_price")


@query("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 1")
def first_match(spark, sf_dir):
    return table(spark, sf_dir, "events").orderBy("ts", "event_id").select("event_id", "ts").limit(1)


def _flawed(spark, sf_dir):
    """Events with holes, not-a-numbers, prices below zero and whole copies."""
    key = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(key % 40 != 3, F.col("ts")).alias("ts"),
        F.when(key % 50 != 0, F.col("event_type")).alias("event_type"),
        F.when(key % 60 == 1, F.lit(float("nan")))
        .when(key % 70 != 2, F.when(key % 33 == 5, -F.col("value")).otherwise(F.col("value")))
        .alias("value"),
    )
    copies = F.when(key % 25 == 4, F.lit(3)).otherwise(F.lit(1))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


_FLAWED_SQL = """
flawed AS (
  SELECT event_id, CASE WHEN event_id % 40 <> 3 THEN ts END AS ts,
         CASE WHEN event_id % 50 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 60 = 1 THEN 'NaN'::DOUBLE
              WHEN event_id % 70 <> 2 THEN CASE WHEN event_id % 33 = 5 THEN -value ELSE value END END AS value
  FROM events, unnest(CASE WHEN event_id % 25 = 4 THEN [1, 2, 3] ELSE [1] END) AS copies(copy)
)"""
_NULLS_SQL = """
  count(*) FILTER (event_id IS NULL) AS {p}event_id, count(*) FILTER (ts IS NULL) AS {p}ts,
  count(*) FILTER (event_type IS NULL) AS {p}event_type,
  count(*) FILTER (value IS NULL OR isnan(value)) AS {p}value"""


@query(f"WITH {_FLAWED_SQL} SELECT {_NULLS_SQL.format(p='')} FROM flawed")
def quality_nulls(spark, sf_dir):
    return Q.null_counts(_flawed(spark, sf_dir))


@query(f"""WITH {_FLAWED_SQL}
SELECT count(*) AS total, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flawed)) AS duplicates FROM flawed""")
def quality_duplicates(spark, sf_dir):
    return Q.quality_report(_flawed(spark, sf_dir), "value").select("total", "duplicates")


@query(f"""WITH {_FLAWED_SQL}
SELECT count(*) AS total,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT event_type, ts FROM flawed)) AS duplicates,
       count(*) FILTER (value <= 0 AND NOT isnan(value)) AS invalid_prices
FROM flawed""")
def quality_duplicates_by_key(spark, sf_dir):
    report = Q.quality_report(_flawed(spark, sf_dir), "value", keys=["event_type", "ts"])
    return report.select("total", "duplicates", "invalid_prices")


@query(f"WITH {_FLAWED_SQL} SELECT count(*) AS invalid_prices FROM flawed WHERE value <= 0 AND NOT isnan(value)")
def quality_invalid(spark, sf_dir):
    return _flawed(spark, sf_dir).filter(F.col("value") <= 0).agg(F.count(F.lit(1)).alias("invalid_prices"))


@query(f"""WITH {_FLAWED_SQL},
report AS (
  SELECT count(*) AS total, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flawed)) AS duplicates,
         count(*) FILTER (value <= 0 AND NOT isnan(value)) AS invalid_prices, {_NULLS_SQL.format(p="nulls_")}
  FROM flawed)
SELECT *, duplicates < total * 0.05 AND invalid_prices = 0
          AND nulls_event_id + nulls_ts + nulls_event_type + nulls_value < total * 0.1 AS passed
FROM report""")
def quality_verdict(spark, sf_dir):
    return Q.quality_report(_flawed(spark, sf_dir), "value")


@query("""
SELECT count(*) AS total, 0::BIGINT AS duplicates, count(*) FILTER (value <= 0) AS invalid_prices,
       count(*) FILTER (value <= 0) = 0 AS passed
FROM events""")
def quality_verdict_clean(spark, sf_dir):
    report = Q.quality_report(table(spark, sf_dir, "events"), "value", max_column_nulls=0.1)
    return report.select("total", "duplicates", "invalid_prices", "passed")


@query(f"""WITH {ANALYZED_SQL}
SELECT count(avg_market_cap) > 0 AS avg_market_cap, count(avg_pe_ratio) > 0 AS avg_pe_ratio,
       false AS avg_volatility, false AS avg_beta
FROM analyzed""")
def column_availability(spark, sf_dir):
    """One column has only nulls and one does not exist."""
    rows = analyzed(spark, sf_dir).withColumn("avg_volatility", F.lit(None).cast("double"))
    return Q.column_availability(rows, ["avg_market_cap", "avg_pe_ratio", "avg_volatility", "avg_beta"])


@query(f"""WITH {_FLAWED_SQL}
SELECT 1::BIGINT AS position, 'event_id' AS column_name, 'bigint' AS column_type, count(*) AS row_count,
       count(event_id) AS non_null FROM flawed
UNION ALL SELECT 2, 'ts', 'timestamp_ntz', count(*), count(ts) FROM flawed
UNION ALL SELECT 3, 'event_type', 'string', count(*), count(event_type) FROM flawed
UNION ALL SELECT 4, 'value', 'double', count(*), count(value) FROM flawed""")
def dataset_profile(spark, sf_dir):
    return Q.profile(_flawed(spark, sf_dir)).withColumn("position", whole("position"))


@query(f"WITH {TICKS_SQL} SELECT ts AS processed_timestamp, CAST(ts AS DATE) AS trade_date, symbol FROM ticks")
def time_columns(spark, sf_dir):
    rows = ticks(spark, sf_dir).withColumns(
        {"trade_date": F.to_date("ts"), "processed_timestamp": naive("processed_timestamp")}
    )
    return Q.time_columns(rows)


@query("""
SELECT 'events' AS dataset, max(ts) IS NOT NULL AS has_data, max(ts) AS latest,
       CAST(floor(epoch(TIMESTAMP '2024-01-31 02:00:00')) - floor(epoch(max(ts))) AS BIGINT) AS lag_seconds,
       CAST(floor(epoch(TIMESTAMP '2024-01-31 02:00:00')) - floor(epoch(max(ts))) AS BIGINT) <= 10800 AS fresh FROM events
UNION ALL
SELECT 'orders', max(o_orderdate) IS NOT NULL, max(o_orderdate),
       CAST(floor(epoch(TIMESTAMP '2024-01-31 02:00:00')) - floor(epoch(max(o_orderdate))) AS BIGINT),
       CAST(floor(epoch(TIMESTAMP '2024-01-31 02:00:00')) - floor(epoch(max(o_orderdate))) AS BIGINT) <= 10800 FROM orders""")
def freshness(spark, sf_dir):
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    frames = {"events": (events, "ts"), "orders": (orders, "o_orderdate")}
    return run_freshness(frames, F.lit("2024-01-31 02:00:00").cast("timestamp"))
