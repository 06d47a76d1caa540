"""Averages, trailing figures, deduplication and incremental analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.functions.times import minute_key_text, time_parts
from tickframe.operators.dedup import best_per_key, latest_per_minute, serving_rows
from tickframe.operators.incremental import analyze_new, continue_trailing, drop_processed, history_tails, minute_rows
from tickframe.operators.rolling import EXACT, trailing_range, trailing_rows, trailing_rows_chunked
from tickframe.operators.rollups import daily_average, daily_moving_average, run_summary, symbols
from tickframe.plans.analyze import repaired
from tickframe.queries.base import (
    ANALYZED_SQL,
    CENTS,
    MINUTES_SQL,
    TICKS_SQL,
    analyzed,
    dedup_options,
    minutes,
    naive,
    query,
    sql_avg,
    table,
    ticks,
    whole,
)
from tickframe.schemas import DAY_KEY
from tickframe.session import cut_lineage

_DAILY_SQL = f"""
daily AS (
  SELECT user_id AS symbol, CAST(ts AS DATE) AS trade_date, {sql_avg("value")} AS daily_avg_price,
         count(value) AS data_count_for_avg
  FROM events GROUP BY 1, 2
)"""


def _daily(spark, sf_dir):
    return daily_average(table(spark, sf_dir, "events"), "value", "ts", "user_id", exact=CENTS)


@query(f"WITH {_DAILY_SQL} SELECT * FROM daily")
def daily_avg(spark, sf_dir):
    return _daily(spark, sf_dir)


@query(f"""WITH {_DAILY_SQL}
SELECT *, avg(daily_avg_price) OVER (
  PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS "7_day_moving_average"
FROM daily ORDER BY symbol, trade_date""")
def daily_ma7(spark, sf_dir):
    return daily_moving_average(_daily(spark, sf_dir)).orderBy("symbol", "trade_date")


_TRAILING = ("moving_avg_7_days", "data_count_for_avg")
_TRAILING_SQL = """
SELECT event_id, event_type AS symbol,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(value) OVER w AS moving_avg_7_days,
       count(value) OVER w AS data_count_for_avg
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)"""


def _priced(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("symbol"), "ts", "value")


@query(_TRAILING_SQL)
def tick_ma168(spark, sf_dir):
    rows = trailing_rows(_priced(spark, sf_dir), "value", 168, *_TRAILING, order=("ts", "event_id"), exact=CENTS)
    return rows.select("event_id", "symbol", *_TRAILING)


@query(_TRAILING_SQL)
def tick_ma168_chunked(spark, sf_dir):
    """Every symbol cut into chunks, the way a symbol with very many rows is handled."""
    rows = trailing_rows_chunked(
        _priced(spark, sf_dir), "value", 168, *_TRAILING, order=("ts", "event_id"), exact=CENTS, chunk_rows=1000
    )
    return rows.select("event_id", "symbol", *_TRAILING)


@query("""
SELECT event_id, event_type AS symbol,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(value) OVER w AS moving_avg_7_days,
       count(value) OVER w AS data_count_for_avg
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""")
def tick_ma_7d_range(spark, sf_dir):
    rows = trailing_range(_priced(spark, sf_dir), "value", 7 * 86400, *_TRAILING, at="ts", exact=CENTS)
    return rows.select("event_id", "symbol", *_TRAILING)


_ODD = "event_id % 41"
_ODD_TEXTS = {1: "NaN", 2: "Infinity", 3: "-Infinity", 4: "1e21", 5: "0.123456789", 6: "1e40"}
_ODD_DECIMALS = {4: "1000000000000000000000", 5: "0.123456789"}


def _cases(texts, kind, otherwise):
    whens = " ".join(f"WHEN {k} THEN CAST('{t}' AS {kind})" for k, t in texts.items())
    return f"CASE {_ODD} {whens} {otherwise} END"


_EXTREMES_PARTS = """CAST(sum(number) OVER {w} AS DOUBLE) / count(*) FILTER (present) OVER {w} AS mean,
         count(*) FILTER (present) OVER {w} AS n, count(*) FILTER (odd = 1) OVER {w} AS nan,
         count(*) FILTER (odd = 2) OVER {w} AS up, count(*) FILTER (odd = 3) OVER {w} AS down, count(*) FILTER (odd = 6) OVER {w} AS lost"""
_EXTREMES_TEXT = """CASE WHEN nan > 0 OR (up > 0 AND down > 0) THEN 'NaN' WHEN up > 0 THEN 'Infinity' WHEN down > 0 THEN '-Infinity'
            WHEN lost > 0 OR n = 0 THEN 'none' WHEN abs(mean) < 1e12 THEN 'number' ELSE printf('%.9e', mean) END"""
_EXTREMES_MEAN = "CASE WHEN nan + up + down + lost = 0 AND abs(mean) < 1e12 THEN mean END"


@query(f"""
WITH v AS (
  SELECT event_id, user_id, ts, {_ODD} AS odd, {_ODD} <> 7 AS present,
         {_cases(_ODD_DECIMALS, "DECIMAL(38,9)", f"WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 6 THEN 0 WHEN 7 THEN 0 ELSE CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,9))")} AS number
  FROM events
),
spans AS (
  SELECT event_id, {_EXTREMES_PARTS.format(w="r")} FROM v
  WINDOW r AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)
),
counted AS (
  SELECT event_id, {_EXTREMES_PARTS.format(w="o")} FROM v
  WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
),
s AS (SELECT event_id, {_EXTREMES_TEXT} AS range_kind, {_EXTREMES_MEAN} AS range_mean, n AS range_n FROM spans),
c AS (SELECT event_id, {_EXTREMES_TEXT} AS rows_kind, {_EXTREMES_MEAN} AS rows_mean, n AS rows_n FROM counted)
SELECT s.event_id, range_kind, range_mean, range_n, rows_kind, rows_mean, rows_n FROM s JOIN c ON c.event_id = s.event_id""")
def trailing_range_extremes(spark, sf_dir):
    """Frames by time and by rows over NaN, infinities, 22 digits, nine decimals and values too large for the type."""
    value = F.expr(_cases(_ODD_TEXTS, "DOUBLE", "WHEN 7 THEN NULL ELSE value"))
    rows = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("symbol"), "ts", value.alias("value"))
    rows = trailing_rows(rows, "value", 7, "rows_mean", "rows_n", order=("ts", "event_id"), exact=EXACT)
    rows = trailing_range(rows, "value", 7 * 86400, "range_mean", "range_n", at="ts", exact=EXACT)

    def shown(frame):
        mean = F.col(f"{frame}_mean")
        plain = F.abs(mean) < 1e12
        large = F.when(F.abs(mean) < float("inf"), F.format_string("%.9e", mean)).otherwise(mean.cast("string"))
        kind = F.when(mean.isNull(), "none").when(plain, "number").otherwise(large)
        return [kind.alias(f"{frame}_kind"), F.when(plain, mean).alias(f"{frame}_mean"), f"{frame}_n"]

    return rows.select("event_id", *shown("range"), *shown("rows"))


_COPIES_SQL = (
    TICKS_SQL
    + """,
copies AS (
  SELECT *, date_trunc('hour', ts) + INTERVAL 1 HOUR AS batch_timestamp FROM ticks
  UNION ALL
  SELECT *, date_trunc('hour', ts) + INTERVAL 2 HOUR AS batch_timestamp FROM ticks WHERE event_id % 3 = 0
)"""
)


def _reingested(spark, sf_dir):
    """Ticks in hourly batches; every third one was ingested again an hour later."""
    hour = F.date_trunc("hour", "processed_timestamp")
    batches = F.array(F.lit(1), F.when(F.col("event_id") % 3 == 0, F.lit(2)))
    return (
        ticks(spark, sf_dir)
        .withColumn("batch", F.explode(F.array_compact(batches)))
        .withColumn("batch_timestamp", hour + F.make_dt_interval(hours=F.col("batch")))
        .drop("batch")
    )


@query(f"""WITH {_COPIES_SQL}
SELECT event_id, symbol, batch_timestamp, CAST(ts AS DATE) AS trade_date, ts AS collection_time,
       hour(ts) AS collection_hour, minute(ts) AS collection_minute, current_price
FROM copies
QUALIFY row_number() OVER (
  PARTITION BY symbol, date_trunc('minute', ts) ORDER BY batch_timestamp DESC, ts DESC, event_id DESC) = 1""")
def dedup_minute_latest(spark, sf_dir):
    newest = latest_per_minute(time_parts(_reingested(spark, sf_dir)), tie=F.col("event_id").desc())
    return newest.select(
        "event_id", "symbol", naive("batch_timestamp"), "trade_date", naive("collection_time"),
        whole("collection_hour"), whole("collection_minute"), "current_price",
    )


def _with_gaps(spark, sf_dir):
    price = F.when(F.col("event_id") % 4 != 1, F.col("current_price"))
    return time_parts(ticks(spark, sf_dir).withColumn("current_price", price))


_GAPS_SQL = (
    TICKS_SQL
    + """,
gaps AS (
  SELECT event_id, symbol, ts, CASE WHEN event_id % 4 <> 1 THEN current_price END AS current_price FROM ticks
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY symbol, date_trunc('minute', ts) ORDER BY ts DESC, event_id DESC) AS n
  FROM gaps {where}
)
SELECT event_id, symbol, current_price, 1::BIGINT AS data_points_per_minute
FROM ranked WHERE n = 1 AND current_price IS NOT NULL"""
)


@query("WITH " + _GAPS_SQL.format(where=""))
def missing_price_after_dedup(spark, sf_dir):
    rows = minute_rows(_with_gaps(spark, sf_dir), **dedup_options())
    return rows.select("event_id", "symbol", "current_price", whole("data_points_per_minute"))


@query("WITH " + _GAPS_SQL.format(where="WHERE current_price IS NOT NULL"))
def missing_price_before_dedup(spark, sf_dir):
    rows = minute_rows(_with_gaps(spark, sf_dir), drop_missing_first=True, **dedup_options())
    return rows.select("event_id", "symbol", "current_price", whole("data_points_per_minute"))


@query(f"""WITH {ANALYZED_SQL}
SELECT event_id, symbol, trade_date, moving_avg_7_days, average_price FROM analyzed
QUALIFY row_number() OVER (PARTITION BY symbol, trade_date
  ORDER BY moving_avg_7_days DESC NULLS LAST, average_price DESC NULLS LAST, event_id DESC) = 1""")
def best_row_per_day(spark, sf_dir):
    best = best_per_key(analyzed(spark, sf_dir), DAY_KEY, tie=F.col("event_id").desc())
    return best.select("event_id", *DAY_KEY, "moving_avg_7_days", "average_price")


@query(f"""WITH {ANALYZED_SQL}
SELECT event_id, symbol, date_trunc('hour', ts) AS collection_time, moving_avg_7_days, average_price, data_count_for_avg
FROM analyzed
QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('hour', ts)
  ORDER BY moving_avg_7_days DESC NULLS LAST, average_price DESC NULLS LAST, data_count_for_avg DESC NULLS LAST,
           event_id DESC) = 1
ORDER BY symbol, collection_time""")
def serving_dedup(spark, sf_dir):
    hourly = analyzed(spark, sf_dir).withColumn("collection_time", F.date_trunc("hour", "collection_time"))
    best = serving_rows(hourly, tie=F.col("event_id").desc()).orderBy("symbol", "collection_time")
    return best.select(
        "event_id", "symbol", naive("collection_time"), "moving_avg_7_days", "average_price", "data_count_for_avg"
    )


@query(f"""WITH {ANALYZED_SQL}
SELECT event_id, symbol, trade_date, average_price FROM analyzed
QUALIFY row_number() OVER (PARTITION BY symbol, trade_date
  ORDER BY moving_avg_7_days DESC NULLS LAST, average_price DESC NULLS LAST, data_count_for_avg DESC NULLS LAST,
           event_id DESC) = 1""")
def serving_dedup_old_layout(spark, sf_dir):
    """A table without an instant is deduplicated by day."""
    old = analyzed(spark, sf_dir).drop("collection_time", "collection_hour", "collection_minute")
    return serving_rows(old, tie=F.col("event_id").desc()).select("event_id", *DAY_KEY, "average_price")


def _before_split():
    return F.col("trade_date") < F.lit("2024-01-16").cast("date")


@query(f"""WITH {MINUTES_SQL}
SELECT event_id, symbol, trade_date, collection_hour, collection_minute FROM minutes m
WHERE NOT EXISTS (SELECT 1 FROM minutes h WHERE h.trade_date < DATE '2024-01-16' AND h.symbol = m.symbol
  AND h.trade_date = m.trade_date AND h.collection_hour = m.collection_hour
  AND h.collection_minute = m.collection_minute)""")
def incremental_new_minutes(spark, sf_dir):
    rows = minutes(spark, sf_dir)
    new = drop_processed(rows, rows.filter(_before_split()))
    return new.select("event_id", "symbol", "trade_date", whole("collection_hour"), whole("collection_minute"))


@query(f"WITH {MINUTES_SQL} SELECT DISTINCT symbol, trade_date, collection_hour FROM minutes")
def processed_hours(spark, sf_dir):
    """Distinct keys, at the grain of an hour."""
    keys = minutes(spark, sf_dir).select("symbol", "trade_date", whole("collection_hour"))
    return keys.distinct()


@query(f"""WITH {MINUTES_SQL}
SELECT event_id, symbol || '_' || strftime(trade_date, '%Y-%m-%d') || '_' || collection_hour || '_' || collection_minute
  AS minute_key
FROM minutes""")
def minute_keys(spark, sf_dir):
    key = minute_key_text(*[F.col(c) for c in ("symbol", "trade_date", "collection_hour", "collection_minute")])
    return minutes(spark, sf_dir).select("event_id", key.alias("minute_key"))


def _incremental(spark, sf_dir, in_history, **options):
    parts = time_parts(ticks(spark, sf_dir))
    history = minute_rows(parts, **dedup_options()).filter(in_history)
    # A stored table has its tails beside it; here they come from the history itself.
    tails = cut_lineage(history_tails(history))
    rows = analyze_new(parts, history, dedup=dedup_options(), tails=tails, exact=CENTS, **options)
    return rows.select("event_id", "symbol", *_TRAILING)


_ANALYZED_PART = f"WITH {ANALYZED_SQL} SELECT event_id, symbol, moving_avg_7_days, data_count_for_avg FROM analyzed"


@query(f"{_ANALYZED_PART} WHERE trade_date >= DATE '2024-01-16'")
def incremental_ma_equals_full(spark, sf_dir):
    return _incremental(spark, sf_dir, _before_split())


@query(f"{_ANALYZED_PART} WHERE collection_minute = 30")
def incremental_late_minutes(spark, sf_dir):
    """Minutes that arrive after later ones were analysed still get the figures of a full run."""
    return _incremental(spark, sf_dir, F.col("collection_minute") != 30)


@query(f"{_ANALYZED_PART}")
def incremental_first_run(spark, sf_dir):
    return _incremental(spark, sf_dir, F.lit(False))


@query(f"""WITH {MINUTES_SQL},
ranged AS (
  SELECT *, CAST(sum(CAST(average_price AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(average_price) OVER w
      AS moving_avg_7_days, count(average_price) OVER w AS data_count_for_avg
  FROM minutes
  WINDOW w AS (PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)
)
SELECT event_id, symbol, moving_avg_7_days, data_count_for_avg FROM ranged WHERE trade_date >= DATE '2024-01-16'""")
def incremental_7d_range(spark, sf_dir):
    return _incremental(spark, sf_dir, _before_split(), frame="range")


@query(f"{_ANALYZED_PART} WHERE trade_date >= DATE '2024-01-20'")
def incremental_repair(spark, sf_dir):
    """Late minutes of the 20th on: that date and all later ones are recomputed."""
    late = (F.col("trade_date") >= F.lit("2024-01-20").cast("date")) & (F.col("collection_minute") >= 30)
    parts = time_parts(ticks(spark, sf_dir))
    history = minute_rows(parts, **dedup_options()).filter(~late)
    rows = repaired(parts, history, dedup_options(), exact=CENTS)
    return rows.select("event_id", "symbol", *_TRAILING)


@query(f"{_ANALYZED_PART}")
def history_union(spark, sf_dir):
    """Old and new rows together: the accumulated table."""
    rows = minutes(spark, sf_dir)
    old, new = rows.filter(_before_split()), rows.filter(~_before_split())
    first = continue_trailing(old.limit(0), old, exact=CENTS)
    second = continue_trailing(old, new, exact=CENTS)
    return first.unionByName(second, allowMissingColumns=True).select("event_id", "symbol", *_TRAILING)


@query(f"""WITH {MINUTES_SQL}
SELECT count(DISTINCT symbol) AS total_symbols, max(trade_date) AS latest_date, count(*) AS total_rows FROM minutes""")
def run_summary_row(spark, sf_dir):
    return run_summary(minutes(spark, sf_dir))


@query("SELECT DISTINCT user_id AS symbol FROM events")
def distinct_symbols(spark, sf_dir):
    return symbols(table(spark, sf_dir, "events").withColumnRenamed("user_id", "symbol"))
