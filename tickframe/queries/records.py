"""Messages, time stamps, indicators, defaults, enrichment and universes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.functions import numbers as N
from tickframe.functions.times import (
    epoch_text,
    in_collection_hours,
    in_market_session,
    ingest_stamps,
    iso_text,
    time_parts,
)
from tickframe.operators.enrich import PROFILE_NUMBER_KEYS, PROFILE_TEXT_KEYS, enrich, metric_rows, profile_rows, quote_rows
from tickframe.operators.enrich import enrich_as_of as as_of
from tickframe.operators.enrich import quote_quarantine as rejected_quotes
from tickframe.operators.indicators import derive_indicators
from tickframe.operators.universe import parse_symbols, restrict, top_symbols
from tickframe.plans.collect import collect_ticks
from tickframe.plans.ingest import decode, good_rows, quarantine_rows, stamp
from tickframe.queries.base import TICKS_SQL, base_ticks, naive, query, table, ticks, whole
from tickframe.session import new_path
from tickframe.sources.messages import parse_documents, read_messages
from tickframe.sources.sinks import encode_messages, write_messages

BATCH = "2024-02-01 12:34:56"
MESSAGE_FIELDS = [
    "symbol", "current_price", "high_price", "low_price", "previous_close", "timestamp", "market_cap", "pe_ratio",
    "daily_return", "volatility", "price_range", "price_position",
]


def batch_instant():
    return F.lit(BATCH).cast("timestamp")


def messages(spark, sf_dir, where=None):
    """Every event as the JSON message a poller would have sent."""
    rows = ticks(spark, sf_dir)
    sent = (rows if where is None else rows.filter(where)).withColumn("timestamp", iso_text(F.col("processed_timestamp")))
    return encode_messages(sent, columns=MESSAGE_FIELDS)


_DECODED = ["symbol", "current_price", "previous_close", "market_cap", "pe_ratio", "volatility", "price_position"]
_DECODED_SQL = f"WITH {TICKS_SQL} SELECT ts AS processed_timestamp, {', '.join(_DECODED)} FROM ticks"


@query("""
SELECT symbol, current_price, CAST(ts AS VARCHAR) AS timestamp, currency FROM (
  SELECT event_type AS symbol, value AS current_price, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts,
         CASE WHEN event_id % 2 = 0 THEN 'USD' END AS currency
  FROM events)""")
def json_decode(spark, sf_dir):
    """Fields that a message leaves out are null; fields the schema does not have are ignored."""
    text = F.format_string(
        '{"symbol":"%s","current_price":%s,"timestamp":"%s"%s,"market_timestamp":"x"}',
        F.col("event_type"), F.col("value").cast("string"), iso_text(F.col("ts")),
        F.when(F.col("event_id") % 2 == 0, ',"currency":"USD"').otherwise(""),
    )
    sent = table(spark, sf_dir, "events").select(text.cast("binary").alias("value"))
    return decode(sent).select("symbol", "current_price", "timestamp", "currency")


@query(_DECODED_SQL)
def json_roundtrip(spark, sf_dir):
    return good_rows(stamp(decode(messages(spark, sf_dir)), batch_instant())).select(
        naive("processed_timestamp"), *_DECODED
    )


@query(_DECODED_SQL)
def message_file_sink(spark, sf_dir):
    """The same, with the messages written to and read from files."""
    path = new_path(spark, "messages")
    write_messages(messages(spark, sf_dir), "parquet", path)
    received = read_messages(spark, "parquet", path, "key string, value binary")
    return good_rows(stamp(decode(received), batch_instant())).select(naive("processed_timestamp"), *_DECODED)


def _faulty(spark, sf_dir):
    kind = F.col("event_id") % 10
    symbol, at = F.col("event_type"), iso_text(F.col("ts"))
    text = (
        F.when(kind == 0, F.lit("{bad"))
        .when(kind == 1, F.format_string('{"symbol":"%s","current_price":"x","timestamp":"%s"}', symbol, at))
        .when(kind == 2, F.lit(None))
        .when(kind == 3, F.format_string('{"current_price":1.5,"timestamp":"%s"}', at))
        .when(kind == 4, F.format_string('{"symbol":"%s","current_price":1.5,"timestamp":"xx"}', symbol))
        .otherwise(F.format_string('{"symbol":"%s","current_price":1.5,"timestamp":"%s"}', symbol, at))
    )
    return table(spark, sf_dir, "events").select(text.cast("binary").alias("value"))


@query("""
SELECT event_type AS symbol, CASE WHEN event_id % 10 <> 1 THEN 1.5::DOUBLE END AS current_price,
       ts AS processed_timestamp
FROM events WHERE event_id % 10 NOT IN (0, 2, 3, 4)""")
def json_malformed_kept(spark, sf_dir):
    """A wrongly typed field is null and its record stays."""
    rows = good_rows(stamp(decode(_faulty(spark, sf_dir)), batch_instant()))
    return rows.select("symbol", "current_price", naive("processed_timestamp"))


@query("""
SELECT CASE event_id % 10 WHEN 0 THEN 'malformed' WHEN 2 THEN 'no_value' WHEN 3 THEN 'no_symbol' ELSE 'no_time' END
  AS reason, count(*) AS n
FROM events WHERE event_id % 10 IN (0, 2, 3, 4) GROUP BY 1""")
def json_malformed_quarantine(spark, sf_dir):
    bad = quarantine_rows(stamp(decode(_faulty(spark, sf_dir)), batch_instant()))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT event_id, TIMESTAMP '{BATCH}' AS batch_timestamp, '{BATCH[:10]}' AS batch_date, 12::BIGINT AS batch_hour,
       CASE WHEN event_id % 20 <> 0 THEN ts END AS processed_timestamp
FROM events""")
def ingest_stamp_columns(spark, sf_dir):
    text = F.when(F.col("event_id") % 20 == 0, "xx").otherwise(iso_text(F.col("ts")))
    rows = ingest_stamps(table(spark, sf_dir, "events").withColumn("timestamp", text), batch_instant())
    return rows.select(
        "event_id", naive("batch_timestamp"), "batch_date", whole("batch_hour"), naive("processed_timestamp")
    )


@query("""
SELECT event_id, CAST(ts AS DATE) AS trade_date, ts AS collection_time, hour(ts) AS collection_hour,
       minute(ts) AS collection_minute, isodow(ts) - 1 AS weekday
FROM events""")
def time_part_columns(spark, sf_dir):
    rows = time_parts(base_ticks(spark, sf_dir)).withColumn("weekday", F.weekday("collection_time"))
    return rows.select(
        "event_id", "trade_date", naive("collection_time"), whole("collection_hour"), whole("collection_minute"),
        whole("weekday"),
    )


@query("""
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS market_timestamp,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM events""")
def time_texts(spark, sf_dir):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_text(seconds).alias("market_timestamp"), iso_text(F.col("ts")).alias("timestamp")
    )


_INDICATORS = ["daily_return", "volatility", "price_range", "price_position"]


@query("""
WITH q AS (
  SELECT event_id, value AS price, value + event_id % 4 AS high, value - event_id % 2 AS low,
         CASE event_id % 11 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN NULL ELSE value * 1.25::DOUBLE END AS close
  FROM events)
SELECT event_id,
       CASE WHEN close > 0 THEN (price - close) / close END AS daily_return,
       CASE WHEN close > 0 THEN abs((price - close) / close) END AS volatility,
       CASE WHEN close > 0 THEN high - low END AS price_range,
       CASE WHEN close > 0 THEN CASE WHEN high - low > 0 THEN (price - low) / (high - low) ELSE 0.5::DOUBLE END END
         AS price_position
FROM q""")
def tick_indicators(spark, sf_dir):
    """Without a previous close, or with one of zero, there are no indicators; a flat range puts the price in the middle."""
    value, key = F.col("value"), F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        value.alias("current_price"),
        (value + key % 4).alias("high_price"),
        (value - key % 2).alias("low_price"),
        F.when(key % 11 == 0, 0.0).when(key % 11 != 1, value * F.lit(1.25)).alias("previous_close"),
    )
    return derive_indicators(rows).select("event_id", *_INDICATORS)


@query("""
WITH bars AS (
  SELECT user_id AS symbol, CAST(ts AS DATE) AS trade_date, arg_min(value, (ts, event_id)) AS open_price,
         max(value) AS high_price, min(value) AS low_price, arg_max(value, (ts, event_id)) AS current_price
  FROM events GROUP BY 1, 2
), chained AS (
  SELECT *, lag(current_price) OVER (PARTITION BY symbol ORDER BY trade_date) AS previous_close FROM bars
)
SELECT symbol, trade_date, open_price, high_price, low_price, current_price, previous_close,
       CASE WHEN previous_close > 0 THEN (current_price - previous_close) / previous_close END AS daily_return,
       CASE WHEN previous_close > 0 THEN abs((current_price - previous_close) / previous_close) END AS volatility,
       CASE WHEN previous_close > 0 THEN high_price - low_price END AS price_range,
       CASE WHEN previous_close > 0 THEN CASE WHEN high_price - low_price > 0
         THEN (current_price - low_price) / (high_price - low_price) ELSE 0.5::DOUBLE END END AS price_position
FROM chained""")
def bars_indicators(spark, sf_dir):
    """Indicators over daily bars; a bar's previous close is the close of the symbol's bar before it."""
    order = F.struct("ts", "event_id")
    bars = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("symbol"), F.to_date("ts").alias("trade_date"))
        .agg(
            F.min_by("value", order).alias("open_price"),
            F.max("value").alias("high_price"),
            F.min("value").alias("low_price"),
            F.max_by("value", order).alias("current_price"),
        )
    )
    days = Window.partitionBy("symbol").orderBy("trade_date")
    return derive_indicators(bars.withColumn("previous_close", F.lag("current_price").over(days)))


def _number_text():
    kind = F.col("event_id") % 12
    value = F.col("value").cast("string")
    return (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, "null")
        .when(kind == 2, "None")
        .when(kind == 3, "")
        .when(kind == 4, "abc")
        .when(kind == 5, "0")
        .when(kind == 6, F.concat(value, F.lit("d")))
        .when(kind == 7, F.concat(F.lit(" "), value, F.lit(" ")))
        .when(kind == 8, F.concat(F.lit("-"), value))
        .when(kind == 9, "1_000.5")
        .when(kind == 10, "0x1p3")
        .otherwise(value)
    )


@query("""
SELECT event_id, CASE
    WHEN event_id % 12 IN (7, 11) THEN value WHEN event_id % 12 = 8 THEN -value
    WHEN event_id % 12 = 9 THEN 1000.5::DOUBLE ELSE 0.0::DOUBLE END AS number
FROM events""")
def safe_numbers(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", N.safe_number(_number_text()).alias("number"))


@query("""
SELECT event_id, CASE event_id % 5 WHEN 1 THEN 0.0::DOUBLE ELSE value END AS current_price,
       CASE event_id % 3 WHEN 0 THEN 0.0::DOUBLE ELSE value END AS open_price,
       0.0::DOUBLE AS previous_close,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
       strftime(make_timestamp(event_id * 1000000), '%Y-%m-%dT%H:%M:%S') AS market_timestamp
FROM events WHERE event_id % 5 NOT IN (0, 2) AND (event_id % 5 = 1 OR value <> 0)""")
def quote_defaults(spark, sf_dir):
    """Zero price: no quote. Absent price: 0.0. Unreadable price: unusable record."""
    kind = F.col("event_id") % 5
    price = F.when(kind == 0, "0").when(kind == 2, "n/a").when(kind != 1, F.col("value").cast("string"))
    quotes = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("symbol"),
        price.alias("c"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("o"),
        F.col("event_id").alias("t"),
        F.col("ts").alias("polled_at"),
    )
    return quote_rows(quotes).select(
        F.col("symbol").alias("event_id"), "current_price", "open_price", "previous_close", "timestamp",
        "market_timestamp",
    )


@query("""
SELECT c_custkey AS symbol, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END AS company_name,
       c_mktsegment AS industry, CASE WHEN c_custkey % 3 = 0 THEN 'USD' ELSE 'EUR' END AS currency, '' AS exchange,
       CASE WHEN c_custkey % 5 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS market_cap
FROM customer""")
def profile_defaults(spark, sf_dir):
    documents = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("symbol"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("name"),
        F.col("c_mktsegment").alias("industry"),
        F.when(F.col("c_custkey") % 3 != 0, "EUR").alias("currency"),
        F.when(F.col("c_custkey") % 5 == 0, "none").otherwise(F.col("c_acctbal").cast("string"))
        .alias("marketCapitalization"),
    )
    rows = profile_rows(documents)
    return rows.select("symbol", "company_name", "industry", "currency", "exchange", "market_cap")


def _order_ticks(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tick"),
        F.col("o_custkey").alias("symbol"),
        F.col("o_totalprice").alias("current_price"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("o_orderkey").cast("int") % 24)).alias("timestamp"),
    )


def _order_profiles(spark, sf_dir):
    """Profiles of all customers but those of one segment, whose lookups fail."""
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    documents = customers.filter("c_mktsegment <> 'BUILDING'").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("symbol"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("country"),
        F.col("c_acctbal").alias("marketCapitalization"),
    )
    return profile_rows(documents).select("symbol", "company_name", "country", "market_cap")


def _order_metrics(spark, sf_dir):
    """Metrics of customers with a positive balance."""
    documents = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("symbol"), (F.col("c_acctbal") / 100.0).alias("beta")
    )
    return metric_rows(documents).select("symbol", "beta")


_ENRICHED_SQL = """
SELECT o_orderkey AS tick, o_custkey AS symbol, o_totalprice AS current_price,
       CASE WHEN {when} AND c_mktsegment <> 'BUILDING' THEN c_name END AS company_name,
       CASE WHEN {when} AND c_mktsegment <> 'BUILDING' THEN n_name END AS country,
       CASE WHEN {when} AND c_mktsegment <> 'BUILDING' THEN c_acctbal END AS market_cap,
       CASE WHEN c_acctbal > 0 THEN c_acctbal / 100.0::DOUBLE END AS beta
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""


@query(_ENRICHED_SQL.format(when="true"))
def enrich_left(spark, sf_dir):
    rows = enrich(_order_ticks(spark, sf_dir), _order_profiles(spark, sf_dir), _order_metrics(spark, sf_dir), unique=True)
    return rows.drop("timestamp")


@query(_ENRICHED_SQL.format(when="hour(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))) % 2 = 0"))
def enrich_even_hours(spark, sf_dir):
    rows = enrich(
        _order_ticks(spark, sf_dir), _order_profiles(spark, sf_dir), _order_metrics(spark, sf_dir), unique=True,
        profile_every_hours=2,
    )
    return rows.drop("timestamp")


@query("""
WITH quotes AS (
  SELECT o_orderkey, o_custkey, o_totalprice AS price, o_totalprice * 0.8::DOUBLE AS close,
         CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE ELSE o_totalprice END AS high,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS polled_at, c_name, c_acctbal
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'
)
SELECT o_custkey::VARCHAR AS symbol, price AS current_price, close AS previous_close, high AS high_price,
       polled_at AS processed_timestamp,
       CASE WHEN hour(polled_at) % 2 = 0 THEN c_name END AS company_name,
       CASE WHEN hour(polled_at) % 2 = 0 THEN 'USD' END AS currency,
       CASE WHEN c_acctbal > 0 THEN c_acctbal END AS beta, CASE WHEN c_acctbal > 0 THEN 0.0::DOUBLE END AS pe_ratio,
       CASE WHEN close > 0 THEN (price - close) / close END AS daily_return,
       CASE WHEN close > 0 THEN high - 0.0::DOUBLE END AS price_range,
       CASE WHEN close > 0 THEN CASE WHEN high > 0 THEN price / high ELSE 0.5::DOUBLE END END AS price_position
FROM quotes""")
def collect_and_decode(spark, sf_dir):
    """Quotes, profiles and metrics merged into messages, and the messages decoded again."""
    customers = table(spark, sf_dir, "customer").withColumn("symbol", F.col("c_custkey").cast("string"))
    price = F.col("o_totalprice")
    quotes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("symbol"),
        price.alias("c"),
        (price * 0.8).alias("pc"),
        F.when(F.col("o_orderstatus") != "F", price).alias("h"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("o_orderkey").cast("int") % 24)).alias("polled_at"),
    )
    profiles = customers.select("symbol", F.col("c_name").alias("name"))
    metrics = customers.filter("c_acctbal > 0").select("symbol", F.col("c_acctbal").alias("beta"))
    universe = customers.filter("c_mktsegment <> 'BUILDING'")
    sent = encode_messages(collect_ticks(quotes, profiles, metrics, universe))
    return good_rows(stamp(decode(sent), batch_instant())).select(
        "symbol", "current_price", "previous_close", "high_price", naive("processed_timestamp"), "company_name",
        "currency", "beta", "pe_ratio", "daily_return", "price_range", "price_position",
    )


@query("""
SELECT p_partkey, p_brand AS symbol, p_retailprice FROM part
WHERE p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_size = 7)""")
def universe_semi(spark, sf_dir):
    """Only the brands in a universe table; brands repeat there and rows still come once."""
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "symbol")
    return restrict(parts, parts.filter("p_size = 7")).select("p_partkey", "symbol", "p_retailprice")


@query("""
WITH ranked AS (
  SELECT p_brand AS symbol, row_number() OVER (ORDER BY CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) DESC,
         p_brand) AS rank_no
  FROM part GROUP BY 1)
SELECT rank_no, symbol FROM ranked WHERE rank_no <= 10""")
def universe_top10(spark, sf_dir):
    largest = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("symbol"))
        .agg(F.sum(F.col("p_retailprice").cast("decimal(18,2)")).alias("total"))
        .orderBy(F.desc("total"), "symbol")
        .limit(10)
    )
    # Ten brands are left to be numbered.
    listed = largest.agg(F.sort_array(F.collect_list(F.struct((-F.col("total")).alias("order"), "symbol"))).alias("list"))
    ranks = listed.select(F.posexplode("list").alias("position", "entry"))
    return top_symbols(ranks.select((F.col("position") + 1).cast("bigint").alias("rank_no"), "entry.symbol"))


@query("""
SELECT p_partkey, i::BIGINT AS rank_no, trim(split_part(p_name, ' ', i::INTEGER)) AS symbol
FROM part, (SELECT unnest([1, 2]) AS i) AS n WHERE i <= len(string_split(p_name, ' '))""")
def universe_list(spark, sf_dir):
    """Comma lists split into trimmed symbols."""
    lists = table(spark, sf_dir, "part").select("p_partkey", F.regexp_replace("p_name", " ", " , ").alias("symbols"))
    return parse_symbols(lists).withColumn("rank_no", whole("rank_no"))


@query("SELECT event_id, ts FROM events WHERE isodow(ts) - 1 < 5 AND (hour(ts) >= 23 OR hour(ts) <= 6)")
def session_filter(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(in_collection_hours(F.col("ts"))).select("event_id", "ts")


@query("""
WITH zoned AS (SELECT event_id, ts, timezone('America/New_York', timezone('UTC', ts)) AS ny FROM events)
SELECT event_id, ts FROM zoned
WHERE isodow(ny) <= 5 AND hour(ny) * 60 + minute(ny) >= 570 AND hour(ny) * 60 + minute(ny) < 960""")
def session_filter_ny(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(in_market_session(F.col("ts"))).select("event_id", "ts")


@query("""
SELECT event_id, CASE WHEN pe > 0 THEN CASE WHEN pe < 15 THEN 'low' WHEN pe <= 25 THEN 'fair' ELSE 'high' END END AS band
FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 15 WHEN 3 THEN 25 ELSE value END AS pe
      FROM events)""")
def pe_bands(spark, sf_dir):
    kind = F.col("event_id") % 6
    pe = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.lit(0.0))
        .when(kind == 2, F.lit(15.0))
        .when(kind == 3, F.lit(25.0))
        .otherwise(F.col("value"))
    )
    return table(spark, sf_dir, "events").select("event_id", N.pe_band(pe).alias("band"))


@query("""
SELECT o_orderkey, o_totalprice * 1350.0::DOUBLE AS krw, o_totalprice / 1000.0::DOUBLE AS billions,
       o_totalprice / 1000.0::DOUBLE * 1.35::DOUBLE AS trillions, o_totalprice * 100.0::DOUBLE AS pct
FROM orders""")
def unit_changes(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", N.to_krw(price).alias("krw"), N.billions_usd(price).alias("billions"),
        N.trillions_krw(price).alias("trillions"), N.percent(price).alias("pct"),
    )


@query("""
SELECT event_id, round_even(event_id / 2.0::DOUBLE, 0)::DOUBLE AS halves, round_even(value, 1)::DOUBLE AS tenths
FROM events""")
def half_even_rounding(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", N.half_even(F.col("event_id") / F.lit(2.0), 0).alias("halves"),
        N.half_even(F.col("value"), 1).alias("tenths"),
    )


@query("""
SELECT o_orderkey, printf('%.2f', o_totalprice) AS plain,
       format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)) AS grouped,
       printf('%+.2f', (o_orderkey % 200 - 100) / 8.0::DOUBLE) || '%' AS signed
FROM orders""")
def number_texts(spark, sf_dir):
    price = F.col("o_totalprice")
    change = (F.col("o_orderkey") % 200 - 100) / F.lit(8.0)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", N.two_decimals_text(price).alias("plain"), N.grouped_text(price).alias("grouped"),
        N.signed_percent_text(change).alias("signed"),
    )


_QUOTE_FIELDS = ["c", "o", "h", "l", "pc", "d", "dp"]


def _quote_texts(spark, sf_dir):
    """Quote documents as JSON: usable, empty, unreadable, with a null, without a price, without a symbol."""
    kind = F.col("event_id") % 7
    value = F.col("value").cast("string")
    price = F.when(kind == 1, F.lit("0")).when(kind == 2, F.lit('"n/a"')).when(kind == 3, F.lit("null")).otherwise(value)
    symbol = F.when(kind == 5, F.lit("")).otherwise(F.concat(F.lit('"symbol": "'), F.col("event_type"), F.lit('", ')))
    low = F.when(kind == 6, F.lit(', "l": null')).otherwise(F.lit(""))
    first = F.when(kind == 4, F.lit("")).otherwise(F.concat(F.lit('"c": '), price, F.lit(", ")))
    text = F.concat(F.lit("{"), symbol, first, F.lit('"o": 1.5'), low, F.lit(', "t": '), F.col("event_id").cast("string"), F.lit("}"))
    return table(spark, sf_dir, "events").select(text.alias("value"))


@query("""
SELECT CASE event_id % 7 WHEN 1 THEN 'empty_quote' WHEN 2 THEN 'not_a_number:current_price' WHEN 3 THEN 'null:current_price'
            WHEN 5 THEN 'no_symbol' WHEN 6 THEN 'null:low_price' ELSE 'usable' END AS outcome,
       count(*) AS n, sum(event_id)::BIGINT AS events
FROM events WHERE event_id % 7 IN (1, 2, 3, 5, 6) OR value <> 0 OR event_id % 7 = 4 GROUP BY 1""")
def quote_quarantine(spark, sf_dir):
    """Every quote is either a tick or stands in quarantine with its reason and its document."""
    quotes = parse_documents(_quote_texts(spark, sf_dir), [*_QUOTE_FIELDS, "t", "polled_at"])
    rejected = rejected_quotes(quotes).select(F.col("reason").alias("outcome"), F.get_json_object("document", "$.t").cast("bigint").alias("event"))
    usable = quote_rows(quotes).select(F.lit("usable").alias("outcome"), F.unix_timestamp(F.col("market_timestamp").cast("timestamp")).alias("event"))
    return rejected.unionByName(usable).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("event").alias("events"))


@query("""
SELECT c_custkey AS symbol, CASE c_custkey % 3 WHEN 0 THEN 'USD' WHEN 2 THEN 'EUR' END AS currency,
       CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_name END AS company_name
FROM customer""")
def profile_null_kept(spark, sf_dir):
    """A key that a document lacks has its default; one with a null stays null."""
    number = F.col("c_custkey")
    money = F.when(number % 3 == 0, F.lit("")).when(number % 3 == 1, F.lit(', "currency": null')).otherwise(F.lit(', "currency": "EUR"'))
    named = F.concat(F.lit(', "name": "'), F.col("c_name"), F.lit('"'))
    name = F.when(number % 4 == 0, F.lit("")).when(number % 4 == 1, F.lit(', "name": null')).otherwise(named)
    texts = table(spark, sf_dir, "customer").select(F.concat(F.lit('{"symbol": "'), number.cast("string"), F.lit('"'), money, name, F.lit("}")).alias("value"))
    found = profile_rows(parse_documents(texts, [*PROFILE_TEXT_KEYS.values(), *PROFILE_NUMBER_KEYS.values()]))
    return found.select(F.col("symbol").cast("bigint").alias("symbol"), "currency", "company_name")


@query("""
WITH versions AS (
  SELECT event_type AS symbol, ts AS valid_from, max(event_id) AS version FROM events WHERE event_id % 40 = 7 GROUP BY 1, 2
)
SELECT t.event_id, t.event_type AS symbol, v.version FROM events t ASOF LEFT JOIN versions v ON v.symbol = t.event_type AND v.valid_from <= t.ts""")
def enrich_as_of(spark, sf_dir):
    """Ticks with the version of their symbol that was valid at their time."""
    events = table(spark, sf_dir, "events")
    versions = events.filter(F.col("event_id") % 40 == 7).select(F.col("event_type").alias("symbol"), F.col("ts").alias("valid_from"), F.col("event_id").alias("version"))
    ticks_ = events.select("event_id", F.col("event_type").alias("symbol"), "ts")
    return as_of(ticks_, versions, "ts", "valid_from", tie=F.col("version").desc()).select("event_id", "symbol", "version")
