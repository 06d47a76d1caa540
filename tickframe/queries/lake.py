"""Table scans, sinks and whole jobs: each writes under a fresh path of the shared folder and reads back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickframe.operators.dedup import serving_rows
from tickframe.plans.analyze import run_analyze, run_analyze_lake, run_daily
from tickframe.plans.ingest import run_ingest
from tickframe.plans.serve import run_kpis
from tickframe.plans.upkeep import run_cleanup
from tickframe.queries.base import ANALYZED_SQL, CENTS, TICKS_SQL, analyzed, naive, query, sql_avg, table, whole
from tickframe.queries.records import _faulty, batch_instant, messages
from tickframe.schemas import ANALYZED_SCHEMA, DAILY_SCHEMA, RAW_SCHEMA, SYMBOL_PARTITIONS
from tickframe.session import new_path
from tickframe.sources.lake import read_batches
from tickframe.sources.messages import stream_messages
from tickframe.sources.sinks import staged_overwrite, write_messages, write_partitioned
from tickframe.sources.tables import read_layouts, read_table
from tickframe.streaming.analyze import start_analyze
from tickframe.streaming.ingest import run_ingest_lake, start_ingest, start_quarantine
from tickframe.streaming.latest import latest_per_minute_stream, start_latest
from tickframe.streaming.minutes import MinuteSteps, start_minutes

_LAKE_SCHEMA = "event_id bigint, ts timestamp_ntz, value double, event_type string, trade_date date"


def _dated(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("trade_date", F.to_date("ts"))
    return events.select("event_id", "ts", "value", "event_type", "trade_date")


@query("""
SELECT event_id, ts, value, event_type, CAST(ts AS DATE) AS trade_date FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-07' AND event_type = 'view'""")
def scan_partitioned(spark, sf_dir):
    """Equality on a partition date reads that directory only; equality on the symbol is pushed into the files."""
    path = new_path(spark, "scan")
    write_partitioned(_dated(spark, sf_dir), path, ["trade_date"], sort=["event_type"])
    rows = read_table(spark, path, _LAKE_SCHEMA)
    return rows.filter((F.col("trade_date") == F.lit("2024-01-07").cast("date")) & (F.col("event_type") == "view"))


@query("SELECT event_id, lpad(CAST(user_id % 7 AS VARCHAR), 6, '0') AS symbol FROM events")
def scan_numeric_symbols(spark, sf_dir):
    """Symbols of digits keep their leading zeros as partition values."""
    path = new_path(spark, "digits")
    symbol = F.lpad((F.col("user_id") % 7).cast("string"), 6, "0")
    rows = table(spark, sf_dir, "events").select("event_id", symbol.alias("symbol"))
    write_partitioned(rows, path, ["symbol"])
    return read_table(spark, path, "event_id bigint, symbol string")


@query("SELECT event_id, ts, value, event_type, CAST(ts AS DATE) AS trade_date FROM events")
def scan_missing_path(spark, sf_dir):
    """A table that is not there yet reads as empty: the accumulated table is then the new rows."""
    history = read_table(spark, new_path(spark, "missing"), _LAKE_SCHEMA, missing_ok=True)
    return history.unionByName(_dated(spark, sf_dir))


@query("SELECT event_id, ts, value, event_type, CAST(ts AS DATE) AS trade_date FROM events")
def write_append(spark, sf_dir):
    path = new_path(spark, "append")
    rows = _dated(spark, sf_dir)
    for part in ("event_type = 'click'", "event_type <> 'click'"):
        write_partitioned(rows.filter(part), path, ["trade_date"], max_records=10_000)
    return read_table(spark, path, _LAKE_SCHEMA)


@query("SELECT event_id, ts, value, event_type, CAST(ts AS DATE) AS trade_date FROM events")
def write_overwrite(spark, sf_dir):
    """The second write replaces the first, also in dates it does not have."""
    path = new_path(spark, "overwrite")
    rows = _dated(spark, sf_dir)
    write_partitioned(rows.withColumn("trade_date", F.date_add("trade_date", 10)), path, ["trade_date"])
    write_partitioned(rows, path, ["trade_date"], "overwrite")
    return read_table(spark, path, _LAKE_SCHEMA)


@query("""
SELECT event_id, ts, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN value * 2.0::DOUBLE ELSE value END AS value,
       event_type, CAST(ts AS DATE) AS trade_date
FROM events""")
def write_onto_itself(spark, sf_dir):
    """Some dates of a table rewritten from their own rows."""
    path = new_path(spark, "itself")
    write_partitioned(_dated(spark, sf_dir), path, ["trade_date"])
    stored = read_table(spark, path, _LAKE_SCHEMA).filter(F.col("trade_date") >= F.lit("2024-01-20").cast("date"))
    staged_overwrite(stored.withColumn("value", F.col("value") * 2.0), path, ["trade_date"], ["event_type"])
    return read_table(spark, path, _LAKE_SCHEMA)


def _as_analyzed(rows):
    """Rows in the ANALYZED layout; columns the tick view lacks are null."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ANALYZED_SCHEMA.fields
        ]
    )


@query(f"""WITH {ANALYZED_SQL}
SELECT symbol, trade_date, collection_time, average_price, moving_avg_7_days, data_count_for_avg FROM analyzed""")
def cleanup_job(spark, sf_dir):
    """Copies with smaller averages are removed from a stored table."""
    path = new_path(spark, "cleanup")
    rows = _as_analyzed(analyzed(spark, sf_dir))
    worse = rows.filter(F.dayofmonth("trade_date") % 4 == 1).withColumn(
        "moving_avg_7_days", F.col("moving_avg_7_days") - 1
    )
    write_partitioned(rows.unionByName(worse), path, ["trade_date"])
    run_cleanup(spark, path)
    return read_table(spark, path, ANALYZED_SCHEMA).select(
        "symbol", "trade_date", naive("collection_time"), "average_price", "moving_avg_7_days", "data_count_for_avg"
    )


@query(f"""WITH {TICKS_SQL}
SELECT symbol, '2024-02-01' AS batch_date, 12::BIGINT AS batch_hour, ts AS processed_timestamp, current_price, market_cap
FROM ticks""")
def ingest_job(spark, sf_dir):
    """Messages to RAW in its layout with one directory per symbol."""
    raw, bad = new_path(spark, "raw"), new_path(spark, "quarantine")
    run_ingest(messages(spark, sf_dir), raw, bad, batch_instant(), SYMBOL_PARTITIONS, max_records=10_000)
    return read_table(spark, raw, RAW_SCHEMA).select(
        "symbol", "batch_date", whole("batch_hour"), naive("processed_timestamp"), "current_price", "market_cap"
    )


@query("""
SELECT 'kept' AS outcome, count(*) FILTER (event_id % 10 NOT IN (0, 2, 3, 4)) AS n FROM events
UNION ALL SELECT 'rejected', count(*) FILTER (event_id % 10 IN (0, 2, 3, 4)) FROM events""")
def ingest_job_faults(spark, sf_dir):
    raw, bad = new_path(spark, "raw"), new_path(spark, "quarantine")
    run_ingest(_faulty(spark, sf_dir), raw, bad, batch_instant())
    kept = read_table(spark, raw, RAW_SCHEMA).select(F.lit("kept").alias("outcome"))
    rejected = read_table(spark, bad).select(F.lit("rejected").alias("outcome"))
    return kept.unionByName(rejected).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT count(*) FILTER (event_id % 10 NOT IN (0, 2, 3, 4)) AS raw_rows,
       count(*) FILTER (event_id % 10 IN (0, 2, 3, 4)) AS quarantined_rows
FROM events""")
def write_row_counts(spark, sf_dir):
    """Row counts observed while writing, without another pass over the data."""
    counts = run_ingest(_faulty(spark, sf_dir), new_path(spark, "raw"), new_path(spark, "quarantine"), batch_instant())
    return spark.createDataFrame([tuple(counts.values())], [*counts])


_JOB_COLUMNS = ["symbol", "trade_date", "average_price", "avg_market_cap", "avg_volatility", "moving_avg_7_days",
                "data_count_for_avg"]


@query(f"WITH {ANALYZED_SQL} SELECT collection_time, {', '.join(_JOB_COLUMNS)} FROM analyzed")
def analyze_job(spark, sf_dir):
    """Messages, RAW, ANALYZED in two runs: the second batch holds the ticks from the 16th on."""
    raw, bad, done = (new_path(spark, name) for name in ("raw", "quarantine", "analyzed"))
    for part in ("ts < TIMESTAMP_NTZ '2024-01-16'", "ts >= TIMESTAMP_NTZ '2024-01-16'"):
        run_ingest(messages(spark, sf_dir, part), raw, bad, batch_instant())
        run_analyze(spark, raw, done, exact=CENTS)
    return read_table(spark, done, ANALYZED_SCHEMA).select(naive("collection_time"), *_JOB_COLUMNS)


@query(f"""WITH daily AS (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS trade_date, {sql_avg("value")} AS daily_avg_price,
         count(value) AS data_count_for_avg
  FROM events GROUP BY 1, 2)
SELECT *, avg(daily_avg_price) OVER (
  PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS "7_day_moving_average"
FROM daily""")
def daily_job(spark, sf_dir):
    raw, bad, daily = (new_path(spark, name) for name in ("raw", "quarantine", "daily"))
    run_ingest(messages(spark, sf_dir), raw, bad, batch_instant())
    run_daily(spark, raw, daily, exact=CENTS)
    return read_table(spark, daily, DAILY_SCHEMA)


def _sent(spark, sf_dir, rows=None):
    """Messages as files, the form in which a stream can pick them up."""
    path = new_path(spark, "topic")
    write_messages(messages(spark, sf_dir) if rows is None else rows, "parquet", path)
    return stream_messages(spark, "parquet", path, "key string, value binary", maxFilesPerTrigger=4)


def _finish(query) -> None:
    query.awaitTermination()


@query(f"WITH {TICKS_SQL} SELECT symbol, ts AS processed_timestamp, current_price, market_cap, volatility FROM ticks")
def stream_ingest(spark, sf_dir):
    raw = new_path(spark, "raw")
    _finish(start_ingest(_sent(spark, sf_dir), raw, new_path(spark, "offsets"), batch_instant=batch_instant()))
    return read_table(spark, raw, RAW_SCHEMA).select(
        "symbol", naive("processed_timestamp"), "current_price", "market_cap", "volatility"
    )


@query("""
SELECT CASE event_id % 10 WHEN 0 THEN 'malformed' WHEN 2 THEN 'no_value' WHEN 3 THEN 'no_symbol' ELSE 'no_time' END
  AS reason, count(*) AS n
FROM events WHERE event_id % 10 IN (0, 2, 3, 4) GROUP BY 1""")
def stream_quarantine(spark, sf_dir):
    path = new_path(spark, "quarantine")
    faulty = _faulty(spark, sf_dir).withColumn("key", F.lit(None).cast("string"))
    sent = _sent(spark, sf_dir, faulty)
    _finish(start_quarantine(sent, path, new_path(spark, "offsets"), batch_instant=batch_instant()))
    return read_table(spark, path).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH newest AS (
  SELECT event_id, event_type AS symbol, date_trunc('minute', ts) AS minute_start, ts AS processed_timestamp,
         value AS current_price
  FROM events
  QUALIFY row_number() OVER (
    PARTITION BY event_type, date_trunc('minute', ts) ORDER BY ts DESC, event_id DESC) = 1)
SELECT * FROM newest
WHERE minute_start + INTERVAL 1 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTES FROM events)""")
def stream_latest_minute(spark, sf_dir):
    """Minutes that the final watermark has closed."""
    source = new_path(spark, "ticks")
    schema = "event_id bigint, symbol string, processed_timestamp timestamp, current_price double"
    table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("processed_timestamp"),
        F.col("value").alias("current_price"),
    ).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    path = new_path(spark, "latest")
    newest = latest_per_minute_stream(stream, recency=("processed_timestamp", "event_id"))
    _finish(start_latest(newest, path, new_path(spark, "offsets")))
    return read_table(spark, path).select(
        "event_id", "symbol", naive("minute_start"), naive("processed_timestamp"), "current_price"
    )


@query(f"WITH {ANALYZED_SQL} SELECT collection_time, {', '.join(_JOB_COLUMNS)} FROM analyzed")
def stream_analyze(spark, sf_dir):
    """RAW files picked up one batch date at a time, each appended to ANALYZED."""
    raw, bad, done = (new_path(spark, name) for name in ("raw", "quarantine", "analyzed"))
    offsets = new_path(spark, "offsets")
    for part in ("ts < TIMESTAMP_NTZ '2024-01-16'", "ts >= TIMESTAMP_NTZ '2024-01-16'"):
        run_ingest(messages(spark, sf_dir, part), raw, bad, batch_instant())
        stream = spark.readStream.schema(RAW_SCHEMA).parquet(raw)
        _finish(start_analyze(stream, done, offsets, exact=CENTS))
    return read_table(spark, done, ANALYZED_SCHEMA).select(naive("collection_time"), *_JOB_COLUMNS)


_HALVES = ("ts < TIMESTAMP_NTZ '2024-01-16'", "ts >= TIMESTAMP_NTZ '2024-01-16'")


def _growing_lake(spark, sf_dir, after_each=lambda lake: None) -> str:
    """A lake filled by one run after each half of the messages has arrived, and by one that finds nothing new."""
    topic, lake = new_path(spark, "topic"), new_path(spark, "lake")
    for part in (*_HALVES, None):
        if part:
            write_messages(messages(spark, sf_dir, part), "parquet", topic)
        source = stream_messages(spark, "parquet", topic, "key string, value binary")
        run_ingest_lake(source, lake, batch_instant())
        after_each(lake)
    return lake


@query(f"""WITH {TICKS_SQL}
SELECT symbol, '2024-02-01' AS batch_date, 12::BIGINT AS batch_hour, ts AS processed_timestamp, current_price, market_cap
FROM ticks""")
def ingest_twice(spark, sf_dir):
    """Runs over a source that grows in between store every message once."""
    return read_batches(spark, _growing_lake(spark, sf_dir)).select(
        "symbol", "batch_date", whole("batch_hour"), naive("processed_timestamp"), "current_price", "market_cap"
    )


@query(f"WITH {ANALYZED_SQL} SELECT collection_time, {', '.join(_JOB_COLUMNS)} FROM analyzed")
def analyze_twice(spark, sf_dir):
    """An analysis after each ingest reads the new batches only and goes on from the tails of the one before."""
    done = new_path(spark, "analyzed")
    _growing_lake(spark, sf_dir, lambda lake: run_analyze_lake(spark, lake, done, exact=CENTS))
    return read_table(spark, done, ANALYZED_SCHEMA).select(naive("collection_time"), *_JOB_COLUMNS)


_LATE_SQL = """
WITH sent AS (
  SELECT *, least(3, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END
                     + CASE WHEN event_id % 50 = 3 THEN 1 ELSE 0 END) AS file
  FROM events
),
marks AS (SELECT f AS file, (SELECT max(ts) FROM sent WHERE file < f) - INTERVAL 10 MINUTES AS mark FROM (VALUES (1), (2), (3)) AS v(f)),
ticks AS (
  SELECT event_id, event_type AS symbol, date_trunc('minute', ts) AS minute_start, ts, value,
         coalesce(date_trunc('minute', ts) + INTERVAL 1 MINUTE <= mark, false) AS late
  FROM sent JOIN marks USING (file)
),
kept AS (
  SELECT *, count(*) OVER (PARTITION BY symbol, minute_start) AS n_ticks FROM ticks WHERE NOT late
  QUALIFY row_number() OVER (PARTITION BY symbol, minute_start ORDER BY ts DESC, event_id DESC) = 1
)
SELECT 'minute' AS kind, event_id, symbol, minute_start, value AS current_price, n_ticks FROM kept
UNION ALL SELECT 'late', event_id, symbol, minute_start, value, 1 FROM ticks WHERE late"""


@query(_LATE_SQL)
def stream_late_ticks(spark, sf_dir):
    """Three files, some ticks a file late: every tick is counted in a minute or stands among the late ones."""
    source = new_path(spark, "ticks")
    ticks = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("processed_timestamp"),
        F.col("value").alias("current_price"),
        F.expr("""least(3, CASE WHEN ts < TIMESTAMP_NTZ '2024-01-11' THEN 1 WHEN ts < TIMESTAMP_NTZ '2024-01-21' THEN 2 ELSE 3 END
                  + CASE WHEN event_id % 50 = 3 THEN 1 ELSE 0 END)""").alias("file"),
    )
    schema = ticks.drop("file").schema
    steps = MinuteSteps(spark, new_path(spark, "minutes"), schema, recency=("processed_timestamp", "event_id"))
    for file in (1, 2, 3):
        ticks.filter(F.col("file") == file).drop("file").coalesce(1).write.mode("append").parquet(source)
        _finish(start_minutes(spark.readStream.schema(schema).parquet(source), steps))
    steps.close(dt.datetime(2025, 1, 1))
    columns = ["event_id", "symbol", naive("minute_start"), "current_price", "n_ticks"]
    kept = steps.read("closed").select(F.lit("minute").alias("kind"), *columns)
    return kept.unionByName(steps.read("late").select(F.lit("late").alias("kind"), *columns))


@query(f"""WITH {ANALYZED_SQL},
old AS (
  SELECT symbol, trade_date, CAST(NULL AS TIMESTAMP) AS collection_time, max(moving_avg_7_days) AS moving_avg_7_days
  FROM analyzed WHERE trade_date < DATE '2024-01-11' GROUP BY 1, 2
)
SELECT * FROM old UNION ALL
SELECT symbol, trade_date, collection_time, moving_avg_7_days FROM analyzed WHERE trade_date >= DATE '2024-01-11'""")
def serving_old_layout_stored(spark, sf_dir):
    """Ten stored days of the layout without times, one row a day, stay ten rows beside newer days of minutes."""
    path, minutes_ = new_path(spark, "layouts"), analyzed(spark, sf_dir)
    is_old = F.col("trade_date") < F.lit("2024-01-11").cast("date")
    old = minutes_.filter(is_old).groupBy("symbol", "trade_date").agg(F.max("moving_avg_7_days").alias("moving_avg_7_days"))
    columns = ["symbol", "trade_date", "collection_time", "average_price", "moving_avg_7_days", "data_count_for_avg"]
    for rows in (old, minutes_.filter(~is_old).select(*columns)):
        write_partitioned(rows.unionByName(rows), path, ["trade_date"])
    return serving_rows(read_layouts(spark, path)).select("symbol", "trade_date", naive("collection_time"), "moving_avg_7_days")


@query(f"""WITH {ANALYZED_SQL}
SELECT symbol, average_price AS price, avg_daily_return * 100.0::DOUBLE AS return_pct FROM analyzed
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) = 1""")
def kpis_stored(spark, sf_dir):
    """Headline figures of a stored table, which its tails lead to."""
    raw, bad, done = (new_path(spark, name) for name in ("raw", "quarantine", "analyzed"))
    run_ingest(messages(spark, sf_dir), raw, bad, batch_instant())
    run_analyze(spark, raw, done, exact=CENTS)
    return run_kpis(spark, done).select("symbol", "price", "return_pct")
