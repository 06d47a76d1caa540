import datetime as dt
import glob
import json
import os

import pytest
from conftest import START, values
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickframe.__main__ import main
from tickframe.functions.times import collection_open
from tickframe.operators import quality as Q
from tickframe.operators import serving as S
from tickframe.plans.analyze import run_analyze, run_daily
from tickframe.plans.ingest import run_ingest
from tickframe.plans.upkeep import run_cleanup, run_freshness, run_monitor, run_quality
from tickframe.schemas import ANALYZED_SCHEMA, DAILY_SCHEMA, RAW_SCHEMA, TICK_SCHEMA
from tickframe.session import new_path, path_exists, remove_own
from tickframe.sources import kafka_options, preview, read_table, staged_overwrite, stream_messages, write_partitioned
from tickframe.streaming import latest_per_minute_stream, start_analyze, start_ingest, start_latest


def test_schemas():
    assert [len(s.fields) for s in (TICK_SCHEMA, RAW_SCHEMA, ANALYZED_SCHEMA, DAILY_SCHEMA)] == [28, 32, 44, 5]


def test_missing_and_empty_paths(spark, tmp_path):
    missing = str(tmp_path / "nothing")
    assert read_table(spark, missing, RAW_SCHEMA, missing_ok=True).count() == 0
    with pytest.raises(AnalysisException):
        read_table(spark, missing, RAW_SCHEMA)
    os.makedirs(missing)
    assert read_table(spark, missing, RAW_SCHEMA, missing_ok=True).schema == RAW_SCHEMA


def test_numeric_symbols_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("005930", 1.0), ("000660", 2.0)], "symbol string, p double")
    assert write_partitioned(df, path, ["symbol"]) == 2
    assert values(read_table(spark, path, "p double, symbol string"), "symbol") == [("000660",), ("005930",)]


def test_write_counts_and_file_limits(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select("id", F.lit("x").alias("d"))
    assert write_partitioned(df, path, ["d"], max_records=100) == 1000
    assert len(glob.glob(path + "/d=x/*.parquet")) >= 10
    assert write_partitioned(df.limit(0), path, ["d"]) == 0
    assert preview(read_table(spark, path), 7).count() == 7


def test_staged_overwrite_of_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("d"))
    write_partitioned(df, path, ["d"])
    schema = "id long, d int"
    staged_overwrite(read_table(spark, path, schema).filter("d = 1 AND id > 4"), path, ["d"])
    assert [r[0] for r in values(read_table(spark, path, schema), "id")] == [0, 2, 4, 5, 6, 7, 8, 9]
    staged_overwrite(read_table(spark, path, schema).filter("d = 1"), path, ["d"], replace="all")
    assert [r[0] for r in values(read_table(spark, path, schema), "id")] == [5, 7, 9]
    with pytest.raises(ValueError):
        staged_overwrite(df, path, ["d"], replace="some")


def poll(spark, minutes, symbols=("A", "B")):
    rows = [(s, (START + dt.timedelta(minutes=m)).isoformat(), 1.0 + m) for s in symbols for m in minutes]
    df = spark.createDataFrame(rows, "symbol string, timestamp string, current_price double")
    return df.select(F.to_json(F.struct("*")).cast("binary").alias("value"))


def test_jobs_end_to_end(spark, tmp_path):
    raw, bad, done, daily = (str(tmp_path / n) for n in ("raw", "bad", "analyzed", "daily"))
    counts = run_ingest(poll(spark, range(10)), raw, bad)
    assert counts == {"raw_rows": 20, "quarantined_rows": 0}
    assert run_analyze(spark, raw, done) == 20
    # The topic is read from its start again: nothing new comes out of it.
    run_ingest(poll(spark, range(12)), raw, bad)
    assert run_analyze(spark, raw, done) == 4
    assert run_analyze(spark, raw, done) == 0
    table = read_table(spark, done, ANALYZED_SCHEMA)
    assert table.count() == 24
    last = table.orderBy(F.desc("collection_time"), "symbol").first()
    assert (last["data_count_for_avg"], last["moving_avg_7_days"]) == (12, 6.5)
    # A late minute, first appended and then repaired.
    run_ingest(poll(spark, [-1]), raw, bad)
    assert run_analyze(spark, raw, done, mode="repair") == 26
    last = read_table(spark, done, ANALYZED_SCHEMA).orderBy(F.desc("collection_time"), "symbol").first()
    assert (last["data_count_for_avg"], last["moving_avg_7_days"]) == (13, 6.0)
    assert run_analyze(spark, raw, done, mode="repair") == 0
    assert run_daily(spark, raw, daily) == 4
    assert read_table(spark, daily, DAILY_SCHEMA).count() == 4
    with pytest.raises(ValueError):
        run_analyze(spark, raw, done, mode="other")


def test_table_in_the_older_layout_is_continued(spark, tmp_path):
    raw, bad, done = (str(tmp_path / n) for n in ("raw", "bad", "analyzed"))
    run_ingest(poll(spark, range(5)), raw, bad)
    run_analyze(spark, raw, done)
    old = str(tmp_path / "old")
    rows = read_table(spark, done, ANALYZED_SCHEMA).drop("collection_time", "collection_hour", "collection_minute")
    write_partitioned(rows, old, ["trade_date"])
    assert run_analyze(spark, raw, old) == 10
    assert run_analyze(spark, raw, old) == 0
    assert read_table(spark, old, ANALYZED_SCHEMA).filter("collection_minute IS NULL").count() == 10


def test_cleanup(spark, tmp_path):
    raw, bad, done = (str(tmp_path / n) for n in ("raw", "bad", "analyzed"))
    run_ingest(poll(spark, range(5)), raw, bad)
    run_analyze(spark, raw, done)
    before = values(read_table(spark, done, ANALYZED_SCHEMA), "symbol", "collection_time", "moving_avg_7_days")
    read_table(spark, done, ANALYZED_SCHEMA).write.mode("append").partitionBy("trade_date").parquet(done)
    assert run_cleanup(spark, done) == 10
    assert values(read_table(spark, done, ANALYZED_SCHEMA), "symbol", "collection_time", "moving_avg_7_days") == before
    assert run_cleanup(spark, done) == 0
    with pytest.raises(ValueError):
        run_cleanup(spark, done, keys=["symbol"])


def test_quality(spark, tmp_path):
    rows = [(1, "a", START, START.date(), 1.0), (2, None, None, None, float("nan")), (2, None, None, None, float("nan"))]
    df = spark.createDataFrame(rows, "i int, s string, t timestamp, d date, p double")
    assert Q.null_counts(df).first().asDict() == {"i": 0, "s": 2, "t": 2, "d": 2, "p": 2}
    report = Q.quality_report(df, "p").first()
    assert (report["total"], report["duplicates"], report["invalid_prices"], report["passed"]) == (3, 1, 0, False)
    assert Q.quality_report(df, "p", keys=["t"]).first()["duplicates"] == 1
    assert Q.quality_report(df.limit(0), "p").first()["passed"] is False
    clean = spark.range(100).select("id", F.lit(1.0).alias("p"))
    assert Q.quality_report(clean, "p").first()["passed"] is True
    assert Q.quality_report(clean.withColumn("p", F.lit(0.0)), "p").first()["invalid_prices"] == 100
    holes = clean.withColumn("p", F.when(F.col("id") % 8 != 0, 1.0))
    assert Q.quality_report(holes, "p", max_nulls=0.2).first()["passed"] is True
    assert Q.quality_report(holes, "p", max_nulls=0.2, max_column_nulls=0.1).first()["passed"] is False
    assert Q.column_availability(df.limit(0), ["s", "zz"]).first().asDict() == {"s": False, "zz": False}
    assert Q.columns_like(spark.createDataFrame([(1, 2, 3)], "Trade_Date int, x int, HOURS int")) == ["Trade_Date", "HOURS"]


def test_freshness(spark):
    df = spark.createDataFrame([(START,)], "t timestamp")
    now = F.lit(START + dt.timedelta(hours=2))
    checks = run_freshness({"a": (df, "t"), "b": (df.limit(0), "t")}, now, max_lag_seconds=3600)
    assert values(checks, "dataset", "has_data", "fresh") == [("a", True, False), ("b", False, False)]
    assert checks.filter("dataset = 'a'").first()["lag_seconds"] == 7200
    dated = df.withColumn("d", F.to_date("t"))
    assert Q.freshness(dated, "a", "t", now, partition="d").first()["fresh"] is True
    assert Q.freshness(dated.limit(0), "a", "t", now, partition="d").first()["has_data"] is False


def test_only_own_paths_are_removed(spark, tmp_path):
    with pytest.raises(ValueError):
        remove_own(spark, str(tmp_path))
    path = new_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert path_exists(spark, path)
    remove_own(spark, path)
    assert not path_exists(spark, path)


def test_serving_of_a_table_without_metrics(spark):
    df = spark.createDataFrame([("A", START.date(), 2.0)], "symbol string, trade_date date, average_price double")
    row = S.kpis(df).first()
    assert (row["price_krw"], row["cap_billion_usd"], row["pe_band"]) == (2700.0, None, None)
    texts = S.kpi_texts(S.kpis(df)).first()
    assert (texts["price_text"], texts["cap_text"], texts["pe_text"], texts["return_text"]) == ("$2.00", "N/A", "N/A", None)
    assert S.detail_table(df).columns == ["종목", "날짜", "평균가격"]
    assert S.detail_table(df, labels=None).columns == ["symbol", "trade_date", "average_price"]


def files(spark, path, messages):
    messages.write.mode("append").parquet(path)
    return stream_messages(spark, "parquet", path, "value binary")


def test_streams_resume_and_do_not_repeat(spark, tmp_path):
    topic, raw, done = (str(tmp_path / n) for n in ("topic", "raw", "analyzed"))
    for minutes, expected in ((range(5), 10), (range(4, 8), 16)):
        start_ingest(files(spark, topic, poll(spark, minutes)), raw, str(tmp_path / "c1")).awaitTermination()
        raw_stream = spark.readStream.schema(RAW_SCHEMA).parquet(raw)
        start_analyze(raw_stream, done, str(tmp_path / "c2")).awaitTermination()
        assert read_table(spark, done, ANALYZED_SCHEMA).count() == expected
    assert read_table(spark, raw, RAW_SCHEMA).count() == 18
    # Another run without new messages adds nothing.
    start_ingest(stream_messages(spark, "parquet", topic, "value binary"), raw, str(tmp_path / "c1")).awaitTermination()
    assert read_table(spark, raw, RAW_SCHEMA).count() == 18
    full = str(tmp_path / "full")
    run_analyze(spark, raw, full)
    columns = ("symbol", "collection_time", "moving_avg_7_days", "data_count_for_avg")
    assert values(read_table(spark, done, ANALYZED_SCHEMA), *columns) == values(
        read_table(spark, full, ANALYZED_SCHEMA), *columns
    )


def test_latest_stream_keeps_the_newest_not_the_first(spark, tmp_path):
    rows = [("A", START + dt.timedelta(seconds=s), float(s)) for s in (40, 10, 50, 70, 4000)]
    source = str(tmp_path / "ticks")
    schema = "symbol string, processed_timestamp timestamp, current_price double"
    spark.createDataFrame(rows, schema).withColumn("batch_timestamp", F.lit(START)).write.parquet(source)
    stream = spark.readStream.schema(schema + ", batch_timestamp timestamp").parquet(source)
    out = str(tmp_path / "latest")
    start_latest(latest_per_minute_stream(stream), out, str(tmp_path / "c")).awaitTermination()
    assert values(read_table(spark, out), "current_price") == [(50.0,), (70.0,)]


def test_quality_gate_and_command_line(spark, tmp_path, capsys):
    topic, raw, bad, done, daily = (str(tmp_path / n) for n in ("topic", "raw", "bad", "analyzed", "daily"))
    documents = {
        "quotes": [{"symbol": s, "c": 10.0 + m, "pc": 8, "h": 12, "l": 9, "t": 60 * m, "polled_at": f"2024-01-01T02:0{m}:00"}
                   for s in ("AAPL", "MSFT", "OTHER") for m in range(5)],
        "profiles": [{"symbol": "AAPL", "name": "Apple", "marketCapitalization": 5.5}],
        "metrics": [{"symbol": "AAPL", "beta": None, "52WeekHigh": 20}],
    }
    for name, rows in documents.items():
        (tmp_path / f"{name}.json").write_text("\n".join(json.dumps(row) for row in rows))
    sources = [text for name in documents for text in (f"--{name}", str(tmp_path / f"{name}.json"))]
    assert main(["collect", *sources, "--format", "parquet", "--path", topic]) == 0
    assert main(["ingest", "--format", "parquet", "--path", topic, "--raw", raw, "--quarantine", bad]) == 0
    assert main(["analyze", "--raw", raw, "--analyzed", done]) == 0
    assert values(read_table(spark, raw, RAW_SCHEMA).filter("current_price = 12.0"), "symbol", "company_name", "market_cap",
                  "beta", "week_52_high", "daily_return") == [("AAPL", "Apple", 5.5, 0.0, 20.0, 0.5)] + [
        ("MSFT", None, None, None, None, 0.5)]
    assert main(["daily", "--raw", raw, "--daily", daily]) == 0
    assert main(["cleanup", "--analyzed", done]) == 0
    assert main(["inspect", done]) == 0
    assert main(["monitor", "--analyzed", done]) == 1
    now = F.lit("2024-01-01 02:30:00").cast("timestamp")
    checks = run_monitor(spark, done, read_table(spark, topic), now)
    assert values(checks, "dataset", "has_data", "fresh") == [("analyzed", True, True), ("topic", True, True)]
    nothing = run_monitor(spark, str(tmp_path / "none"), read_table(spark, topic).limit(0), now)
    assert values(nothing, "dataset", "has_data", "fresh") == [("analyzed", False, False), ("topic", False, False)]
    assert collection_open(spark, F.lit("2024-01-01 03:00:00").cast("timestamp"))
    assert not collection_open(spark, F.lit("2024-01-06 03:00:00").cast("timestamp"))
    # Ticks without profile and metrics leave most columns null, which the whole-table rule does not allow.
    assert main(["quality", "--raw", raw, "--analyzed", done]) == 1
    verdicts = run_quality(spark, {"raw": {"path": raw, "schema": "symbol string, current_price double"}})
    assert verdicts.first()["passed"] is True


def test_kafka_options():
    assert kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false",
    }
