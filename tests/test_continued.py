"""Ledger, lake of batches, tails and their store: what one run leaves for the next."""

import datetime as dt
import json
import re

import pytest
from conftest import START, ticks_of, values
from pyspark.sql import functions as F

from tickframe.functions.times import time_parts
from tickframe.operators.incremental import analyze_new, history_tails, minute_rows, with_trailing
from tickframe.operators.tails import advance, tail_rows, tails_of, unserved
from tickframe.plans.analyze import append_minutes, run_analyze_lake
from tickframe.plans.ingest import write_batch
from tickframe.schemas import ANALYZED_SCHEMA, RAW_SCHEMA
from tickframe.session import path_exists, remove_folder
from tickframe.sources import read_table, stream_messages
from tickframe.sources.lake import batch_ledger, lake_batches, read_batches
from tickframe.sources.ledger import Ledger
from tickframe.sources.tail_store import TailStore
from tickframe.streaming.ingest import run_ingest_lake

EXACT = "decimal(18,2)"
OUT = ("symbol", "collection_time", "moving_avg_7_days", "data_count_for_avg")


def test_ledger_entries_are_whole_and_given_out_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    assert ledger.numbers() == [] and ledger.last() is None
    ledger.commit(0, {"a": 1})
    ledger.commit(2, {"a": "é"})
    with pytest.raises(FileExistsError):
        ledger.commit(2, {"a": 9})
    (tmp_path / "l" / ".half").write_text("{")
    assert ledger.numbers() == [0, 2] and ledger.numbers(0) == [2] and ledger.last() == (2, {"a": "é"})
    assert sorted(p.name for p in (tmp_path / "l").glob("*.json")) == ["000000000000.json", "000000000002.json"]


def message(symbol, minute, price):
    at = START + dt.timedelta(minutes=minute)
    return json.dumps({"symbol": symbol, "current_price": price, "timestamp": at.strftime("%Y-%m-%d %H:%M:%S")})


def send(spark, path, texts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").parquet(path)



@pytest.fixture(scope="module")
def instant(spark):
    return F.lit("2024-02-01 12:00:00").cast("timestamp")


def test_runs_take_what_came_since_the_last(spark, tmp_path, instant):
    topic, lake = str(tmp_path / "topic"), str(tmp_path / "lake")
    sent = [[message("A", 1, 1.0), "{broken", message("B", 2, 2.0)], [message("A", 3, 3.0)], []]
    counts = []
    for part in sent:
        if part:
            send(spark, topic, part)
        counts.append(run_ingest_lake(stream_messages(spark, "parquet", topic, "value string"), lake, instant))
    assert [tuple(c.values()) for c in counts] == [(2, 1), (1, 0), (0, 0)]
    assert values(read_batches(spark, lake), "symbol", "current_price") == [("A", 1.0), ("A", 3.0), ("B", 2.0)]
    assert read_batches(spark, lake).columns == RAW_SCHEMA.fieldNames()
    rejected = read_batches(spark, lake, outcome="quarantine").collect()
    assert [(r.value, r.reason) for r in rejected] == [("{broken", "malformed")]
    first, second = lake_batches(spark, lake)
    assert values(read_batches(spark, lake, [second]), "current_price") == [(3.0,)]
    with pytest.raises(ValueError):
        read_batches(spark, lake, outcome="other")


def test_a_batch_that_ended_early_is_replaced_and_not_read(spark, tmp_path, instant):
    lake = str(tmp_path / "lake")
    texts = spark.createDataFrame([(message("A", m, float(m)),) for m in range(5)], "value string")
    write_batch(texts, lake, 0, instant)
    # A run that wrote rows of batch 1 and ended before its entry.
    write_batch(texts, str(tmp_path / "other"), 1, instant)
    (tmp_path / "other" / "batch=1").rename(tmp_path / "lake" / "batch=1")
    assert lake_batches(spark, lake) == [0] and read_batches(spark, lake).count() == 5
    more = spark.createDataFrame([(message("A", 9, 9.0),)], "value string")
    assert write_batch(more, lake, 1, instant) == {"raw_rows": 1, "quarantined_rows": 0}
    assert read_batches(spark, lake).count() == 6
    # Run again after its entry, it changes nothing.
    assert write_batch(more, lake, 1, instant) == {"raw_rows": 1, "quarantined_rows": 0}
    assert read_batches(spark, lake).count() == 6 and batch_ledger(spark, lake).numbers() == [0, 1]


def test_an_empty_batch(spark, tmp_path, instant):
    lake = str(tmp_path / "lake")
    assert run_analyze_lake(spark, lake, str(tmp_path / "done")) == 0
    write_batch(spark.createDataFrame([], "value string"), lake, 0, instant)
    assert read_batches(spark, lake).count() == 0 and lake_batches(spark, lake) == [0]
    assert run_analyze_lake(spark, lake, str(tmp_path / "done")) == 0


def test_a_second_analysis_reads_new_batches_and_no_history(spark, tmp_path, instant):
    lake, done = str(tmp_path / "lake"), str(tmp_path / "done")
    days = [[message(s, 1440 * day + 7 * m, day + m / 4) for s in "AB" for m in range(30)] for day in range(4)]
    days[0].append(message("RARE", 5, 1.0))
    days[3].append(message("RARE", 1440 * 3 + 5, 4.0))
    for number, texts in enumerate(days):
        write_batch(spark.createDataFrame([(t,) for t in texts], "value string"), lake, number, instant)
        assert run_analyze_lake(spark, lake, done, rows=50, exact=EXACT) == len(texts)
        assert run_analyze_lake(spark, lake, done, rows=50, exact=EXACT) == 0
        if number == 1:
            # Without the rows of the first days, only their tails can fill the frames of later ones.
            remove_folder(spark, f"{done}/trade_date=2024-01-01", inside=done)
            store = TailStore(spark, done, 49)
            last, entry = store.ledger.last()
            spark.read.parquet(store._version(last)).limit(0).write.parquet(store._version(last + 1))
            store.ledger.commit(last + 1, {**entry, **store._shape(), "full": False})
    rows = [(m["symbol"], m["timestamp"], m["current_price"]) for t in days for m in map(json.loads, t)]
    ticks = spark.createDataFrame(rows, "symbol string, t string, current_price double").selectExpr("symbol", "CAST(t AS TIMESTAMP) AS processed_timestamp", "current_price", "CAST('2024-02-01' AS TIMESTAMP) AS batch_timestamp")
    full = with_trailing(minute_rows(time_parts(ticks)), rows=50, exact=EXACT)
    assert values(read_table(spark, done, ANALYZED_SCHEMA), *OUT) == values(full.filter("trade_date > '2024-01-01'"), *OUT)
    assert TailStore(spark, done, 49).bookmark() == 3


def test_the_plan_of_new_batches_names_their_folders_only(spark, tmp_path, instant):
    lake = str(tmp_path / "lake")
    for number in range(3):
        write_batch(spark.createDataFrame([(message("A", number, 1.0),)], "value string"), lake, number, instant)
    rows = read_batches(spark, lake, lake_batches(spark, lake, after=1))
    assert all("batch=2" in name for name in rows.inputFiles()) and len(rows.inputFiles()) == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*outcome", plan)


def held(tails):
    return {r["symbol"]: ([h["current_price"] for h in r["held"]], r["total"]) for r in tails.collect()}


def test_tails_move_on_as_if_made_anew(spark):
    rows = [(s, m, float(m + k)) for k, s in enumerate("ABC") for m in range(0, 40, 1 + 4 * k)] + [("A", 50, None), (None, 1, 1.0)]
    ticks = ticks_of(spark, rows).withColumnRenamed("processed_timestamp", "at")
    of = dict(n=6, price="current_price", order=("at",))
    edge = F.lit(START + dt.timedelta(minutes=13))
    late = F.minute("at") % 3 == 0
    old, new = ticks.filter((F.col("at") < edge) & ~late), ticks.filter((F.col("at") >= edge) | late)
    before = tails_of(old, **of)
    moved = advance(before, tails_of(new, **of), 6)
    assert held(moved) == held(tails_of(ticks, **of))
    assert {r["symbol"]: r["first_at"] for r in moved.collect()} == {s: START for s in "ABC"}
    assert tail_rows(moved).columns == ["symbol", "at", "current_price"]


def test_a_short_symbol_has_its_whole_history_in_its_tail(spark):
    rows = [("LONG", m, 1.0) for m in range(100)] + [("SHORT", m * 30, 1.0) for m in range(3)]
    history = minute_rows(time_parts(ticks_of(spark, rows)))
    tails = history_tails(history, rows=20)
    late = spark.createDataFrame([("LONG", START + dt.timedelta(minutes=81)), ("SHORT", START)], "symbol string, collection_time timestamp")
    assert [r["symbol"] for r in unserved(tails, late, 20).collect()] == ["LONG"]
    assert unserved(tails, late, 1).collect() == []


def test_copies_in_the_history_take_no_places(spark):
    parts = time_parts(ticks_of(spark, [("A", m, float(m)) for m in range(12)]))
    minutes = minute_rows(parts)
    history = minutes.filter("collection_minute < 8")
    doubled = history.unionByName(history.withColumn("average_price", F.col("average_price") - 1))
    expected = values(with_trailing(minutes, rows=5, exact=EXACT).filter("collection_minute >= 8"), *OUT)
    for tails in (None, history_tails(doubled, rows=5)):
        assert values(analyze_new(parts, doubled, rows=5, exact=EXACT, tails=tails), *OUT) == expected


def test_the_rest_of_a_known_minute_is_not_new(spark):
    history = minute_rows(time_parts(ticks_of(spark, [("A", 5, 1.0)])))
    parts = time_parts(ticks_of(spark, [("A", 5.5, 2.0), ("A", 6, 3.0)]))
    assert values(analyze_new(parts, history, tails=history_tails(history)), "current_price") == [(3.0,)]


def parts_at(spark, low, high):
    ticks = ticks_of(spark, [(s, m, float(m % 17)) for s in "AB" for m in range(low, high)])
    return time_parts(ticks.withColumns({f.name: F.lit(None).cast(f.dataType) for f in RAW_SCHEMA.fields if f.name not in ticks.columns}))


@pytest.mark.parametrize("full_every", [1, 3])
def test_the_store_follows_appends_and_finds_out_what_does_not_fit(spark, tmp_path, full_every, monkeypatch):
    done = str(tmp_path / "done")
    monkeypatch.setattr(TailStore.__init__, "__defaults__", (*TailStore.__init__.__defaults__[:-1], full_every))
    for k in range(6):
        # Every run sees part of the minutes before again.
        assert append_minutes(parts_at(spark, max(0, 20 * k - 5), 20 * k + 20), done, rows=30, exact=EXACT) == 40
        store = TailStore(spark, done, 29)
        history = read_table(spark, done, ANALYZED_SCHEMA)
        assert store.is_stored()
        assert held_prices(store.load(history.limit(0))) == held_prices(history_tails(history, rows=30))
    full = with_trailing(minute_rows(parts_at(spark, 0, 120)), rows=30, exact=EXACT)
    assert values(read_table(spark, done, ANALYZED_SCHEMA), *OUT) == values(full, *OUT)
    kept = [v for v in store.ledger.numbers() if path_exists(spark, store._version(v))]
    assert len(kept) <= 2 * full_every and store.ledger.numbers() == list(range(6))
    # Somebody else writes to the table: the stored tails are no longer its own.
    read_table(spark, done, ANALYZED_SCHEMA).limit(1).write.mode("append").partitionBy("trade_date").parquet(done)
    assert not TailStore(spark, done, 29).is_stored()
    assert not TailStore(spark, done, 5).is_stored()


def held_prices(tails):
    return {r["symbol"]: ([tuple(h) for h in r["held"]], r["total"], r["first_at"]) for r in tails.collect()}
