"""Late ticks, rejected quotes, versions of documents, row digests, swaps that were cut short, and stored layouts."""

import datetime as dt
import re

import pytest
from conftest import START, values
from pyspark.sql import Row
from pyspark.sql import functions as F
from test_continued import parts_at

from tickframe.__main__ import main
from tickframe.functions.digests import row_digest
from tickframe.operators.dedup import serving_rows
from tickframe.operators.enrich import enrich_as_of, judged_quotes, quote_quarantine, quote_rows
from tickframe.operators.quality import quality_report
from tickframe.plans.analyze import append_minutes
from tickframe.plans.serve import newest_stored, run_kpis
from tickframe.plans.upkeep import run_cleanup
from tickframe.schemas import ANALYZED_SCHEMA
from tickframe.session import new_path, path_exists
from tickframe.sources import finish_swaps, parse_documents, read_layouts, read_table, sinks, staged_overwrite
from tickframe.streaming.minutes import MinuteSteps, start_minutes

TICK = "symbol string, processed_timestamp timestamp, n int"


def ticks(spark, rows):
    at = [(s, None if m is None else START + dt.timedelta(minutes=m), n) for s, m, n in rows]
    return spark.createDataFrame(at, TICK)


@pytest.fixture
def steps(spark, tmp_path):
    return MinuteSteps(spark, str(tmp_path / "m"), ticks(spark, []).schema, recency=("processed_timestamp", "n"), delay_seconds=300)


def rows_of(frame):
    return sorted((r.symbol, r.minute_start and int((r.minute_start - START).total_seconds() // 60), r.n, r.n_ticks) for r in frame.collect())


def test_late_ticks_stand_aside_and_nothing_is_lost(spark, steps):
    first = [("A", 0, 1), ("A", 0.5, 2), ("B", 3, 3), ("A", 9, 4)]
    second = [("A", 0.9, 5), ("A", 4.2, 6), ("B", 3.5, 7), (None, 9, 8), ("C", None, 9), ("A", 10, 10)]
    steps.add(ticks(spark, first), 0)
    assert rows_of(steps.read("closed")) == [("A", 0, 2, 2), ("B", 3, 3, 1)]
    assert rows_of(steps.read("open")) == [("A", 9, 4, 1)]
    assert steps.add(ticks(spark, second), 1) == steps.add(ticks(spark, second), 1)
    assert {r.n for r in steps.read("late").collect()} == {5, 7, 8, 9}
    assert rows_of(steps.read("closed")) == [("A", 0, 2, 2), ("A", 4, 6, 1), ("B", 3, 3, 1)]
    steps.close(START + dt.timedelta(days=1))
    assert steps.read("open").count() == 0
    counted = steps.read("closed").agg(F.sum("n_ticks")).first()[0]
    assert counted + steps.read("late").count() == len(first) + len(second)
    with pytest.raises(ValueError):
        steps.read("other")


def test_an_open_minute_takes_later_ticks(spark, steps):
    steps.add(ticks(spark, [("A", 1, 1)]), 0)
    steps.add(ticks(spark, []), 1)
    steps.add(ticks(spark, [("A", 1.5, 2), ("A", 1.2, 3)]), 2)
    assert rows_of(steps.read("open")) == [("A", 1, 2, 3)]


def test_a_step_that_ended_early_is_run_again(spark, steps, monkeypatch):
    steps.add(ticks(spark, [("A", 0, 1)]), 0)
    with monkeypatch.context() as patch:
        patch.setattr(steps.ledger, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            steps.add(ticks(spark, [("A", 20, 2)]), 1)
    assert rows_of(steps.read("open")) == [("A", 0, 1, 1)]
    steps.add(ticks(spark, [("A", 20, 2)]), 1)
    assert rows_of(steps.read("closed")) == [("A", 0, 1, 1)] and rows_of(steps.read("open")) == [("A", 20, 2, 1)]


def test_steps_over_a_stream(spark, tmp_path, steps):
    source = str(tmp_path / "source")
    for part in ([("A", 0, 1), ("A", 30, 2)], [("A", 1, 3)]):
        ticks(spark, part).coalesce(1).write.mode("append").parquet(source)
        start_minutes(spark.readStream.schema(TICK).parquet(source), steps).awaitTermination()
    assert rows_of(steps.read("late")) == [("A", 1, 3, 1)] and steps.ledger.numbers() == [0, 1]


def test_quotes_are_used_or_rejected_with_a_reason(spark):
    texts = ['{"symbol":"A","c":1.5}', '{"symbol":"B","c":0}', '{"symbol":"C","c":null}', '{"symbol":"D","c":2,"h":"x"}', '{"c":3}', "[]", "oops", None, '{"symbol":"E"}', '{"symbol":"F","c":"0","h":"x"}']
    quotes = parse_documents(spark.createDataFrame([(t,) for t in texts], "value string"), ["c", "h", "t", "polled_at"])
    found = {r.document: r.reason for r in quote_quarantine(quotes, {"current_price": "c", "high_price": "h"}).collect()}
    assert found == {texts[1]: "empty_quote", texts[2]: "null:current_price", texts[3]: "not_a_number:high_price", texts[4]: "no_symbol", texts[5]: "no_symbol", texts[6]: "no_symbol", None: "no_symbol", texts[9]: "empty_quote"}
    usable = quote_rows(quotes, {"current_price": "c", "high_price": "h"})
    assert values(usable, "symbol", "current_price", "high_price") == [("A", 1.5, 0.0), ("E", 0.0, 0.0)]
    assert judged_quotes(quotes).count() == len(texts)


def test_versions_at_the_time_of_the_tick(spark):
    at = [0, 5, 10, 1500, 1500, 6000, None]
    rows = [(i, s, None if m is None else START + dt.timedelta(minutes=m)) for i, (s, m) in enumerate((s, m) for s in ("HOT", "B", None) for m in at)]
    frame = spark.createDataFrame(rows, "id int, symbol string, at timestamp")
    data = [("HOT", 5, "a", 1), ("HOT", 5, "b", 2), ("HOT", 1499, "c", 3), ("HOT", 5999, None, 4), ("B", 10, "z", 5), (None, 0, "n", 6), ("B", None, "m", 7)]
    versions = spark.createDataFrame([(s, None if m is None else START + dt.timedelta(minutes=m), t, v) for s, m, t, v in data], "symbol string, since timestamp, name string, v int")
    expected = {}
    for i, s, t in rows:
        known = [(v.since, v.v, v.name) for v in versions.collect() if s and t and v.symbol == s and v.since and v.since <= t]
        expected[i] = max(known, key=lambda k: k[:2])[1:] if known else (None, None)
    for bucket in (60, 86400, 10**8):
        found = enrich_as_of(frame, versions, "at", "since", bucket_seconds=bucket, tie=F.col("v").desc())
        assert {r.id: (r.v, r.name) for r in found.collect()} == expected and found.columns == ["id", "symbol", "at", "name", "v"]
    assert enrich_as_of(frame, versions.limit(0), "at", "since").filter("v IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        enrich_as_of(frame, versions.withColumnRenamed("name", "id"), "at", "since")


def test_digests_are_equal_where_spark_groups(spark):
    kinds = "a string, b string, d double, t timestamp, x binary, l array<string>, s struct<p: string, q: string>"
    base = ("", "x", 0.0, START, b"\x00", ["a", None], Row(p="1", q=None))
    rows = [base, base, (None, *base[1:]), ("x", "", *base[2:]), (*base[:2], -0.0, *base[3:]), (*base[:2], float("nan"), *base[3:]), (*base[:2], float("nan"), *base[3:])]
    rows += [(*base[:5], ["a,", ""], base[6]), (*base[:5], ["a", ""], base[6]), (*base[:5], ["a"], base[6]), (*base[:5], None, base[6]), (*base[:6], Row(p=None, q="1")), (*base[:6], None), ("1:", "-", *base[2:]), ("1", ":-", *base[2:])]
    frame = spark.createDataFrame(rows, kinds)
    by_value = frame.groupBy(*frame.columns).count().count()
    digests = frame.select(row_digest(frame).alias("d"))
    assert digests.distinct().count() == by_value and {len(r.d) for r in digests.collect()} == {32}


def test_wide_rows_move_as_digests(spark):
    wide = spark.range(50).select(*[(F.col("id") % 7 if i else F.when(F.col("id") % 5 > 0, F.col("id"))).alias(f"c{i}") for i in range(80)])
    doubled = wide.unionByName(wide.limit(10))
    report = quality_report(doubled, "c1", max_duplicates=1, max_nulls=None)
    plan = re.sub(r"#\d+L?", "", report._jdf.queryExecution().executedPlan().toString())
    moved = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "_row" in moved and "c2" not in moved
    first = report.first()
    copies = doubled.filter("c0 IS NULL").count()
    assert (first.total, first.duplicates, first.nulls_c0, first.nulls_c79, first.invalid_prices) == (60, 60 - doubled.distinct().count(), copies, 0, doubled.filter("c1 <= 0").count())
    keyed = quality_report(doubled, "c1", keys=["c0"], max_duplicates=1, max_nulls=None).first()
    assert (keyed.duplicates, keyed.nulls_c0) == (60 - wide.select("c0").distinct().count(), copies)


def test_the_rule_can_be_chosen(spark):
    rows = spark.createDataFrame([(1.0, None, "a")] * 1 + [(2.0, "x", "b")] * 1, "price double, rare string, key string")
    assert not quality_report(rows, "price").first().passed
    assert quality_report(rows, "price", max_nulls=None).first().passed
    assert quality_report(rows, "price", max_nulls=None, max_column_nulls={"rare": 0.6, "key": 0.0, "absent": 0.1}).first().passed
    assert not quality_report(rows, "price", max_nulls=None, max_column_nulls={"rare": 0.5}).first().passed
    assert not quality_report(rows, "price", max_nulls=None, max_column_nulls=0.0).first().passed


@pytest.mark.parametrize("broken", ["before the swap", "within the swap", "before the entry"])
def test_a_swap_that_was_cut_short_is_finished(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "t")
    table = spark.range(20).select("id", (F.col("id") % 4).alias("part"))
    table.write.partitionBy("part").parquet(path)
    changed = read_table(spark, path, "id bigint, part bigint").filter("part < 2").withColumn("id", F.col("id") + 100)
    folders = []
    with monkeypatch.context() as patch:
        real = sinks._swap
        patch.setattr(sinks, "new_path", lambda s, label: folders.append(new_path(s, label)) or folders[-1])

        def end(spark, path, plan):
            if broken == "within the swap":
                spark.read.schema("id bigint, part bigint").parquet(plan["staging"]).limit(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
            elif broken == "before the entry":
                real(spark, path, plan)
            raise OSError("lost")

        patch.setattr(sinks, "_swap", end)
        with pytest.raises(OSError):
            staged_overwrite(changed, path, ["part"])
    assert finish_swaps(spark, path) == 10
    expected = sorted([i + 100 for i in range(20) if i % 4 < 2] + [i for i in range(20) if i % 4 >= 2])
    assert [r.id for r in read_table(spark, path, "id bigint, part bigint").orderBy("id").collect()] == expected
    assert finish_swaps(spark, path) is None and not any(path_exists(spark, f) for f in folders)


def test_the_next_run_finishes_the_swap_of_the_one_before(spark, tmp_path, monkeypatch):
    done = str(tmp_path / "done")
    append_minutes(parts_at(spark, 0, 30), done)
    rows = read_table(spark, done, ANALYZED_SCHEMA)
    rows.withColumn("moving_avg_7_days", F.col("moving_avg_7_days") - 1).write.mode("append").partitionBy("trade_date").parquet(done)
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_swap", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_cleanup(spark, done)
    assert append_minutes(parts_at(spark, 20, 40), done) == 20
    assert read_table(spark, done, ANALYZED_SCHEMA).count() == 80


def test_older_layouts_are_found_in_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("A", dt.date(2024, 1, d), 1.0) for d in range(1, 11)], "symbol string, trade_date date, moving_avg_7_days double")
    new = spark.createDataFrame([("A", dt.date(2024, 1, 11), START + dt.timedelta(days=10, minutes=m), 2.0, m + 1.0) for m in (0, 0, 1)], "symbol string, trade_date date, collection_time timestamp, average_price double, moving_avg_7_days double")
    for rows in (old, old, new):
        rows.write.mode("append").partitionBy("trade_date").parquet(path)
    found = serving_rows(read_layouts(spark, path), prefer=("moving_avg_7_days",))
    assert found.filter("collection_time IS NULL").count() == 10 and found.count() == 12
    assert read_layouts(spark, str(tmp_path / "none"), ANALYZED_SCHEMA).count() == 0
    assert newest_stored(spark, str(tmp_path / "none")).count() == 0


def test_headline_figures_read_their_own_dates_and_columns(spark, tmp_path):
    done = str(tmp_path / "done")
    assert run_kpis(spark, done).count() == 0
    for day in (0, 1, 2):
        append_minutes(parts_at(spark, 1440 * day, 1440 * day + 5).filter("symbol = 'A' OR trade_date = '2024-01-01'"), done)
    newest = newest_stored(spark, done)
    assert values(newest, "symbol", "collection_time") == [("A", START + dt.timedelta(minutes=2884)), ("B", START + dt.timedelta(minutes=4))]
    scan = newest._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[trade_date#\d+ IN \(2024-01-01,2024-01-03\)", scan)
    assert max(len(columns.split(",")) for columns in re.findall(r"FileScan parquet \[([^\]]*)\]", scan)) < 10
    assert [r.symbol for r in run_kpis(spark, done).orderBy("symbol").collect()] == ["A", "B"]
    # Somebody else has written to the table: the tails no longer fit, and the table itself is read.
    read_table(spark, done, ANALYZED_SCHEMA).limit(1).write.mode("append").partitionBy("trade_date").parquet(done)
    assert values(run_kpis(spark, done), "symbol") == [("A",), ("B",)]


def test_command_line_needs_one_way_in(capsys):
    for argv in (["ingest"], ["ingest", "--raw", "x", "--quarantine", "y", "--every", "1 minute"], ["analyze", "--analyzed", "x"], ["analyze", "--analyzed", "x", "--lake", "l", "--raw", "r"], ["analyze", "--analyzed", "x", "--lake", "l", "--since", "2024-01-01"]):
        with pytest.raises(SystemExit):
            main(argv)
    capsys.readouterr()
