import datetime as dt
import random

import pytest
from conftest import START, ticks_of, values
from pyspark.sql import functions as F

from tickframe.functions.times import time_parts
from tickframe.operators.incremental import (
    analyze_new,
    continue_trailing,
    drop_processed,
    look_back,
    minute_rows,
    with_trailing,
)
from tickframe.plans.analyze import repaired
from tickframe.schemas import MINUTE_KEY

EXACT = "decimal(18,2)"
OUT = ("symbol", "collection_time", "moving_avg_7_days", "data_count_for_avg")


def walk(n=240, seed=0, sparse=True):
    """Minutes of two busy symbols and a rare one."""
    rng = random.Random(seed)
    rows = [(s, m * 7 * (1 + i), rng.randrange(100, 9999) / 100) for i, s in enumerate("AB") for m in range(n)]
    if sparse:
        rows += [("RARE", m * 60 * 24 * 3, rng.randrange(100, 9999) / 100) for m in range(8)]
    return rows


def split(spark, rows, cut):
    parts = time_parts(ticks_of(spark, rows))
    edge = START + dt.timedelta(minutes=cut)
    return parts, minute_rows(parts.filter(F.col("processed_timestamp") < edge))


@pytest.mark.parametrize("cut", [0, 300, 1500, 5000, 10**6])
def test_incremental_equals_full_for_any_split(spark, cut):
    parts, history = split(spark, walk(), cut)
    full = with_trailing(minute_rows(parts), rows=20, exact=EXACT)
    new = analyze_new(parts, history, rows=20, exact=EXACT)
    edge = START + dt.timedelta(minutes=cut)
    assert values(new, *OUT) == values(full.filter(F.col("collection_time") >= edge), *OUT)


@pytest.mark.parametrize("cut", [300, 5000])
def test_incremental_range_equals_full(spark, cut):
    parts, history = split(spark, walk(), cut)
    full = with_trailing(minute_rows(parts), frame="range", exact=EXACT)
    new = analyze_new(parts, history, frame="range", exact=EXACT)
    edge = START + dt.timedelta(minutes=cut)
    assert values(new, *OUT) == values(full.filter(F.col("collection_time") >= edge), *OUT)


def test_look_back_searches_older_dates_only_for_short_symbols(spark):
    parts, history = split(spark, walk(), 25_000)
    new = minute_rows(parts).filter(F.col("collection_time") >= START + dt.timedelta(minutes=25_000))
    context = look_back(history, new, rows=4, reaches=(1, 4))
    # Only the rare symbol has new rows; its last three rows lie days apart.
    assert values(context, "symbol", "collection_time") == [
        ("RARE", START + dt.timedelta(days=3 * d)) for d in (3, 4, 5)
    ]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("frame", ["rows", "range"])
def test_any_mix_of_late_and_recent_minutes(spark, seed, frame):
    """Whatever part of the minutes is new, it gets the figures of a full run."""
    rng = random.Random(seed)
    rows = []
    for symbol, days in (("DAILY", range(40)), ("WEEKLY", range(0, 40, 7)), ("ONCE", [3, 39])):
        rows += [(symbol, d * 1440 + m * 11, rng.randrange(100, 9999) / 100) for d in days for m in range(9)]
    minutes = minute_rows(time_parts(ticks_of(spark, rows)))
    late_days = rng.sample(range(40), 6)
    is_new = F.dayofyear("trade_date").isin([d + 1 for d in late_days]) & (F.col("collection_minute") % 2 == seed % 2)
    size = dict(frame=frame, rows=(3, 12, 30, 200)[seed], days=(1, 3, 7, 20)[seed], exact=EXACT)
    full = with_trailing(minutes, **size).filter(is_new)
    found = continue_trailing(minutes.filter(~is_new), minutes.filter(is_new), **size)
    assert values(found, *OUT) == values(full, *OUT)


def test_late_minutes_append_and_repair(spark):
    parts = time_parts(ticks_of(spark, walk(60, sparse=False)))
    minutes = minute_rows(parts)
    late = F.col("collection_time") == START + dt.timedelta(minutes=70)
    history = with_trailing(minutes.filter(~late), rows=20, exact=EXACT)
    full = with_trailing(minutes, rows=20, exact=EXACT)
    appended = analyze_new(parts, history, rows=20, exact=EXACT)
    assert values(appended, *OUT) == values(full.filter(late), *OUT)
    assert appended.count() == 2
    fixed = repaired(parts, history, rows=20, exact=EXACT)
    assert values(fixed, *OUT) == values(full, *OUT)


def test_pieces_of_symbols_give_the_same_figures(spark):
    minutes = minute_rows(time_parts(ticks_of(spark, walk())))
    whole, cut = (with_trailing(minutes, rows=20, exact=EXACT, **sizes) for sizes in ({}, {"chunk_rows": 30}))
    assert values(cut, *OUT) == values(whole, *OUT)


def test_nothing_new(spark):
    parts = time_parts(ticks_of(spark, walk(20)))
    history = minute_rows(parts)
    assert analyze_new(parts, history).count() == 0
    assert repaired(parts, history) is None


def test_old_layout_counts_everything_as_new(spark):
    rows = minute_rows(time_parts(ticks_of(spark, walk(20))))
    old = rows.drop("collection_hour", "collection_minute")
    assert drop_processed(rows, old).count() == rows.count()
    assert drop_processed(rows, rows).count() == 0
    assert set(MINUTE_KEY) <= set(rows.columns)


def test_newest_row_without_price_hides_the_minute(spark):
    df = ticks_of(spark, [("A", 0, 5.0), ("A", 0.5, None), ("A", 3, 6.0)])
    parts = time_parts(df)
    assert values(minute_rows(parts), "current_price") == [(6.0,)]
    assert values(minute_rows(parts, drop_missing_first=True), "current_price") == [(5.0,), (6.0,)]


def test_continue_without_history(spark):
    rows = minute_rows(time_parts(ticks_of(spark, walk(30, sparse=False))))
    alone = continue_trailing(rows.limit(0), rows, rows=5, exact=EXACT)
    assert values(alone, *OUT) == values(with_trailing(rows, rows=5, exact=EXACT), *OUT)
