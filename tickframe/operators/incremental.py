"""Incremental analysis: only minutes not analysed before, with trailing figures that continue the history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators.dedup import last_rows, latest_per_minute
from tickframe.operators.rolling import EXACT, trailing_range_blocks, trailing_rows, trailing_rows_plain
from tickframe.operators.tails import newest_times, tail_rows, tails_of, unserved
from tickframe.schemas import METRIC_COPIES, MINUTE_KEY
from tickframe.session import cut_lineage, small_side

# Rows in a trailing frame, and the span the frame is named after.
FRAME_ROWS = 168
FRAME_DAYS = 7

# Days of history searched for the rows before a new one: a long weekend first, then longer, then everything.
LOOK_BACK_DAYS = (5, 35, 365)

_AVERAGE, _COUNT = "moving_avg_7_days", "data_count_for_avg"


def minute_rows(
    parts: DataFrame, price: str = "current_price", drop_missing_first: bool = False, **dedup
) -> DataFrame:
    """Deduplicated minutes with the metric copies, without minutes that have no price.

    By default the newest row of a minute wins before its price is looked at, so a minute whose newest price is missing
    disappears; ``drop_missing_first`` lets an older price of that minute stand in.
    """
    if drop_missing_first:
        parts = parts.filter(F.col(price).isNotNull())
    newest = latest_per_minute(parts, **dedup)
    copies = {name: F.col(source) for name, source in METRIC_COPIES.items() if source in newest.columns}
    return newest.withColumns({**copies, "data_points_per_minute": F.lit(1)}).filter(F.col(price).isNotNull())


def drop_processed(new: DataFrame, history: DataFrame, keys: Sequence[str] = MINUTE_KEY) -> DataFrame:
    """Rows of ``new`` whose key the history lacks.

    A history in the older layout, without hour and minute, cannot tell: every row counts as new. Rows with a null key
    would come back on every run, so ingest quarantines them before they get here.
    """
    if not set(keys) <= set(history.columns):
        return new
    return new.join(history.select(*keys), list(keys), "left_anti")


def touched_dates(df: DataFrame, date: str = "trade_date") -> list:
    """The dates that occur in ``df``. There is one per calendar day at most, so the list is small."""
    return sorted(row[0] for row in df.select(date).distinct().collect() if row[0] is not None)


def on_dates(df: DataFrame, dates: Iterable, date: str = "trade_date") -> DataFrame:
    """Literal partition values, so that other directories are not read."""
    return df.filter(F.col(date).isin(sorted(dates)))


def days_before(dates: Iterable[dt.date], days: int) -> set[dt.date]:
    """``dates`` and the ``days`` days before each of them."""
    return {day - dt.timedelta(days=back) for day in dates for back in range(days + 1)}


def _of_symbols(history: DataFrame, symbols: DataFrame, symbol: str, limit: int = 1000) -> DataFrame:
    """Rows of some symbols. A short list becomes a literal filter, which skips most pages of files that are sorted by
    symbol; a long one is joined."""
    names = [row[0] for row in symbols.select(symbol).distinct().limit(limit + 1).collect()]
    if len(names) <= limit:
        return history.filter(F.col(symbol).isin(names))
    return history.join(symbols.select(symbol), symbol, "left_semi")


def look_back(
    history: DataFrame,
    new: DataFrame,
    rows: int = FRAME_ROWS,
    reaches: Sequence[int] = LOOK_BACK_DAYS,
    symbol: str = "symbol",
    at: str = "collection_time",
    order: Sequence[str] = ("collection_time",),
    date: str = "trade_date",
    begins: DataFrame | None = None,
) -> DataFrame:
    """History rows that the trailing frames of ``new`` reach.

    A segment is a symbol's new rows of one date. It needs the history rows of that date from its first new row on,
    and the ``rows - 1`` history rows before that, but none from before the symbol's previous segment: that one brings
    its own. A segment therefore belongs to a span of dates, and spans of a symbol do not overlap, whatever mix of late
    and recent dates came in. Few days are searched first; only segments that have not found enough rows there go on
    to older ones, and in the end to the whole history of their symbol. ``begins`` (symbol, first_at) ends the search of
    a symbol at its first date.
    """
    if history.isEmpty():
        return history.limit(0)
    previous = F.lag("_segment").over(Window.partitionBy(symbol).orderBy("_segment"))
    segments = (
        new.groupBy(symbol, F.col(date).alias("_segment"))
        .agg(F.min(at).alias("_first"))
        .withColumn("_after", F.date_add(previous, 1))
    )
    if begins is not None:
        first_day = begins.select(symbol, F.to_date("first_at").alias("_begin"))
        segments = segments.join(first_day, symbol, "left").withColumn("_after", F.greatest("_after", "_begin")).drop("_begin")
    tie = [F.col(c).desc_nulls_last() for c in order if c != at]
    newest = dict(n=rows - 1, at=at, keys=[symbol, "_segment"], tie=tie[0] if tie else None)

    def found_in(spans: DataFrame, source: DataFrame) -> DataFrame:
        days = small_side(
            spans.filter("_low <= _high").select(
                symbol, "_segment", "_first", F.explode(F.sequence("_low", "_high")).alias(date)
            )
        )
        return on_dates(source, touched_dates(days, date), date).join(days, [symbol, date])

    def from_day(reach: int | None) -> Column:
        if reach is None:
            oldest = history.agg(F.min(date)).first()[0]
            return F.coalesce("_after", F.lit(oldest))
        return F.greatest("_after", F.date_sub("_segment", reach))

    near = found_in(segments.withColumns({"_low": from_day(reaches[0]), "_high": F.col("_segment")}), history)
    since = near.filter(F.col(at) >= F.col("_first")).select(*history.columns)
    before = last_rows(near.filter(F.col(at) < F.col("_first")), **newest)
    for done, reach in zip(reaches, [*reaches[1:], None]):
        before = cut_lineage(before)
        held = before.groupBy(symbol, "_segment").agg(F.count(F.lit(1)).alias("_held"))
        unfinished = (
            segments.filter(F.col("_after").isNull() | (F.col("_after") < F.date_sub("_segment", done)))
            .join(held, [symbol, "_segment"], "left")
            .filter(F.coalesce("_held", F.lit(0)) < rows - 1)
            .drop("_held")
        )
        if unfinished.isEmpty():
            break
        spans = unfinished.withColumns({"_low": from_day(reach), "_high": F.date_sub("_segment", done + 1)})
        older = found_in(spans, _of_symbols(history, unfinished, symbol)).filter(F.col(at) < F.col("_first"))
        before = last_rows(before.unionByName(older), **newest)
    return since.unionByName(before.select(*history.columns))


def with_trailing(
    df: DataFrame,
    frame: str = "rows",
    rows: int = FRAME_ROWS,
    days: int = FRAME_DAYS,
    price: str = "average_price",
    order: Sequence[str] = ("collection_time",),
    exact: str | None = None,
    **sizes,
) -> DataFrame:
    """Trailing average and count over 168 rows, or with ``frame="range"`` over the seven days the name speaks of.

    There is one row per symbol and minute, so the calendar bounds a symbol (half a million rows a year) and one shuffle
    by symbol does; ``chunk_rows`` cuts symbols into pieces all the same.
    """
    if frame == "range":
        return trailing_range_blocks(df, price, days * 86400, _AVERAGE, _COUNT, at=order[0], exact=exact or EXACT)
    if sizes:
        return trailing_rows(df, price, rows, _AVERAGE, _COUNT, order=order, exact=exact, **sizes)
    return trailing_rows_plain(df, price, rows, _AVERAGE, _COUNT, order=order, exact=exact)


def one_per_time(history: DataFrame, price: str, order: Sequence[str], date: str = "trade_date") -> DataFrame:
    """(symbol, date, order columns, price) of rows with a price; of copies the one with the largest price.

    Copies in a table that has not been cleaned up would otherwise take places in the frames of new rows. Filters on the
    date still reach the scan, since it is one of the grouping keys.
    """
    keys = list(dict.fromkeys(["symbol", date, *order]))
    return history.filter(F.col(price).isNotNull()).groupBy(*keys).agg(F.max(price).alias(price))


def history_tails(
    history: DataFrame,
    rows: int = FRAME_ROWS,
    price: str = "average_price",
    order: Sequence[str] = ("collection_time",),
) -> DataFrame:
    """Tails (``operators/tails.py``) of a history that has none stored beside it."""
    return tails_of(one_per_time(history, price, order), rows - 1, price, order)


def continue_trailing(
    history: DataFrame,
    new: DataFrame,
    frame: str = "rows",
    rows: int = FRAME_ROWS,
    days: int = FRAME_DAYS,
    price: str = "average_price",
    order: Sequence[str] = ("collection_time",),
    exact: str | None = None,
    tails: DataFrame | None = None,
    late: DataFrame | None = None,
    **sizes,
) -> DataFrame:
    """``new`` with the trailing figures a run over history and new rows together would give it.

    With ``tails`` of the history, rows behind a symbol's newest row need nothing but its tail. ``late`` names the other
    ones among ``new``; the history is searched only for those whose frame reaches behind the tail. Without tails it is
    searched for all.
    """
    at = order[0]
    context_columns = list(dict.fromkeys(["symbol", "trade_date", *order, price]))
    past = one_per_time(history, price, order).select(*context_columns)
    if frame == "range":
        reached = on_dates(past, days_before(touched_dates(new), days))
        context = reached.join(new.select("symbol").distinct(), "symbol", "left_semi")
    elif tails is None:
        context = look_back(past, new, rows, at=at, order=order)
    else:
        context = _from_tails(past, new, tails, late, rows, at, order)
    combined = new.withColumn("_new", F.lit(True)).unionByName(
        context.withColumn("_new", F.lit(False)), allowMissingColumns=True
    )
    return with_trailing(combined, frame, rows, days, price, order, exact, **sizes).filter("_new").drop("_new")


def _from_tails(past, new, tails, late, rows, at, order) -> DataFrame:
    touched = tails.join(new.select("symbol").distinct(), "symbol", "left_semi")
    if late is None:
        return tail_rows(touched)
    missing = small_side(unserved(tails, late, rows, at))
    if missing.isEmpty():
        return tail_rows(touched)
    found = look_back(past, new.join(missing, "symbol", "left_semi"), rows, at=at, order=order, begins=missing)
    held = tail_rows(touched.join(missing, "symbol", "left_anti"))
    return found.unionByName(held, allowMissingColumns=True)


def analyze_new(
    parts: DataFrame,
    history: DataFrame,
    keys: Sequence[str] = MINUTE_KEY,
    dedup: dict | None = None,
    tails: DataFrame | None = None,
    **trailing,
) -> DataFrame:
    """Minutes of ``parts`` that the history lacks, deduplicated, with continued trailing figures.

    The new minutes feed several steps, so they are written once instead of being recomputed for each. With ``tails``,
    minutes after a symbol's newest one cannot be in the history, so only late ones are compared with it, and the history
    is not read at all where there are none.
    """
    if tails is None or not set(keys) <= set(history.columns):
        known = on_dates(history, touched_dates(parts))
        new = cut_lineage(drop_processed(minute_rows(parts, **(dedup or {})), known, keys))
        return continue_trailing(history, new, tails=tails, late=new if tails is not None else None, **trailing)
    at = trailing.get("order", ("collection_time",))[0]
    rows = minute_rows(parts, **(dedup or {})).join(newest_times(tails, at), "symbol", "left")
    # A key covers a minute, so the rest of the newest minute counts as late.
    is_late = F.coalesce(F.date_trunc("minute", at) <= F.date_trunc("minute", "_newest"), F.lit(False))
    rows = cut_lineage(rows.withColumn("_late", is_late).drop("_newest"))
    late = rows.filter("_late")
    if late.isEmpty():
        return continue_trailing(history, rows.drop("_late"), tails=tails, **trailing)
    late = drop_processed(late, on_dates(history, touched_dates(late)), keys)
    rows = cut_lineage(rows.filter("NOT _late").unionByName(late))
    late = rows.filter("_late")
    return continue_trailing(
        history, rows.drop("_late"), tails=tails, late=None if late.isEmpty() else late, **trailing
    )
