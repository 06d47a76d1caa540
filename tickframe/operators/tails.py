"""The newest rows of every symbol: all that trailing figures of later rows need of the rows before them.

A tail is one row per symbol: ``held`` (its newest rows with a price, oldest first, each a struct of the order columns
and the price), ``total`` (how many such rows the symbol has) and ``first_at`` (the time of its first). A symbol whose
``total`` is the size of ``held`` has its whole history there, so nothing older has to be looked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.operators.dedup import last_rows

TAIL_COLUMNS = ("held", "total", "first_at")


def tail_schema(history: DataFrame, price: str, order: Sequence[str], symbol: str = "symbol") -> str:
    """The layout of tails of ``history`` as DDL."""
    kinds = {field.name: field.dataType.simpleString() for field in history.schema.fields}
    row = ", ".join(f"`{c}`: {kinds[c]}" for c in dict.fromkeys([*order, price]))
    return f"`{symbol}` {kinds[symbol]}, held array<struct<{row}>>, total bigint, first_at {kinds[order[0]]}"


def tails_of(
    rows: DataFrame, n: int, price: str, order: Sequence[str] = ("collection_time",), symbol: str = "symbol"
) -> DataFrame:
    """Tails of ``n`` rows from the rows themselves. Rows without a price or a symbol take no part.

    Each input task passes on ``n`` rows of a symbol and slice at most, so a hot symbol moves few rows.
    """
    row = list(dict.fromkeys([*order, price]))
    priced = rows.filter(F.col(price).isNotNull() & F.col(symbol).isNotNull()).select(symbol, *row)
    sizes = priced.groupBy(symbol).agg(F.count(F.lit(1)).alias("total"), F.min(order[0]).alias("first_at"))
    newest = last_rows(priced, n, order[0], [symbol], tie=_newest_first(order, price))
    held = newest.groupBy(symbol).agg(F.sort_array(F.collect_list(F.struct(*row))).alias("held"))
    return held.join(sizes, symbol).select(symbol, *TAIL_COLUMNS)


def _newest_first(order: Sequence[str], price: str) -> Column:
    return F.struct(*dict.fromkeys([*order, price])).desc()


def advance(tails: DataFrame, added: DataFrame, n: int, symbol: str = "symbol") -> DataFrame:
    """Tails after rows were added, for the symbols of ``added`` (tails of the added rows alone) only."""
    new = added.withColumnsRenamed({c: f"_new_{c}" for c in TAIL_COLUMNS})
    both = F.sort_array(F.concat(F.coalesce("held", F.expr("slice(_new_held, 1, 0)")), "_new_held"))
    return new.join(tails, symbol, "left").select(
        symbol,
        F.slice(both, F.greatest(F.size(both) - n, F.lit(0)) + 1, n).alias("held"),
        (F.coalesce("total", F.lit(0)) + F.col("_new_total")).alias("total"),
        F.least("first_at", "_new_first_at").alias("first_at"),
    )


def tail_rows(tails: DataFrame, symbol: str = "symbol") -> DataFrame:
    """The held rows as rows."""
    return tails.select(symbol, F.inline("held"))


def newest_times(tails: DataFrame, at: str, symbol: str = "symbol") -> DataFrame:
    return tails.select(symbol, F.element_at("held", -1)[at].alias("_newest"))


def unserved(
    tails: DataFrame, late: DataFrame, rows: int, at: str = "collection_time", symbol: str = "symbol"
) -> DataFrame:
    """Symbols with late rows whose frames of ``rows`` rows reach behind the held ones, with their first time."""
    earliest = late.groupBy(symbol).agg(F.min(at).alias("_first"))
    before = F.size(F.filter("held", lambda row: row[at] < F.col("_first")))
    whole = F.col("total") <= F.size("held")
    return earliest.join(tails, symbol).filter(~whole & (before < rows - 1)).select(symbol, "first_at")
