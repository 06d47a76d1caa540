"""Keep one row per key, deterministically.

``row_number() = k`` filters become a partial limit before the shuffle (WindowGroupLimit), so a key that holds a large
part of the table sends at most ``k`` rows from each input task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.schemas import MINUTE_KEY

_RANK = "_rank"


def tie_break(df: DataFrame) -> Column:
    """An order over whole rows, so that equal sort keys do not leave the winner to chance."""
    return F.xxhash64(*df.columns)


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, tie: Column | None = None
) -> DataFrame:
    """The first ``n`` rows of each key under ``order``; ``tie`` makes the order total."""
    window = Window.partitionBy(*keys).orderBy(*order, tie_break(df) if tie is None else tie)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) <= n).drop(_RANK)


def latest_per_minute(
    df: DataFrame,
    keys: Sequence[str] = MINUTE_KEY,
    recency: Sequence[str] = ("batch_timestamp", "processed_timestamp"),
    tie: Column | None = None,
) -> DataFrame:
    """Newest row per symbol and minute.

    All rows of one ingest run share its batch instant, so the event time decides between two polls of one minute.
    """
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in recency], tie=tie)


# Preference between two analysed rows of one key.
_BEST = ["moving_avg_7_days", "average_price"]


def best_per_key(
    df: DataFrame,
    keys: Sequence[str] = MINUTE_KEY,
    prefer: Sequence[str] = (*_BEST, "data_points_per_minute"),
    tie: Column | None = None,
) -> DataFrame:
    """Row with the largest averages per key; pass ``DAY_KEY`` for one row per symbol and day."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in prefer], tie=tie)


def serving_rows(
    df: DataFrame, prefer: Sequence[str] = (*_BEST, "data_count_for_avg"), tie: Column | None = None
) -> DataFrame:
    """One row per symbol and instant, or per symbol and day in tables, or rows, without an instant.

    A stored table may hold days of an older layout, whose rows have a date only: each day is a key of its own.
    """
    if "collection_time" not in df.columns:
        return best_per_key(df, ["symbol", "trade_date"], prefer, tie)
    dated = F.when(F.col("collection_time").isNull(), F.col("trade_date")) if "trade_date" in df.columns else F.lit(None)
    tie = tie_break(df) if tie is None else tie
    return best_per_key(df.withColumn("_day", dated), ["symbol", "collection_time", "_day"], prefer, tie).drop("_day")


def latest_per_symbol(
    df: DataFrame, at: str = "collection_time", keys: Sequence[str] = ("symbol",), tie: Column | None = None
) -> DataFrame:
    return keep_first(df, keys, [F.col(at).desc_nulls_last()], tie=tie)


def last_rows(
    df: DataFrame,
    n: int,
    at: str = "collection_time",
    keys: Sequence[str] = ("symbol",),
    tie: Column | None = None,
    fan_in: int = 32,
) -> DataFrame:
    """Last ``n`` rows per symbol.

    Every input task may keep ``n`` rows of a hot symbol, so the limit is applied per salted slice first: the final
    task of a symbol then sees at most ``n * fan_in`` rows, however many input tasks there were.
    """
    tie = tie_break(df) if tie is None else tie
    newest = [F.col(at).desc_nulls_last()]
    salted = df.withColumn("_slice", F.pmod(tie_break(df), F.lit(fan_in)))
    sliced = keep_first(salted, [*keys, "_slice"], newest, n, tie)
    return keep_first(sliced.drop("_slice"), keys, newest, n, tie)
