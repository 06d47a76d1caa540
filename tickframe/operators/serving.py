"""Figures, series and tables for display, all computed before anything is collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.functions import numbers as N
from tickframe.operators.dedup import last_rows, latest_per_symbol

# Column labels of the detail table.
KOREAN_LABELS = {
    "symbol": "종목",
    "trade_date": "날짜",
    "collection_time": "수집시간",
    "collection_hour": "시",
    "collection_minute": "분",
    "average_price": "평균가격",
    "moving_avg_7_days": "7일이평",
    "avg_market_cap": "시가총액(M)",
    "avg_pe_ratio": "P/E비율",
    "avg_volatility": "변동성(%)",
}
# Fixed value: rows in the recent-history chart.
RECENT_ROWS = 216
DETAIL_COLUMNS = [
    "symbol",
    "collection_time",
    "trade_date",
    "collection_hour",
    "collection_minute",
    "average_price",
    "moving_avg_7_days",
    "avg_market_cap",
    "avg_pe_ratio",
    "avg_volatility",
]


# Columns that the headline figures are made of.
KPI_COLUMNS = ["average_price", "avg_daily_return", "avg_market_cap", "avg_pe_ratio", "avg_volatility"]


def time_column(df: DataFrame) -> str:
    return "collection_time" if "collection_time" in df.columns else "trade_date"


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def one_symbol(df: DataFrame, symbol: str) -> DataFrame:
    return df.filter(F.col("symbol") == symbol)


def kpis(df: DataFrame, krw_rate: float = N.KRW_PER_USD, tie: Column | None = None) -> DataFrame:
    """Headline figures of every symbol's newest row; a figure whose input is absent or not positive is null.

    Only the columns shown are read, unless ``tie`` may name others.
    """
    rows = df if tie is not None else df.select(*present(df, ["symbol", time_column(df), *KPI_COLUMNS]))
    newest = latest_per_symbol(rows, time_column(df), tie=tie)

    def metric(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("double")

    price, cap, pe, swing = (
        metric(c) for c in ("average_price", "avg_market_cap", "avg_pe_ratio", "avg_volatility")
    )
    return newest.select(
        "symbol",
        price.alias("price"),
        N.to_krw(price, krw_rate).alias("price_krw"),
        N.percent(metric("avg_daily_return")).alias("return_pct"),
        N.when_positive(cap, N.billions_usd(cap)).alias("cap_billion_usd"),
        N.when_positive(cap, N.trillions_krw(cap, krw_rate)).alias("cap_trillion_krw"),
        N.when_positive(pe, pe).alias("pe_ratio"),
        N.pe_band(pe).alias("pe_band"),
        N.when_positive(swing, N.percent(swing)).alias("volatility_pct"),
    )


def kpi_texts(figures: DataFrame) -> DataFrame:
    """Display texts of ``kpis``: missing figures read N/A, a missing return stays empty."""

    def shown(text: Column) -> Column:
        return F.coalesce(text, F.lit("N/A"))

    return figures.select(
        "symbol",
        F.concat(F.lit("$"), N.two_decimals_text(F.col("price"))).alias("price_text"),
        N.grouped_text(F.col("price_krw")).alias("price_krw_text"),
        F.concat(N.two_decimals_text(F.col("return_pct")), F.lit("%")).alias("return_text"),
        shown(F.concat(F.lit("$"), N.one_decimal_text(F.col("cap_billion_usd")), F.lit("B"))).alias("cap_text"),
        N.one_decimal_text(F.col("cap_trillion_krw")).alias("cap_krw_text"),
        shown(N.one_decimal_text(F.col("pe_ratio"))).alias("pe_text"),
        shown(F.concat(N.two_decimals_text(F.col("volatility_pct")), F.lit("%"))).alias("volatility_text"),
    )


def price_series(df: DataFrame) -> DataFrame:
    """Time, price and trailing average of each symbol, in time order."""
    at = time_column(df)
    return df.select("symbol", at, *present(df, ["average_price", "moving_avg_7_days"])).orderBy("symbol", at)


def _in_time(df: DataFrame, *values: Column | str) -> DataFrame:
    """Symbol, date and time where there is one, and the values, in time order."""
    return df.select("symbol", *dict.fromkeys(["trade_date", time_column(df)]), *values).orderBy("symbol", time_column(df))


def market_cap_series(df: DataFrame) -> DataFrame:
    return _in_time(df, N.billions_usd(F.col("avg_market_cap")).alias("cap_billion_usd"))


def pe_series(df: DataFrame) -> DataFrame:
    return _in_time(df, "avg_pe_ratio")


def recent_history(df: DataFrame, n: int = RECENT_ROWS, tie: Column | None = None) -> DataFrame:
    return last_rows(df, n, time_column(df), tie=tie)


def detail_table(
    df: DataFrame, columns: Sequence[str] = DETAIL_COLUMNS, labels: Mapping[str, str] | None = KOREAN_LABELS
) -> DataFrame:
    """Newest-first table of the display columns that exist, rounded and labelled."""
    shown = df.select(*present(df, columns)).orderBy(F.col(time_column(df)).desc_nulls_last())
    rounding = {}
    if "avg_market_cap" in shown.columns:
        rounding["avg_market_cap"] = N.half_even(F.col("avg_market_cap"), 0)
    if "avg_volatility" in shown.columns:
        rounding["avg_volatility"] = N.half_even(N.percent(F.col("avg_volatility")), 2)
    rounded = shown.withColumns(rounding) if rounding else shown
    return rounded.withColumnsRenamed(dict(labels)) if labels else rounded
