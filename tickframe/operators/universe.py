"""Which symbols to follow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default, trending and ranked large-cap symbol lists.
DEFAULT_SYMBOLS = "TSLA,NVDA,AMD,QCOM,INTC,AAPL,GOOGL,MSFT"
TRENDING_SYMBOLS = ["AAPL", "MSFT", "GOOGL", "AMZN", "TSLA", "NVDA", "META", "NFLX"]
LARGE_CAP_SYMBOLS = [
    "AAPL", "MSFT", "AMZN", "NVDA", "GOOGL", "TSLA", "META", "GOOG",
    "BRK.B", "UNH", "JNJ", "XOM", "JPM", "V", "PG", "AVGO",
]


def parse_symbols(lists: DataFrame, text: str = "symbols") -> DataFrame:
    """Comma-separated lists to trimmed symbols, numbered in list order."""
    parts = F.transform(F.split(F.col(text), ","), lambda part: F.trim(part))
    others = [c for c in lists.columns if c != text]
    return lists.select(*others, F.posexplode(parts).alias("position", "symbol")).select(
        *others, (F.col("position") + 1).alias("rank_no"), "symbol"
    )


def ranked(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(i, name) for i, name in enumerate(names, 1)], "rank_no int, symbol string")


def top_symbols(universe: DataFrame, n: int = 10) -> DataFrame:
    return universe.orderBy("rank_no", "symbol").limit(n)


def choose_universe(spark: SparkSession, method: str = "manual", symbols: str = DEFAULT_SYMBOLS) -> DataFrame:
    """``trending``, the top ten of the large caps (``large_cap`` or ``sp500``), or any other name for the given list."""
    if method == "trending":
        return ranked(spark, TRENDING_SYMBOLS)
    if method in ("large_cap", "sp500"):
        return top_symbols(ranked(spark, LARGE_CAP_SYMBOLS))
    return parse_symbols(spark.createDataFrame([(symbols,)], "symbols string"))


def restrict(df: DataFrame, universe: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows whose symbol is in the universe."""
    return df.join(universe.select(key), key, "left_semi")
