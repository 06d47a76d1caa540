"""Price indicators of one tick."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.functions.numbers import is_positive


def derive_indicators(
    df: DataFrame,
    current: str = "current_price",
    previous: str = "previous_close",
    high: str = "high_price",
    low: str = "low_price",
) -> DataFrame:
    """Daily return, its size, the day's range and the position in it; all null without a previous close."""
    price, close = F.col(current), F.col(previous)
    spread = F.col(high) - F.col(low)
    change = (price - close) / close
    position = F.when(spread > 0, (price - F.col(low)) / spread).otherwise(F.lit(0.5))

    def guarded(result: Column) -> Column:
        return F.when(is_positive(close), result)

    return df.withColumns(
        {
            "daily_return": guarded(change),
            "volatility": guarded(F.abs(change)),
            "price_range": guarded(spread),
            "price_position": guarded(position),
        }
    )
