"""Exact totals that show what they cannot hold.

A total is a tuple: the sum of the values that fit a decimal type, the number of all values, and how many of them were
NaN, plus or minus infinity, or too large for the type. Each part is a plain sum, so totals can be added and taken from
each other without loss, which totals that hold a NaN themselves could not.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("_sum", "_n", "_nan", "_up", "_down", "_lost")


def parts_of(value: Column, exact: str) -> dict[str, Column]:
    """The total of one value; digits behind the type's last place are rounded."""
    number, double = value.try_cast(exact), value.cast("double")
    nan, up, down = F.isnan(double), double == float("inf"), double == float("-inf")

    def one(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    return {
        "_sum": F.coalesce(number, F.lit(0).cast(exact)),
        "_n": one(value.isNotNull()),
        "_nan": one(nan),
        "_up": one(up),
        "_down": one(down),
        "_lost": one(value.isNotNull() & number.isNull() & ~nan & ~up & ~down),
    }


def each(parts: Mapping[str, Column], change: Callable[[Column], Column]) -> dict[str, Column]:
    return {name: change(part) for name, part in parts.items()}


def mean_of(total: Mapping[str, Column]) -> Column:
    """Average of a total, as doubles would have it: NaN beats all, infinities of both signs are NaN, one sign wins.

    Without values it is null, and so it is, beside a count above zero, where a value was too large for the type.
    """
    infinite = F.when(total["_up"] > 0, F.when(total["_down"] > 0, float("nan")).otherwise(float("inf")))
    infinite = infinite.when(total["_down"] > 0, float("-inf"))
    finite = F.try_divide(total["_sum"].cast("double"), total["_n"].cast("double"))
    return F.when(total["_nan"] > 0, float("nan")).otherwise(
        F.coalesce(infinite, F.when(total["_lost"] == 0, finite))
    )
