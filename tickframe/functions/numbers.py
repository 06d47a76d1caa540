"""Null-safe numbers, units and number texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickframe.functions.totals import each, mean_of, parts_of


def safe_number(value: Column, default: float = 0.0) -> Column:
    """Number in ``value`` (text or numeric), or ``default`` when there is none.

    Java's parser takes a type suffix (``1.5d``) and hexadecimal (``0x1p3``), which are not numbers here; digit
    groups joined by an underscore (``1_000``) are.
    """
    text = value.cast("string")
    foreign = text.rlike(r"[0-9.][dDfF]\s*$") | text.rlike(r"^\s*[+-]?0[xX]")
    number = F.regexp_replace(text, r"(?<=[0-9])_(?=[0-9])", "").try_cast("double")
    return F.coalesce(F.when(~foreign, number), F.lit(float(default)))


def quote_number(value: Column) -> Column:
    """A quote field: absent means 0.0, text that is not a number stays null so the record can be rejected."""
    return F.when(value.isNull(), F.lit(0.0)).otherwise(value.try_cast("double"))


def is_positive(value: Column) -> Column:
    """Present and above zero. Spark orders NaN above every number, so it is excluded by name."""
    number = value.cast("double")
    return F.coalesce((number > 0) & ~F.isnan(number), F.lit(False))


def when_positive(value: Column, result: Column) -> Column:
    return F.when(is_positive(value), result)


def pe_band(pe: Column) -> Column:
    """Below 15 is low, up to 25 fair, above that high; none without a positive ratio."""
    return when_positive(pe, F.when(pe < 15, "low").when(pe <= 25, "fair").otherwise("high"))


# Fixed value: won per dollar used for the converted figures.
KRW_PER_USD = 1350.0


def to_krw(usd: Column, rate: float = KRW_PER_USD) -> Column:
    return usd * F.lit(float(rate))


def billions_usd(millions: Column) -> Column:
    return millions / F.lit(1000.0)


def trillions_krw(millions: Column, rate: float = KRW_PER_USD) -> Column:
    return billions_usd(millions) * F.lit(rate / 1000.0)


def percent(ratio: Column) -> Column:
    return ratio * F.lit(100.0)


def half_even(value: Column, places: int) -> Column:
    """Round halves to the even neighbour (``round`` would round them away from zero)."""
    return F.bround(value, places)


def _pattern_text(value: Column, pattern: str) -> Column:
    # format_number rounds the binary value half-even; format_string would round its shortest text half-up.
    return F.call_function("format_number", value, F.lit(pattern))


def two_decimals_text(value: Column) -> Column:
    return _pattern_text(value, "0.00")


def one_decimal_text(value: Column) -> Column:
    return _pattern_text(value, "0.0")


def grouped_text(value: Column) -> Column:
    """Whole number with thousands separators."""
    return _pattern_text(value, "#,##0")


def signed_percent_text(value: Column) -> Column:
    """A value already in percent, with its sign: ``+1.25%``."""
    text = two_decimals_text(value)
    return F.concat(F.when(text.startswith("-"), F.lit("")).otherwise(F.lit("+")), text, F.lit("%"))


def exact_sum(value: Column, exact: str | None) -> Column:
    """Sum; with a decimal type the result does not depend on the order in which rows arrive."""
    return F.sum(value.try_cast(exact) if exact else value)


def exact_avg(value: Column, exact: str | None = None) -> Column:
    """Average of the non-null values.

    A double average differs in its last bits from run to run, because partial sums are merged in arrival order.
    Summing as ``exact`` (a decimal type that holds the values) makes it reproducible; values that are no finite number,
    or too large for the type, show in the result (``totals.mean_of``).
    """
    if not exact:
        return F.avg(value)
    return mean_of(each(parts_of(value, exact), F.sum))
