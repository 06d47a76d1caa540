"""Quotes, company profiles and metrics merged into ticks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.numbers import quote_number, safe_number
from tickframe.functions.times import epoch_text, iso_text
from tickframe.operators.dedup import keep_first, tie_break
from tickframe.sources.messages import NULL_KEYS

# Document keys and the tick columns they fill.
QUOTE_KEYS = {
    "current_price": "c",
    "open_price": "o",
    "high_price": "h",
    "low_price": "l",
    "previous_close": "pc",
    "price_change": "d",
    "percent_change": "dp",
}
PROFILE_TEXT_KEYS = {
    "company_name": "name",
    "industry": "industry",
    "country": "country",
    "currency": "currency",
    "exchange": "exchange",
    "ipo_date": "ipo",
}
PROFILE_NUMBER_KEYS = {"market_cap": "marketCapitalization"}
METRIC_KEYS = {
    "pe_ratio": "peBasicExclExtraTTM",
    "pb_ratio": "pbAnnual",
    "eps_ttm": "epsBasicExclExtraAnnual",
    "dividend_yield": "dividendYieldIndicatedAnnual",
    "beta": "beta",
    "week_52_high": "52WeekHigh",
    "week_52_low": "52WeekLow",
    "volume_10day_avg": "10DayAverageTradingVolume",
}
# Text used when a profile document lacks a key.
TEXT_DEFAULTS = {"currency": "USD"}


def _named(df: DataFrame, key: str):
    return F.col(f"`{key}`") if key in df.columns else F.lit(None)


def _null_in(df: DataFrame, key: str):
    """Whether a document has the key with a null, where its source can tell that from a missing key."""
    return F.array_contains(NULL_KEYS, key) if NULL_KEYS in df.columns else F.lit(False)


def judged_quotes(quotes: DataFrame, keys: Mapping[str, str] = QUOTE_KEYS, polled_at: str = "polled_at") -> DataFrame:
    """Quote documents as tick columns, with ``_reason``, null for a usable quote, and ``_document``.

    A price of zero marks an empty quote; an absent price is kept as 0.0. A field that is there but null, or not a number,
    makes the whole record unusable, and the reason names it; so does a missing symbol.
    """
    columns = {name: quote_number(_named(quotes, key)) for name, key in keys.items()}
    texts = [c for c in quotes.columns if c not in (NULL_KEYS, "document")]
    document = F.col("document") if "document" in quotes.columns else F.to_json(F.struct(*[F.col(f"`{c}`") for c in texts]))
    price = _named(quotes, keys["current_price"])
    reason = F.when(F.col("symbol").isNull(), F.lit("no_symbol"))
    for name, key in keys.items():
        reason = reason.when(_null_in(quotes, key), F.lit(f"null:{name}")).when(columns[name].isNull(), F.lit(f"not_a_number:{name}"))
    return quotes.select(
        "symbol",
        *[value.alias(name) for name, value in columns.items()],
        iso_text(F.col(polled_at).try_cast("timestamp")).alias("timestamp"),
        epoch_text(F.coalesce(_named(quotes, "t").try_cast("bigint"), F.lit(0))).alias("market_timestamp"),
        F.when(F.coalesce(price.try_cast("double") == 0, F.lit(False)), F.lit("empty_quote")).otherwise(reason).alias("_reason"),
        document.alias("_document"),
    )


def quote_rows(quotes: DataFrame, keys: Mapping[str, str] = QUOTE_KEYS, polled_at: str = "polled_at") -> DataFrame:
    """The usable quotes as tick columns; what is left out is in ``quote_quarantine``."""
    return judged_quotes(quotes, keys, polled_at).filter(F.col("_reason").isNull()).drop("_reason", "_document")


def quote_quarantine(quotes: DataFrame, keys: Mapping[str, str] = QUOTE_KEYS, polled_at: str = "polled_at") -> DataFrame:
    """Quotes that cannot be used: symbol, reason, and the document. Empty ones are there too, so nothing is uncounted."""
    rejected = judged_quotes(quotes, keys, polled_at).filter(F.col("_reason").isNotNull())
    return rejected.select("symbol", F.col("_reason").alias("reason"), F.col("_document").alias("document"))


def profile_rows(
    profiles: DataFrame,
    text_keys: Mapping[str, str] = PROFILE_TEXT_KEYS,
    number_keys: Mapping[str, str] = PROFILE_NUMBER_KEYS,
    defaults: Mapping[str, str] = TEXT_DEFAULTS,
) -> DataFrame:
    """Profile documents as tick columns. A missing text has its default; one that is there but null stays null."""
    texts = [
        F.when(~_null_in(profiles, key), F.coalesce(_named(profiles, key).cast("string"), F.lit(defaults.get(name, "")))).alias(name)
        for name, key in text_keys.items()
    ]
    numbers = [safe_number(_named(profiles, key)).alias(name) for name, key in number_keys.items()]
    return profiles.select("symbol", *texts, *numbers)


def metric_rows(metrics: DataFrame, keys: Mapping[str, str] = METRIC_KEYS) -> DataFrame:
    return metrics.select("symbol", *[safe_number(_named(metrics, key)).alias(name) for name, key in keys.items()])


def enrich(
    ticks: DataFrame,
    profiles: DataFrame,
    metrics: DataFrame | None = None,
    key: str = "symbol",
    unique: bool = False,
    profile_every_hours: int | None = None,
    at: str = "timestamp",
) -> DataFrame:
    """Left joins of ticks with one profile and one metrics row per symbol; without a match the columns stay null.

    No broadcast is forced: Spark broadcasts a side whose measured size is below its threshold, and otherwise joins by
    shuffle, where adaptive execution splits a hot symbol. ``profile_every_hours=2`` fills profile columns only in even
    hours, as a poller with that refresh interval would.
    """

    def one_each(side: DataFrame) -> DataFrame:
        return side if unique else keep_first(side, [key], [])

    joined = ticks.join(one_each(profiles), key, "left")
    if metrics is not None:
        joined = joined.join(one_each(metrics), key, "left")
    if profile_every_hours:
        refreshed = F.hour(F.col(at).try_cast("timestamp")) % profile_every_hours == 0
        joined = joined.withColumns(
            {name: F.when(refreshed, F.col(name)) for name in profiles.columns if name != key}
        )
    return joined


def enrich_as_of(
    ticks: DataFrame,
    versions: DataFrame,
    at: str,
    valid_from: str,
    key: str = "symbol",
    bucket_seconds: int = 86400,
    tie: Column | None = None,
) -> DataFrame:
    """Ticks with the columns of the newest version of their symbol at their time, null before the first.

    Time is cut into buckets. The version that is valid when a bucket starts is carried into it, found over one row per
    version and per bucket of a symbol; inside, the last version is carried from row to row. So a symbol with very many
    ticks is spread over its buckets, and no tick meets more than one version. Of versions of one instant the first by
    ``tie`` counts. Ticks without a symbol or a time have no version; a version without a time is none.
    """
    width = bucket_seconds * 1_000_000
    kept = [c for c in versions.columns if c not in (key, valid_from)]
    clash = [c for c in kept if c in ticks.columns]
    if clash:
        raise ValueError(f"ticks have the columns {clash} already")

    def bucket(micros: Column) -> Column:
        return ((micros - F.pmod(micros, F.lit(width))) / width).cast("bigint")

    def micros(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    facts = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    facts = keep_first(facts.withColumn("_at", micros(valid_from)), [key, "_at"], [], tie=tie_break(versions) if tie is None else tie)
    facts = facts.select(F.col(key).alias("_key"), "_at", F.struct(*kept).alias("_version"))
    placed = ticks.withColumn("_at", micros(at)).withColumn("_bucket", bucket(F.col("_at")))
    rows = placed.select(F.col(key).alias("_key"), "_at", "_bucket", F.struct(*ticks.columns).alias("_row"))
    known = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    alone = rows.filter(~known).withColumn("_version", F.lit(None).cast(facts.schema["_version"].dataType))

    starts = rows.filter(known).select("_key", "_bucket").distinct().withColumn("_at", F.col("_bucket") * width - 1)
    line = facts.withColumn("_bucket", F.lit(None).cast("bigint")).unionByName(starts, allowMissingColumns=True)
    so_far = Window.partitionBy("_key").orderBy("_at", F.col("_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    carried = line.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).filter(F.col("_bucket").isNotNull())
    inside = facts.withColumn("_bucket", bucket(F.col("_at")))
    events = carried.filter(F.col("_version").isNotNull()).unionByName(inside).unionByName(rows.filter(known), allowMissingColumns=True)
    here = Window.partitionBy("_key", "_bucket").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = events.withColumn("_version", F.last("_version", ignorenulls=True).over(here)).filter(F.col("_row").isNotNull())
    return found.unionByName(alone).select("_row.*", *[F.col("_version")[c].alias(c) for c in kept])
