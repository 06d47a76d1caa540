"""Polled documents to tick messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickframe.operators.enrich import enrich, metric_rows, profile_rows, quote_quarantine, quote_rows
from tickframe.operators.indicators import derive_indicators
from tickframe.operators.universe import restrict
from tickframe.sources.sinks import encode_messages, write_messages

# Fixed value: hours between two refreshes of the company profiles.
PROFILE_HOURS = 2


def collect_ticks(
    quotes: DataFrame,
    profiles: DataFrame,
    metrics: DataFrame,
    universe: DataFrame | None = None,
    profile_every_hours: int | None = PROFILE_HOURS,
    **mappings,
) -> DataFrame:
    """Quotes of the followed symbols with their profile, metrics and indicators; empty and unusable quotes are left out.

    ``mappings`` may name other document keys: ``quote_keys``, ``profile_text_keys``, ``profile_number_keys``,
    ``metric_keys``.
    """
    followed = quotes if universe is None else restrict(quotes, universe)
    ticks = quote_rows(followed, **_chosen(mappings, keys="quote_keys"))
    facts = profile_rows(profiles, **_chosen(mappings, text_keys="profile_text_keys", number_keys="profile_number_keys"))
    ratios = metric_rows(metrics, **_chosen(mappings, keys="metric_keys"))
    return derive_indicators(enrich(ticks, facts, ratios, profile_every_hours=profile_every_hours))


def _chosen(mappings: dict, **names: str) -> dict:
    return {argument: mappings[name] for argument, name in names.items() if name in mappings}


def run_collect(
    quotes: DataFrame,
    profiles: DataFrame,
    metrics: DataFrame,
    format: str = "kafka",
    path: str | None = None,
    universe: DataFrame | None = None,
    options: dict | None = None,
    quarantine: str | None = None,
    **choices,
) -> int:
    """Send the collected ticks as messages; quotes that cannot be used go to ``quarantine``. Returns their number."""
    messages = encode_messages(collect_ticks(quotes, profiles, metrics, universe, **choices))
    write_messages(messages, format, path, **(options or {}))
    if quarantine is None:
        return 0
    rejected = Observation()
    followed = quotes if universe is None else restrict(quotes, universe)
    rows = quote_quarantine(followed, **_chosen(choices, keys="quote_keys"))
    rows.observe(rejected, F.count(F.lit(1)).alias("rows")).write.mode("append").json(quarantine)
    return int(rejected.get["rows"])
