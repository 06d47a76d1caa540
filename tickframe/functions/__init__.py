from tickframe.functions.numbers import (
    billions_usd,
    exact_avg,
    grouped_text,
    half_even,
    is_positive,
    pe_band,
    percent,
    quote_number,
    safe_number,
    signed_percent_text,
    to_krw,
    trillions_krw,
    two_decimals_text,
)
from tickframe.functions.times import (
    NEW_YORK,
    collection_open,
    epoch_text,
    event_time,
    ingest_stamps,
    in_collection_hours,
    in_market_session,
    iso_text,
    minute_key_text,
    time_parts,
)

__all__ = [name for name in dir() if not name.startswith("_")]
