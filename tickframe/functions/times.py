"""Event time, time parts, ingest stamps and session calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"


def event_time(text: Column) -> Column:
    """ISO text to a timestamp; unreadable text is null (``to_timestamp`` would fail the job)."""
    return F.try_to_timestamp(text)


def iso_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds to ISO text without a fraction."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss")


def ingest_stamps(df: DataFrame, batch_instant: Column | None = None, text: str = "timestamp") -> DataFrame:
    """Add the ingest instant, its date and hour, and the parsed event time.

    ``current_timestamp`` is one value per query; pass ``batch_instant`` to make a run repeatable.
    """
    now = F.current_timestamp() if batch_instant is None else batch_instant
    return df.withColumns(
        {
            "batch_timestamp": now,
            "batch_date": F.date_format(now, "yyyy-MM-dd"),
            "batch_hour": F.hour(now),
            "processed_timestamp": event_time(F.col(text)),
        }
    )


def time_parts(df: DataFrame, moment: str = "processed_timestamp") -> DataFrame:
    at = F.col(moment)
    return df.withColumns(
        {
            "trade_date": F.to_date(at),
            "collection_time": at,
            "collection_hour": F.hour(at),
            "collection_minute": F.minute(at),
        }
    )


def minute_key_text(symbol: Column, date: Column, hour: Column, minute: Column) -> Column:
    """``symbol_date_hour_minute``; null when any part is, so a missing part cannot match another key."""
    return F.concat(
        symbol, F.lit("_"), date.cast("string"), F.lit("_"), hour.cast("string"), F.lit("_"), minute.cast("string")
    )


SEOUL = "Asia/Seoul"


def in_collection_hours(moment: Column, zone: str | None = None) -> Column:
    """Weekday (Monday is 0) before Saturday, and the hour 23 or 0 to 6.

    Without a zone the moment's own hours count. With one, a UTC instant is put into that zone first, and the hours
    after midnight belong to the day before, so that the night from Friday to Saturday is open and the one from Sunday
    to Monday is not.
    """
    local = moment if zone is None else F.from_utc_timestamp(moment, zone)
    day = local if zone is None else local - F.expr("INTERVAL 7 HOURS")
    hour = F.hour(local)
    return (F.weekday(day) < 5) & ((hour >= 23) | (hour <= 6))


def collection_open(spark: SparkSession, now: Column | None = None, zone: str | None = None) -> bool:
    """Whether a scheduled run at this UTC instant should do its work; the hours are those of ``zone``, if given."""
    moment = F.current_timestamp() if now is None else now
    return bool(spark.range(1).select(in_collection_hours(moment, zone)).first()[0])


def in_market_session(
    moment: Column, zone: str = NEW_YORK, opens: tuple[int, int] = (9, 30), closes: tuple[int, int] = (16, 0)
) -> Column:
    """Whether a UTC instant falls into the exchange's session, in the exchange's own zone."""
    local = F.from_utc_timestamp(moment, zone)
    minute_of_day = F.hour(local) * 60 + F.minute(local)
    return (
        (F.weekday(local) < 5)
        & (minute_of_day >= opens[0] * 60 + opens[1])
        & (minute_of_day < closes[0] * 60 + closes[1])
    )
