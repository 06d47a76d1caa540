"""Newest row per symbol and minute on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickframe.streaming.ingest import trigger_of


def latest_per_minute_stream(
    ticks: DataFrame,
    at: str = "processed_timestamp",
    key: str = "symbol",
    recency: Sequence[str] = ("batch_timestamp", "processed_timestamp"),
    delay: str = "10 minutes",
) -> DataFrame:
    """One row per symbol and minute once the watermark has passed the minute.

    The state of a group is its current winner, so it does not grow with the number of ticks. Dropping duplicates
    within the watermark would keep the first arrival instead of the newest row.
    """
    columns = [c for c in ticks.columns if c not in (key, at)]
    order = F.struct(*recency, F.xxhash64(*ticks.columns).alias("_tie"))
    winner = F.max_by(F.struct(F.col(at), *columns), order).alias("_row")
    return (
        ticks.withWatermark(at, delay)
        .groupBy(F.window(at, "1 minute").alias("_minute"), key)
        .agg(winner)
        .select(key, F.col("_minute.start").alias("minute_start"), "_row.*")
    )


def start_latest(latest: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return (
        latest.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger_of(every))
        .start()
    )
