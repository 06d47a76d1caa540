"""RAW to ANALYZED as a stream of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickframe.functions.times import time_parts
from tickframe.plans.analyze import append_minutes
from tickframe.streaming.ingest import trigger_of


def append_batch(raw: DataFrame, analyzed_path: str, **options) -> int:
    """Add one micro-batch to ANALYZED. Minutes already there are skipped, so running a batch again adds nothing."""
    return append_minutes(time_parts(raw), analyzed_path, **options)


def start_analyze(
    raw_stream: DataFrame, analyzed_path: str, checkpoint: str, every: str | None = None, **options
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, analyzed_path, **options)

    return (
        raw_stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(every))
        .start()
    )
