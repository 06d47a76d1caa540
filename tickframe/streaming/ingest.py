"""Messages to RAW as a stream: offsets in the checkpoint, each message stored once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickframe.plans.ingest import decode, good_rows, quarantine_rows, stamp, write_batch
from tickframe.schemas import RAW_PARTITIONS
from tickframe.sources.lake import batch_ledger


def trigger_of(every: str | None) -> dict:
    """Everything that has arrived, then stop; or a run per interval such as ``15 minutes``."""
    return {"processingTime": every} if every else {"availableNow": True}


def _start(df: DataFrame, path: str, checkpoint: str, by: Sequence[str], every: str | None) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*by)
        .trigger(**trigger_of(every))
        .start()
    )


def start_ingest(
    messages: DataFrame,
    raw_path: str,
    checkpoint: str,
    every: str | None = None,
    batch_instant: Column | None = None,
    by: Sequence[str] = RAW_PARTITIONS,
) -> StreamingQuery:
    """Usable ticks to RAW. The file sink's log makes a retried batch replace itself instead of adding rows."""
    return _start(good_rows(stamp(decode(messages), batch_instant)), raw_path, checkpoint, by, every)


def start_quarantine(
    messages: DataFrame, path: str, checkpoint: str, every: str | None = None, batch_instant: Column | None = None
) -> StreamingQuery:
    """The messages ``start_ingest`` leaves out, with the reason; a query with offsets of its own."""
    return _start(quarantine_rows(stamp(decode(messages), batch_instant)), path, checkpoint, ["batch_date"], every)


def start_lake_ingest(
    messages: DataFrame, lake: str, every: str | None = None, batch_instant: Column | None = None
) -> StreamingQuery:
    """Messages to a lake, each batch in one write: usable ticks and rejected messages side by side.

    Offsets (or the names of files) are kept in the lake, so the next start goes on where this one ended. A batch that
    was cut short is run again over the same messages under the same number, and replaces its own folder.
    """

    def handle(batch: DataFrame, number: int) -> None:
        write_batch(batch, lake, number, batch_instant)

    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{lake.rstrip('/')}/_offsets")
        .trigger(**trigger_of(every))
        .start()
    )


def run_ingest_lake(messages: DataFrame, lake: str, batch_instant: Column | None = None) -> dict:
    """Everything that has arrived since the last run, then stop; returns the row counts of the new batches."""
    spark = messages.sparkSession
    ledger = batch_ledger(spark, lake)
    last = ledger.last()
    query = start_lake_ingest(messages, lake, None, batch_instant)
    query.awaitTermination()
    counts = {"raw_rows": 0, "quarantined_rows": 0}
    for number in ledger.numbers(last[0] if last else -1):
        entry = ledger.read(number)
        counts = {name: n + entry[name] for name, n in counts.items()}
    return counts
