"""Messages to the RAW table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions.times import ingest_stamps
from tickframe.schemas import RAW_PARTITIONS, RAW_SCHEMA, TICK_SCHEMA
from tickframe.sources.lake import OUTCOMES, batch_ledger
from tickframe.sources.sinks import write_partitioned

_CORRUPT = "_corrupt"


def decode(messages: DataFrame, schema: T.StructType = TICK_SCHEMA) -> DataFrame:
    """JSON text of ``value`` as columns, with ``_text`` and ``_reason`` (null for a usable tick).

    A field of the wrong type is null and the rest of its record is kept. Records without a symbol or without a
    readable time can be neither keyed nor ordered, so they get a reason and belong into quarantine.
    """
    parsed = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType(), True)])
    texts = messages.select(F.col("value").cast("string").alias("_text"))
    record = F.from_json("_text", parsed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # A struct taken apart with ``.*`` would be parsed again for every column and filter that uses it; a generator's
    # output is computed once.
    rows = texts.select("_text", F.inline(F.array(record)))
    reason = (
        F.when(F.col("_text").isNull(), "no_value")
        .when(F.col(_CORRUPT).isNotNull() & F.col("symbol").isNull(), "malformed")
        .when(F.col("symbol").isNull(), "no_symbol")
    )
    return rows.withColumn("_reason", reason).drop(_CORRUPT)


def stamp(decoded: DataFrame, batch_instant: Column | None = None) -> DataFrame:
    stamped = ingest_stamps(decoded, batch_instant)
    no_time = F.when(F.col("processed_timestamp").isNull(), "no_time")
    return stamped.withColumn("_reason", F.coalesce(F.col("_reason"), no_time))


def good_rows(stamped: DataFrame) -> DataFrame:
    return stamped.filter(F.col("_reason").isNull()).select(*RAW_SCHEMA.fieldNames())


def quarantine_rows(stamped: DataFrame) -> DataFrame:
    return stamped.filter(F.col("_reason").isNotNull()).select(
        F.col("_text").alias("value"), F.col("_reason").alias("reason"), "batch_timestamp", "batch_date"
    )


def write_batch(messages: DataFrame, lake: str, number: int, batch_instant: Column | None = None) -> dict:
    """One batch of messages as one write into its folder of the lake; returns both row counts.

    Messages are read and parsed once. Usable ticks and rejected messages are told apart by a partition, so neither has
    to be kept for a second write. A batch that has its entry already is left alone: its messages are the same.
    """
    spark = messages.sparkSession
    ledger = batch_ledger(spark, lake)
    if number in ledger.numbers(number - 1):
        return ledger.read(number)
    good = F.col("_reason").isNull()
    stamped = stamp(decode(messages), batch_instant)
    outcome = F.when(good, OUTCOMES[0]).otherwise(OUTCOMES[1]).alias("outcome")
    rows = stamped.select(
        *RAW_SCHEMA.fieldNames(), F.when(~good, F.col("_text")).alias("value"), F.col("_reason").alias("reason"), outcome
    )
    counted = Observation()
    by = ["outcome", *RAW_PARTITIONS]
    laid_out = (
        rows.hint("rebalance", *by)
        .sortWithinPartitions(*by, "symbol", "processed_timestamp")
        .observe(
            counted,
            F.count_if(F.col("reason").isNull()).alias("raw_rows"),
            F.count_if(F.col("reason").isNotNull()).alias("quarantined_rows"),
        )
    )
    laid_out.write.mode("overwrite").partitionBy(*by).parquet(f"{lake.rstrip('/')}/batch={number}")
    entry = {name: int(n) for name, n in counted.get.items()}
    ledger.commit(number, entry)
    return entry


def run_ingest(
    messages: DataFrame,
    raw_path: str,
    quarantine_path: str,
    batch_instant: Column | None = None,
    by: Sequence[str] = RAW_PARTITIONS,
    max_records: int | None = None,
) -> dict:
    """Append usable ticks to RAW and the others to quarantine; returns both row counts.

    The decoded rows feed two writes. They are kept so that both see the same messages even if the topic grows in
    between; a lost block is read again from the same offsets.
    """
    stamped = stamp(decode(messages), batch_instant).persist()
    try:
        kept = write_partitioned(
            good_rows(stamped), raw_path, by, sort=["symbol", "processed_timestamp"], max_records=max_records
        )
        rejected = write_partitioned(quarantine_rows(stamped), quarantine_path, ["batch_date"])
    finally:
        stamped.unpersist()
    return {"raw_rows": kept, "quarantined_rows": rejected}
