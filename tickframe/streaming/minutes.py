"""Newest row per symbol and minute on a stream, with what came too late on the side.

Each batch is one step: its ticks meet the open minutes of the step before, and one write puts down the minutes that the
watermark has closed, those still open, and the late ticks. Nothing is dropped: the ticks counted in minutes and the late
ones add up to the input. Steps are committed by a ledger entry, so a batch that is run again replaces its own folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickframe.sources.ledger import Ledger
from tickframe.streaming.ingest import trigger_of

OUTCOMES = ("closed", "open", "late")
_MINUTE = 60_000_000


class MinuteSteps:
    """The steps of one stream under ``path``: ``step=N/outcome=closed|open|late``.

    A minute is closed once the newest tick lies ``delay_seconds`` or more behind its end. A tick of a closed minute is
    late, however new its batch. ``recency`` orders the ticks of a minute; a hash of the row breaks ties.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        at: str = "processed_timestamp",
        key: str = "symbol",
        recency: Sequence[str] = ("batch_timestamp", "processed_timestamp"),
        delay_seconds: int = 600,
    ):
        self.spark, self.path, self.at, self.key, self.recency = spark, path.rstrip("/"), at, key, tuple(recency)
        self.delay = delay_seconds * 1_000_000
        self.columns = schema.fieldNames()
        own = [T.StructField("minute_start", T.TimestampType()), T.StructField("n_ticks", T.LongType())]
        parts = [T.StructField("outcome", T.StringType()), T.StructField("step", T.LongType())]
        self.schema = T.StructType([*schema.fields, *own, *parts])
        self.ledger = Ledger(spark, f"{self.path}/_steps")

    def read(self, outcome: str, steps: Sequence[int] | None = None) -> DataFrame:
        """Rows of an outcome: closed minutes and late ticks of all steps, or of the given ones; open ones of the last."""
        if outcome not in OUTCOMES:
            raise ValueError(f"outcome must be one of {OUTCOMES}, not {outcome!r}")
        known = self.ledger.numbers()
        steps = (known[-1:] if outcome == "open" else known) if steps is None else list(steps)
        if not steps:
            return self.spark.createDataFrame([], self.schema).drop("outcome", "step")
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        rows = reader.parquet(*[f"{self.path}/step={n}" for n in steps])
        return rows.filter(F.col("outcome") == outcome).drop("outcome", "step")

    def _last(self) -> tuple[int, dict]:
        return self.ledger.last() or (-1, {"batch": -1, "watermark": None})

    def add(self, batch: DataFrame, number: int) -> dict:
        """One batch of the stream; one that has been committed already is left alone."""
        step, before = self._last()
        if before["batch"] >= number:
            return before
        newest = batch.agg(F.max(F.unix_micros(self.at))).first()[0]
        marks = [m for m in (before["watermark"], None if newest is None else newest - self.delay) if m is not None]
        return self._step(step + 1, batch, number, before["watermark"], max(marks, default=None))

    def close(self, until: dt.datetime) -> dict:
        """Move the watermark on to an instant (naive ones are UTC) without new ticks, as at the end of a day."""
        step, before = self._last()
        instant = until if until.tzinfo else until.replace(tzinfo=dt.timezone.utc)
        micros = (instant - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        mark = micros if before["watermark"] is None else max(micros, before["watermark"])
        none = self.spark.createDataFrame([], T.StructType(self.schema.fields[: len(self.columns)]))
        return self._step(step + 1, none, before["batch"], before["watermark"], mark)

    def _step(self, step: int, batch: DataFrame, number: int, before: int | None, after: int | None) -> dict:
        start = F.date_trunc("minute", self.at)
        ticks = batch.select(*self.columns, start.alias("minute_start"), F.lit(1).cast("bigint").alias("n_ticks"))
        late = self._closed_by(before)
        # Without a time or a symbol a tick belongs to no minute, so it goes aside at once.
        aside = F.coalesce(late, F.lit(True)) | F.col(self.key).isNull()
        timely = ticks.filter(~aside).unionByName(self.read("open"))
        order = F.struct(*self.recency, F.xxhash64(*self.columns).alias("_tie"))
        winners = timely.groupBy(self.key, "minute_start").agg(
            F.max_by(F.struct(*[c for c in self.columns if c != self.key]), order).alias("_row"),
            F.sum("n_ticks").alias("n_ticks"),
        )
        minutes = winners.select(self.key, "_row.*", "minute_start", "n_ticks").select(*self.columns, "minute_start", "n_ticks")
        outcome = F.when(self._closed_by(after), "closed").otherwise("open")
        rows = minutes.withColumn("outcome", outcome).unionByName(ticks.filter(aside).withColumn("outcome", F.lit("late")))
        rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{self.path}/step={step}")
        entry = {"batch": number, "watermark": after}
        self.ledger.commit(step, entry)
        return entry

    def _closed_by(self, watermark: int | None) -> Column:
        """Whether a minute has ended by the watermark; null without a time."""
        if watermark is None:
            return F.when(F.col("minute_start").isNotNull(), F.lit(False))
        return F.unix_micros("minute_start") + _MINUTE <= F.lit(watermark)


def start_minutes(ticks: DataFrame, steps: MinuteSteps, every: str | None = None) -> StreamingQuery:
    """Run the steps over a stream; offsets are kept beside them."""

    def handle(batch: DataFrame, number: int) -> None:
        steps.add(batch, number)

    return (
        ticks.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{steps.path}/_offsets")
        .trigger(**trigger_of(every))
        .start()
    )
