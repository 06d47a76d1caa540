"""RAW and quarantine as one table of batches: ``batch=N/outcome=raw|quarantine/batch_date=/batch_hour=``.

A batch's folder belongs to it alone, so a batch that is run again replaces what its first run left. Its entry in the
ledger is written last; folders without one are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.schemas import RAW_SCHEMA
from tickframe.sources.ledger import Ledger
from tickframe.sources.tables import empty_table

OUTCOMES = ("raw", "quarantine")
LAKE_SCHEMA = T.StructType(
    [
        *RAW_SCHEMA.fields,
        T.StructField("value", T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("batch", T.LongType(), True),
        T.StructField("outcome", T.StringType(), True),
    ]
)


def batch_ledger(spark: SparkSession, lake: str) -> Ledger:
    return Ledger(spark, f"{lake.rstrip('/')}/_batches")


def lake_batches(spark: SparkSession, lake: str, after: int = -1) -> list[int]:
    """Numbers of the committed batches after a bookmark, in order."""
    return batch_ledger(spark, lake).numbers(after)


def read_batches(
    spark: SparkSession, lake: str, batches: Sequence[int] | None = None, outcome: str = "raw"
) -> DataFrame:
    """Rows of the given batches, or of all committed ones. Only their folders are listed."""
    if outcome not in OUTCOMES:
        raise ValueError(f"outcome must be one of {OUTCOMES}, not {outcome!r}")
    base = lake.rstrip("/")
    batches = lake_batches(spark, lake) if batches is None else list(batches)
    columns = RAW_SCHEMA.fieldNames() if outcome == "raw" else ["value", "reason", "batch_timestamp", "batch_date"]
    if not batches:
        return empty_table(spark, LAKE_SCHEMA).select(*columns)
    reader = spark.read.schema(LAKE_SCHEMA).option("basePath", base)
    rows = reader.parquet(*[f"{base}/batch={n}" for n in batches])
    return rows.filter(F.col("outcome") == outcome).select(*columns)
