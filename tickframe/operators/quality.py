"""Quality, availability, profile and freshness of a table, each as a small DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions.digests import row_digest


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the type has one; asking ``isnan`` of a date or text column is an error."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """Number of missing values per column, in one row and one pass."""
    return df.agg(
        *[F.coalesce(F.sum(is_missing(df, c).cast("bigint")), F.lit(0)).alias(c) for c in df.columns]
    )


def _mask(flags: Sequence[Column]) -> Column:
    """Flags as the bits of one number; a null flag is not set."""
    bits = [F.when(flag, F.lit(1 << place).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for place, flag in enumerate(flags)]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), bits)


def quality_report(
    df: DataFrame,
    price: str | None = "current_price",
    keys: Sequence[str] | None = None,
    max_duplicates: float = 0.05,
    max_nulls: float | None = 0.10,
    max_column_nulls: float | Mapping[str, float] | None = None,
) -> DataFrame:
    """One row: totals, duplicates, prices at or below zero, missing values per column, and the verdict.

    Copies of a row are counted together first, inside each input task, so a group of copies that makes up much of the
    table shuffles as one row; and rows are known by a digest, so 32 bytes and a few flags move, however wide they are. A
    price column that is not there is an error. With ``keys``, rows that share a key count as duplicates even when ingest
    stamps differ. ``max_nulls`` compares all missing values with the number of rows, None leaves them unchecked;
    ``max_column_nulls`` limits the share of missing values, for every column or by name for some.
    """
    missing = {c: is_missing(df, c) for c in df.columns}
    if not df.columns:
        raise ValueError("a table without columns has no quality")
    if price is not None and price not in df.columns:
        raise ValueError(f"no price column {price}; pass price=None to leave prices unchecked")
    invalid = F.lit(False) if price is None else F.col(price) <= 0
    # One bit for each column with a missing value, and one for an invalid price.
    flags = [invalid, *missing.values()]
    masks = {f"_flags{i}": _mask(flags[at : at + 63]) for i, at in enumerate(range(0, len(flags), 63))}
    bit = {name: (f"_flags{at // 63}", at % 63) for at, name in enumerate(["_invalid", *(f"_null_{c}" for c in missing)])}
    marked = df.select(*[F.col(f"`{k}`") for k in keys or ()], *([] if keys else [row_digest(df).alias("_row")]), *[m.alias(n) for n, m in masks.items()])

    def holds(name: str) -> Column:
        mask, place = bit[name]
        return F.shiftright(F.col(mask), place).bitwiseAND(F.lit(1).cast("bigint"))

    if keys is None:
        # Flags follow from the row, so they split no group.
        counted = marked.groupBy("_row", *masks).agg(F.count(F.lit(1)).alias("_rows"))
        sums = [F.sum("_rows").alias("_rows"), *[F.sum(holds(n) * F.col("_rows")).alias(n) for n in bit]]
    else:
        counted = marked.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(holds(n)).alias(n) for n in bit])
        sums = [F.sum(n).alias(n) for n in ("_rows", *bit)]
    first = counted.agg(F.count(F.lit(1)).alias("_groups"), *sums)

    def whole(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`"), F.lit(0)).cast("bigint")

    report = first.select(
        whole("_rows").alias("total"),
        (whole("_rows") - F.col("_groups")).alias("duplicates"),
        whole("_invalid").alias("invalid_prices"),
        *[whole(f"_null_{c}").alias(f"nulls_{c}") for c in df.columns],
    )
    null_columns = {c: F.col(f"`nulls_{c}`") for c in df.columns}
    verdict = (
        (F.col("total") > 0)
        & (F.col("duplicates") < F.col("total") * max_duplicates)
        & (F.col("invalid_prices") == 0)
    )
    if max_nulls is not None:
        verdict = verdict & (sum(null_columns.values(), F.lit(0)) < F.col("total") * max_nulls)
    limits = max_column_nulls if isinstance(max_column_nulls, Mapping) else dict.fromkeys(df.columns, max_column_nulls)
    for name, limit in limits.items():
        # Limits by name may serve several tables; a column that one lacks has no missing values there.
        if limit is not None and name in null_columns:
            verdict = verdict & (null_columns[name] < F.col("total") * limit if limit else null_columns[name] == 0)
    return report.withColumn("passed", verdict)


def column_availability(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: whether each column exists and has any value."""
    wanted = list(columns or df.columns)
    present = [c for c in wanted if c in df.columns]
    found = df.agg(*[(F.count(F.when(~is_missing(df, c), 1)) > 0).alias(c) for c in present], F.lit(1).alias("_one"))
    return found.select(*[F.col(f"`{c}`") if c in present else F.lit(False).alias(c) for c in wanted])


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows and non-null values, from a single pass over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{c}") for c in df.columns])
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col("_rows").alias("row_count"),
            F.col(f"`_{field.name}`").alias("non_null"),
        )
        for i, field in enumerate(df.schema.fields, 1)
    ]
    return counts.select(F.inline(F.array(*lines)))


def columns_like(df: DataFrame, words: Sequence[str] = ("time", "hour", "minute", "date")) -> list[str]:
    """Columns whose name contains one of ``words``, whatever its case."""
    return [c for c in df.columns if any(word in c.lower() for word in words)]


def time_columns(df: DataFrame, also: Sequence[str] = ("symbol",)) -> DataFrame:
    named = columns_like(df)
    return df.select(*named, *[c for c in also if c in df.columns and c not in named])


def newest_rows(df: DataFrame, n: int = 5, at: str = "collection_time", tie: Column | None = None) -> DataFrame:
    order = [F.col(at).desc_nulls_last()]
    return df.orderBy(*order, F.xxhash64(*df.columns) if tie is None else tie).limit(n)


def freshness(
    df: DataFrame,
    dataset: str,
    at: str,
    now: Column | None = None,
    max_lag_seconds: int = 3 * 3600,
    partition: str | None = None,
) -> DataFrame:
    """One row per dataset: its newest instant, how far that lies back, and whether it is fresh enough.

    With the date partition the table is stored by, the time column is read in the newest partition only.
    """
    if partition:
        df = df.filter(F.col(partition) == F.lit(df.agg(F.max(partition)).first()[0]))
    instant = F.current_timestamp() if now is None else now
    lag = F.unix_timestamp(instant) - F.unix_timestamp(F.col("latest"))
    return (
        df.agg(F.max(at).alias("latest"))
        .withColumns(
            {
                "dataset": F.lit(dataset),
                "has_data": F.col("latest").isNotNull(),
                "lag_seconds": lag,
            }
        )
        .withColumn("fresh", F.coalesce(F.col("lag_seconds") <= max_lag_seconds, F.lit(False)))
        .select("dataset", "has_data", "latest", "lag_seconds", "fresh")
    )
