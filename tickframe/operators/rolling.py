"""Trailing averages and counts over a number of rows or a span of time.

Two properties matter at scale. A plain window gives each symbol to one task, so symbols are cut into pieces that bring
along the rows before them; and a sliding frame re-adds its whole content for every row, so frames are computed as
differences of running totals, which is exact on decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions.totals import PARTS, each, mean_of, parts_of

# Rows of a piece of a symbol, and seconds of a bucket, the unit that pieces are put together from.
CHUNK_ROWS = 1_000_000
BUCKET_SECONDS = 3600


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join under which null keys are equal; the keys come out once."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def _narrow(df: DataFrame) -> DataFrame:
    """Bring ``_sum`` back to 36 digits: sums and differences widen a decimal, and past 38 it would lose places."""
    kind = df.schema["_sum"].dataType
    return df.withColumn("_sum", F.col("_sum").cast(f"decimal(36,{kind.scale})")) if kind.precision > 36 else df


def _trailing(df, value, window, rows, average, count, exact):
    if not exact:
        frame = window.rowsBetween(-(rows - 1), 0)
        return df.withColumns({average: F.avg(value).over(frame), count: F.count(value).over(frame)})
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    running = _narrow(df.withColumns(each(parts_of(F.col(value), exact), lambda part: F.sum(part).over(so_far))))
    held = {name: F.col(name) - F.lag(name, rows, 0).over(window) for name in PARTS}
    framed = running.withColumns(held)
    return framed.select(*df.columns, mean_of({name: F.col(name) for name in PARTS}).alias(average), F.col("_n").alias(count))


def trailing_rows_plain(
    df: DataFrame,
    value: str,
    rows: int,
    average: str,
    count: str,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("collection_time",),
    exact: str | None = None,
) -> DataFrame:
    """Average and non-null count over the row itself and the ``rows - 1`` before it, one symbol per task."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return _trailing(df, value, window, rows, average, count, exact)


def _time_bucket(df: DataFrame, column: str, seconds: int) -> Column:
    """The bucket of a time, or of a number (of width ``seconds``); other orders have one bucket. Nulls come first."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        micros = F.unix_micros(F.col(column).cast("timestamp"))
        bucket = (micros - F.pmod(micros, F.lit(seconds * _SECOND))) / (seconds * _SECOND)
    elif isinstance(kind, T.NumericType):
        bucket = F.floor(F.col(column) / seconds)
    else:
        return F.lit(0).cast("bigint")
    return F.coalesce(bucket.cast("bigint"), F.lit(-(2**63)))


def _pieces(buckets: DataFrame, keys: Sequence[str], rows: int, chunk_rows: int) -> DataFrame:
    """For each bucket its own piece (``_home``), and all pieces that need its rows (``_needed``).

    A piece is the buckets that start within one stretch of ``chunk_rows`` positions. A later piece needs a bucket that
    ends less than ``rows - 1`` positions before it starts. As a stretch is no shorter than a frame, those are at most the
    next two pieces that hold rows.
    """
    by_key = Window.partitionBy(*keys)
    forward = by_key.orderBy("_bucket")
    before = F.coalesce(F.sum("_size").over(forward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = buckets.withColumn("_start", before).withColumn("_home", F.expr(f"_start div {chunk_rows}"))
    opens = ~F.lag("_home").over(forward).eqNullSafe(F.col("_home"))
    # From the last bucket backwards, a growing frame finds the nearest piece that opens later.
    later = by_key.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    headed = placed.withColumn("_opens", F.when(opens, F.struct("_home", "_start")))
    headed = headed.withColumn("_next", F.last("_opens", ignorenulls=True).over(later))
    beyond = F.last(F.when(F.col("_opens").isNotNull(), F.col("_next")), ignorenulls=True)
    headed = headed.withColumn("_beyond", F.when(F.col("_next").isNotNull(), beyond.over(later)))
    reach = F.col("_start") + F.col("_size") + (rows - 2)
    needed = F.array(
        F.col("_home"), *[F.when(F.col(piece)["_start"] <= reach, F.col(piece)["_home"]) for piece in ("_next", "_beyond")]
    )
    return headed.select(*keys, "_bucket", "_home", F.array_compact(needed).alias("_needed"))


def trailing_rows_chunked(
    df: DataFrame,
    value: str,
    rows: int,
    average: str,
    count: str,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("collection_time",),
    exact: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """The same result with every symbol cut into pieces of about ``chunk_rows`` rows. Nothing runs while it is planned.

    Rows are counted by symbol and time bucket; running sums of these counts, a row per bucket, cut every symbol into
    pieces of whole buckets, and tell which buckets a piece needs from before it so that its first frames are full. Each
    row then goes to its own piece and to those that need it. A task holds a piece, the rows a symbol has in a bucket, and
    one frame, so buckets should be as short as a symbol is busy. Where ``order`` is not total, ties fall as they come.
    """
    if chunk_rows < rows:
        raise ValueError("a chunk must hold at least one frame")
    bucketed = df.withColumn("_bucket", _time_bucket(df, order[0], bucket_seconds))
    sizes = bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    placed = join_null_safe(bucketed, _pieces(sizes, keys, rows, chunk_rows), [*keys, "_bucket"])
    copied = placed.select(*df.columns, "_home", F.explode("_needed").alias("_piece"))
    window = Window.partitionBy(*keys, "_piece").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return _trailing(copied, value, window, rows, average, count, exact).filter("_piece = _home").drop("_home", "_piece")


def trailing_rows(
    df: DataFrame,
    value: str,
    rows: int,
    average: str,
    count: str,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("collection_time",),
    exact: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Trailing average and count of any table: one plan for symbols of all sizes."""
    return trailing_rows_chunked(df, value, rows, average, count, keys, order, exact, chunk_rows, bucket_seconds)


_SECOND = 1_000_000
_MINUTE = 60 * _SECOND
_DAY = 1440 * _MINUTE

# Type in which range frames are summed: 27 digits before the point and nine after it.
EXACT = "decimal(36,9)"


def _bucket_of(column: str, width: int) -> Column:
    # The value is never null here. Saying so keeps null filters out of the branches that share these rows, so that
    # they also share one shuffle.
    return F.coalesce(F.expr(f"{column} div {width}"), F.lit(0).cast("bigint"))


def _sums(over=None) -> dict[str, Column]:
    return {name: F.sum(name).over(over) if over is not None else F.sum(name).alias(name) for name in PARTS}


def _running_totals(steps: DataFrame, keys: Sequence[str], widths: Sequence[int]) -> DataFrame:
    """Replace the parts of the total at each ``_at`` by their running totals, rows of the same ``_at`` included.

    Totals per bucket are accumulated first, then carried into the rows of each bucket, so no task holds more than one
    bucket: a minute of instants, a day of minutes, and at the top one row per day of the key's history.
    """
    so_far = Window.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    if not widths:
        return _narrow(steps.withColumns(_sums(so_far.partitionBy(*keys))))
    width, *wider = widths
    bucketed = steps.withColumn("_bucket", _bucket_of("_at", width))
    totals = _narrow(bucketed.groupBy(*keys, F.col("_bucket").alias("_at")).agg(*_sums().values()))
    # Running totals reach to the end of a bucket; its own rows start where the bucket before it ended.
    own = totals.withColumns({f"_own{name}": F.col(name) for name in PARTS})
    ends = _running_totals(own, keys, [w // width for w in wider])
    carried = [(F.col(name) - F.col(f"_own{name}")).alias(f"_carry{name}") for name in PARTS]
    starts = ends.select(*keys, F.col("_at").alias("_bucket"), *carried)
    inside = _narrow(bucketed.withColumns(_sums(so_far.partitionBy(*keys, "_bucket"))))
    both = inside.join(starts, [*keys, "_bucket"])
    both = both.withColumns({name: F.col(name) + F.col(f"_carry{name}") for name in PARTS})
    return _narrow(both.drop("_bucket", *[f"_carry{name}" for name in PARTS]))


def trailing_range(
    df: DataFrame,
    value: str,
    seconds: int,
    average: str,
    count: str,
    keys: Sequence[str] = ("symbol",),
    at: str = "collection_time",
    exact: str = EXACT,
    widths: Sequence[int] = (_MINUTE, _DAY),
) -> DataFrame:
    """Average and non-null count over the span of ``seconds`` that ends at each row, both ends included.

    Rows of one instant share a frame, so the work is done once per symbol and instant. Each instant adds its total when
    it happens and takes it back just after it leaves the frame; a frame is then the running total at its end. The
    cost does not depend on how many rows a frame holds. Rows without a symbol or a time have no frame and get null;
    values that are no finite number show as ``totals.mean_of`` says.
    """
    stamped = df.withColumn("_at", F.unix_micros(F.col(at).cast("timestamp")))
    known = F.col("_at").isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    valued = stamped.filter(known).withColumns(parts_of(F.col(value), exact))
    instants = _narrow(valued.groupBy(*keys, "_at").agg(*_sums().values()))
    left_at = F.col("_at") + (seconds * _SECOND + 1)
    arrives = F.struct("_at", *PARTS, F.lit(True).alias("_live"))
    leaves = F.struct(left_at.alias("_at"), *[(-F.col(name)).alias(name) for name in PARTS], F.lit(False).alias("_live"))
    steps = instants.select(*keys, F.inline(F.array(arrives, leaves)))
    frames = _running_totals(steps, keys, list(widths)).filter("_live").select(
        *keys, "_at", mean_of({name: F.col(name) for name in PARTS}).alias(average), F.col("_n").alias(count)
    )
    return stamped.join(frames, [*keys, "_at"], "left").select(*df.columns, average, count)


def trailing_range_blocks(
    df: DataFrame,
    value: str,
    seconds: int,
    average: str,
    count: str,
    keys: Sequence[str] = ("symbol",),
    at: str = "collection_time",
    exact: str = EXACT,
) -> DataFrame:
    """The same frame for tables of one row per symbol and minute or less, with one shuffle.

    Time is cut into blocks as long as the frame, so a frame lies in its own block and the one before. Each row goes to
    its block, where it arrives, and as bare numbers to the next one, where it leaves. A frame's total is all that the
    block before held, plus what has arrived in the own block, less what has left. A task holds two frames' rows of a
    symbol, 20,160 for seven days of minutes; tables of any number of rows per instant take ``trailing_range``.
    """
    length = seconds * _SECOND + 1
    stamped = df.withColumn("_at", F.unix_micros(F.col(at).cast("timestamp")))
    known = F.col("_at").isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    # Rows without a frame are spread, as they need no company.
    block = F.when(known, F.expr(f"(_at - pmod(_at, {length})) div {length}")).otherwise(F.pmod(F.xxhash64(*df.columns), F.lit(4096)))
    signed = stamped.withColumns({**parts_of(F.col(value), exact), "_block": block, "_known": known})
    own = F.struct("_block", "_at", *PARTS, F.lit(True).alias("_live"), *df.columns)
    bare = [(F.col(c) if c in keys else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in df.columns]
    next_block = F.struct(
        (F.col("_block") + 1).alias("_block"),
        (F.col("_at") + length).alias("_at"),
        *[(-F.col(name)).cast(signed.schema[name].dataType).alias(name) for name in PARTS],
        F.lit(False).alias("_live"),
        *bare,
    )
    copies = F.when(F.col("_known"), F.array(own, next_block)).otherwise(F.array(own))
    steps = signed.select("_known", F.inline(copies))
    together = Window.partitionBy(*keys, "_block").orderBy("_at")
    so_far = together.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = together.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scale = signed.schema["_sum"].dataType.scale
    kind = {name: f"decimal(36,{scale})" if name == "_sum" else "bigint" for name in PARTS}
    before = {f"_before{name}": F.sum(F.when(~F.col("_live"), -F.col(name))).over(whole) for name in PARTS}
    moved = steps.withColumns({**before, **{f"_here{name}": F.sum(name).over(so_far) for name in PARTS}}).filter("_live")
    total = {
        name: F.col(f"_here{name}").cast(kind[name]) + F.coalesce(F.col(f"_before{name}").cast(kind[name]), F.lit(0).cast(kind[name]))
        for name in PARTS
    }
    return moved.select(
        *df.columns,
        F.when(F.col("_known"), mean_of(total)).alias(average),
        F.when(F.col("_known"), total["_n"]).alias(count),
    )


def moving_average(
    df: DataFrame,
    value: str,
    rows: int,
    name: str,
    keys: Sequence[str] = ("symbol",),
    order: str = "trade_date",
) -> DataFrame:
    """Trailing average over rows that are already one per symbol and day; a symbol has few of them."""
    frame = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first()).rowsBetween(-(rows - 1), 0)
    return df.withColumn(name, F.avg(value).over(frame))
