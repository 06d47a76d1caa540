"""Mixing sources to target weights by hash thresholds.

Sizes are summed by source and hash bucket. The running sum over a source's buckets finds the one in which its budget
ends; only rows of such boundary buckets are summed again, by the next bits of the hash, until the boundary holds one
hash value. Whoever lies below the threshold is taken: no sort of the documents, and a smaller budget takes a subset of
what a larger one takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import WORD, own_name, text_of
from tickframe.session import cut_lineage, small_side

BITS, LEVEL_BITS = 60, 12


def row_hash(doc_id: Column, text: Column) -> Column:
    """A number of 60 bits by which a document is drawn; documents equal in both columns share it."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0) -> DataFrame:
    """Target per source: ``share`` of all sizes divided by weight, none above ``cap`` times its source's own size.

    ``sizes`` has ``source`` (null allowed) and ``size``. Sources in the order of their code points, null last, take the
    weights in turn. What a cap leaves over is divided again among the others by weight. Columns: source, source_size,
    target. The table of sources is numbered and summed by Spark, so it may be long.
    """
    spark = sizes.sparkSession
    grouped = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    ordered = grouped.orderBy(F.col("source").asc_nulls_last())
    numbered = ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    table = cut_lineage(
        spark.createDataFrame(numbered, "source string, source_size bigint, place bigint").withColumn(
            "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("bigint")
        )
    )
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("double")).first()[0] * share
    capped_size, free_weight, level = F.col("source_size") * cap, F.col("weight"), None
    while True:
        # The level is what one unit of weight gets. Sources whose cap lies below it stop there, which raises the level.
        stops = F.lit(False) if level is None else capped_size < free_weight * F.lit(level)
        capped, free = table.agg(F.sum(F.when(stops, capped_size)), F.sum(F.when(~stops, free_weight))).first()
        new = (total - (capped or 0)) / free if free else None
        if new is None or new == level:
            break
        level = new
    full = (F.col("source_size") * cap).cast("double")
    return table.select("source", "source_size", F.least(full, free_weight * F.lit(level or 0.0)).alias("target"))


def find_thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``threshold`` by source: taking the hashes below it comes nearest to the source's budget.

    ``rows`` has source, h (60 bits) and size; ``budgets`` has source and budget. Every level sums the next twelve bits
    inside the boundary only, and a source is finished when its boundary bucket holds a single hash value.
    """
    state = budgets.select(F.col("source").alias("of"), F.col("budget").alias("left"), F.lit(0).cast("bigint").alias("start"))
    finished = []
    for shift in range(BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        here = small_side(state)
        inside = rows.join(
            here, rows["source"].eqNullSafe(here["of"]) & (F.shiftright("h", shift + LEVEL_BITS) == F.shiftright("start", shift + LEVEL_BITS))
        )
        buckets = inside.groupBy("of", "left", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").cast("bigint").alias("size"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        upto = F.sum("size").over(Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        fits = F.col("upto") <= F.col("left")
        ends = (
            buckets.withColumn("upto", upto)
            .groupBy("of", "left")
            .agg(F.max(F.when(fits, F.col("upto"))).alias("used"), F.min(F.when(~fits, F.struct("bucket", "low", "high", "size"))).alias("edge"))
            .withColumn("left", F.col("left") - F.coalesce("used", F.lit(0)))
        )
        nearer = F.when(F.col("left") * 2 >= F.col("edge.size"), 1).otherwise(0)
        found = cut_lineage(
            ends.select(
                "of",
                "left",
                F.shiftleft("edge.bucket", shift).alias("start"),
                F.when(F.col("edge").isNull(), F.lit(1 << BITS))
                .when(F.col("edge.low") == F.col("edge.high"), F.col("edge.low") + nearer)
                .alias("threshold"),
            )
        )
        finished.append(found.where("threshold IS NOT NULL").select(F.col("of").alias("source"), "threshold"))
        state = found.where("threshold IS NULL").drop("threshold")
        if not state.limit(1).count():
            break
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0, text: str = "text", source: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """All columns of ``docs`` and ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    The size is the number of words of the text, 0 where it is null. A document is taken ``mix_copies`` times: once for
    every whole multiple of its source in the target, and once more if its hash lies below the source's threshold. What a
    source gives differs from its target by at most half the size at one hash value; rows equal in id and text share
    a hash and stand or fall together. A null source is a source of its own. An empty table gives an empty result.
    """
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint")
    keyed = docs.select(F.col(f"`{source}`").alias("source"), row_hash(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("h"), size.alias("size"))
    rows = cut_lineage(keyed)
    targets = cut_lineage(source_targets(rows, weights, cap, share))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    budgets = targets.withColumn("whole", whole).withColumn("budget", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint"))
    found = find_thresholds(rows, budgets).toDF("found_source", "threshold")
    plan = budgets.join(found, F.col("source").eqNullSafe(F.col("found_source")), "left").select(
        F.col("source").alias("mixed_source"), "source_size", "target", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold")
    )
    h, s = own_name(docs, "mix_hash"), own_name(docs, "mix_words")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("mix_size", "mix_source_size", "mix_target", "mix_copies")]
    sized = docs.select(*kept, row_hash(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias(h), size.alias(s))
    own = [own_name(docs, f"mixed_{c}") for c in plan.columns]
    of, source_size, target, copies, threshold = (F.col(c) for c in own)
    return sized.join(small_side(plan.toDF(*own)), F.col(f"`{source}`").eqNullSafe(of)).select(
        *kept,
        F.col(s).alias("mix_size"),
        source_size.alias("mix_source_size"),
        target.alias("mix_target"),
        (copies + F.when(F.col(h) < threshold, 1).otherwise(0)).cast("bigint").alias("mix_copies"),
    )


def repeat_taken(mixed: DataFrame) -> DataFrame:
    """The documents as the mix takes them, without the four columns of ``mix_sources``: left out at zero copies or none
    known, repeated at two or three. An empty table gives an empty one."""
    columns = [F.col(f"`{c}`") for c in mixed.columns if c not in ("mix_size", "mix_source_size", "mix_target", "mix_copies")]
    taken = mixed.where(F.col("mix_copies") > 0)
    copy = own_name(mixed, "mix_copy")
    return taken.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("mix_copies"))).alias(copy)).drop(copy)
