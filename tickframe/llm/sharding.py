"""Sharding by bytes with groups that stay together: differencing of partial partitions.

Groups of equal texts are summed by a digest. Groups above a fraction of all bytes, of which there can only be a bounded
number, are items of their own; the others fall by hash into a fixed number of bags, which are the remaining items. The
items, some thousands at any size of the input, are divided by Karmarkar-Karp differencing: every item starts as a
partial partition with one used shard, and the two partial partitions of the largest spread are combined again and
again, the fullest shard of one with the emptiest of the other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import own_name, text_of
from tickframe.session import cut_lineage

BAGS_PER_SHARD = 256
CHUNK_ROWS = 20_000


def difference_items(sizes: list[int], shards: int) -> list[int]:
    """Shard of every item, by combining the partial partitions of the largest spread in opposite order."""
    if not sizes:
        return []
    # A partial partition: sums per shard in falling order, and for each shard the node of a tree of combined shards.
    nodes: list[tuple[int, int]] = []  # children of a node; items are ~index, -0 children are None
    heap = []
    for i, size in sorted(enumerate(sizes), key=lambda x: (-x[1], x[0])):
        sums = [size] + [0] * (shards - 1)
        heap.append((-size, i, sums, [~i] + [None] * (shards - 1)))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, sums_a, parts_a = heapq.heappop(heap)
        _, _, sums_b, parts_b = heapq.heappop(heap)
        combined = []
        for x, y, p, q in zip(sums_a, reversed(sums_b), parts_a, reversed(parts_b)):
            if p is not None and q is not None:
                nodes.append((p, q))
                part = len(nodes) - 1
            else:
                part = p if p is not None else q
            combined.append((x + y, part))
        combined.sort(key=lambda c: -c[0])
        low = combined[-1][0]
        order += 1
        # Only differences matter for the order of combining; the sums stay small.
        heapq.heappush(heap, (low - combined[0][0], order, [c[0] - low for c in combined], [c[1] for c in combined]))
    shard_of = [0] * len(sizes)
    for shard, part in enumerate(heap[0][3]):
        stack = [] if part is None else [part]
        while stack:
            node = stack.pop()
            if node < 0:
                shard_of[~node] = shard
            else:
                stack.extend(nodes[node])
    return shard_of


def balance(items: DataFrame, shards: int) -> DataFrame:
    """``items`` (item string, size) with ``shard``. The number of items must be bounded: they are divided in one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if frames:
            table = pd.concat(frames).sort_values("item", kind="stable").reset_index(drop=True)
            yield pd.DataFrame({"item": table["item"], "shard": difference_items(table["size"].tolist(), shards)})

    # One task for the bounded number of items alone; their sums are made in many.
    return items.repartition(1).mapInPandas(run, "item string, shard int")


def group_of(text: Column) -> Column:
    return F.md5(text)


def assign_shards(docs: DataFrame, shards: int = 24, overhead: int = 8, text: str = "text", bags_per_shard: int = BAGS_PER_SHARD) -> DataFrame:
    """All columns of ``docs`` and ``shard`` (0 to ``shards - 1``) and ``shard_size``, the bytes a row weighs.

    A row weighs the UTF-8 bytes of its text plus ``overhead``; a null text counts as empty. Rows with equal texts share
    a shard, so a group above one shard's part makes its shard as large as itself and the others stay even. Repeated
    rows are a group as any other; an empty table gives an empty result.
    """
    body = text_of(text)
    size = (F.octet_length(body) + overhead).cast("bigint")
    groups = cut_lineage(docs.select(group_of(body).alias("group"), size.alias("size")).groupBy("group").agg(F.sum("size").cast("bigint").alias("size")))
    total = groups.agg(F.sum("size")).first()[0] or 0
    bags = shards * bags_per_shard
    large = F.col("size") * bags > total  # fewer than ``bags`` groups can be
    bag = F.concat(F.lit("bag "), F.conv(F.substring("group", 1, 8), 16, 10).cast("bigint") % bags)
    items = groups.select(F.when(large, F.col("group")).otherwise(bag).alias("item"), "size").groupBy("item").agg(F.sum("size").cast("bigint").alias("size"))
    # At most two rows for every bag, so sending the table to all executors has a proven bound.
    placed = cut_lineage(balance(items, shards))
    own = F.broadcast(placed.where(~F.col("item").startswith("bag ")).toDF(*(own_name(docs, c) for c in ("own_item", "own_shard"))))
    shared = F.broadcast(placed.where(F.col("item").startswith("bag ")).toDF(*(own_name(docs, c) for c in ("bag_item", "bag_shard"))))
    key = own_name(docs, "group")
    kept = [c for c in docs.columns if c not in ("shard", "shard_size")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept], group_of(body).alias(key), size.alias("shard_size"))
    bag_key = F.concat(F.lit("bag "), F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % bags)
    return (
        keyed.join(own, keyed[key] == own[own.columns[0]], "left")
        .join(shared, bag_key == shared[shared.columns[0]], "left")
        .select(*[F.col(f"`{c}`") for c in kept], F.coalesce(own.columns[1], shared.columns[1]).alias("shard"), "shard_size")
    )


def number_slots(rows: DataFrame, by: str, keys: list[str]) -> DataFrame:
    """``rows`` with ``slot``, numbered without gaps from 0 within ``by``, in no task more than a chunk of a group.

    Rows are dealt into chunks by a hash of ``keys``; chunks are counted, and each starts where those before it end.
    """
    chunks = max(1, -(-rows.count() // CHUNK_ROWS))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64(*keys), F.lit(chunks)))
    counts = dealt.groupBy(by, "chunk").agg(F.count(F.lit(1)).alias("rows_here"))
    before = Window.partitionBy(by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(by, "chunk", F.coalesce(F.sum("rows_here").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy(by, "chunk").orderBy(*keys))
    numbered = dealt.withColumn("place", place)
    return numbered.join(starts, [by, "chunk"]).withColumn("slot", (F.col("before") + F.col("place") - 1).cast("bigint")).drop("chunk", "place", "before")


def shard_report(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One narrow row per document with its shard and its place there."""
    placed = assign_shards(docs.select("doc_id", "text"), shards).select(
        "doc_id",
        F.col("shard_size").alias("size"),
        F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
    )
    return number_slots(cut_lineage(placed), "shard", ["doc_id", "text_crc32", "size"]).withColumn("grown_shard", F.lit(None).cast("int"))
