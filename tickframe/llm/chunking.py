"""Substring dedup by content-defined chunks.

A gear rolling hash over the bytes of a text decides where a chunk ends, so the same passage is cut at the same places
whatever stands before it. Chunks are compared by digest. A chunk held by two documents or more is a repeat; adjacent
repeats of a document form a passage that other documents hold too. The document with the smallest id keeps a chunk, the
others may drop it, so a passage is split into spans where the keeper of its chunks changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickframe.llm.common import own_name, text_of
from tickframe.session import cut_lineage, small_side

# A boundary is possible at one byte in 32; with the least length a chunk has some 48 bytes.
MASK_BITS, LEAST, MOST = 5, 16, 128
SPAN_BYTES = 80
_GEAR = np.random.default_rng(20).integers(0, 1 << 16, 256, dtype=np.uint16)
_REACH = 16


def boundaries(data: bytes, least: int = LEAST, most: int = MOST, mask_bits: int = MASK_BITS) -> list[int]:
    """Ends of the chunks of ``data``.

    The gear hash of a byte is the sum of the table values of it and the 15 bytes before, each doubled for every byte
    that follows it. Sums over 1, 2, 4, 8 and 16 bytes are built from each other for all positions at once.
    """
    ends, begin, n = [], 0, len(data)
    if not n:
        return ends
    cuts: list[int] = []
    step = 1 << 20
    for start in range(0, n, step):
        first = max(0, start - _REACH)
        h = _GEAR[np.frombuffer(data, np.uint8)[first : start + step]]
        width = 1
        while width < _REACH:
            longer = h.copy()
            longer[width:] += h[:-width] << np.uint16(width)
            h, width = longer, 2 * width
        places = np.flatnonzero((h >> np.uint16(16 - mask_bits)) == 0) + first
        cuts.extend((places[places >= start] + 1).tolist())
    for cut in cuts:
        while cut - begin > most:
            begin += most
            ends.append(begin)
        if cut - begin >= least:
            ends.append(cut)
            begin = cut
    while n - begin > most:
        begin += most
        ends.append(begin)
    if begin < n:
        ends.append(n)
    return ends


def text_key(text: str) -> Column:
    """128 bits of a text, which tell rows of one id, or without an id, apart."""
    return F.unhex(F.md5(text_of(text)))


def _row_once(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, h and text; one row for those equal in id and text. Only rows that have equals are moved."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_key(text).alias("h"), text_of(text).alias("text"))
    several = small_side(rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").toDF("same_id", "same_h", "rows"))
    same = F.col("doc_id").eqNullSafe(F.col("same_id")) & (F.col("h") == F.col("same_h"))
    place = F.row_number().over(Window.partitionBy("doc_id", "h").orderBy("h"))
    first = rows.join(several, same, "left_semi").withColumn("place", place).where("place = 1").drop("place")
    return rows.join(several, same, "left_anti").unionByName(first)


def chunks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for every chunk of every different row: doc_id, h (``text_key``), place, start, size, its digest of 96 bits as
    d1 and d2, and ``again``, whether the text holds it before. Null and empty texts have no chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for i, value in enumerate(batch.column("text")):
                data, start, seen = value.as_py().encode(), 0, set()
                for n, end in enumerate(boundaries(data)):
                    digest = xxhash.xxh3_128_intdigest(data[start:end])
                    found.append((i, n, start, end - start, (digest >> 64) - (1 << 63), (digest & 0xFFFFFFFF) - (1 << 31), digest in seen))
                    seen.add(digest)
                    start = end
                if len(found) > 200_000:
                    yield rows(batch, found)
                    found = []
            yield rows(batch, found)

    def rows(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * 7
        index = pa.array(columns[0], pa.int64())
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_())
        own = [pa.array(c, k) for c, k in zip(columns[1:], kinds)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(index), batch.column("h").take(index), *own], ["doc_id", "h", "place", "start", "size", "d1", "d2", "again"])

    kind = "doc_id bigint, h binary, place int, start bigint, size int, d1 bigint, d2 int, again boolean"
    return _row_once(docs, text, doc_id).mapInArrow(run, kind)


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", span_bytes: int = SPAN_BYTES) -> DataFrame:
    """Passages that documents of other ids hold too: doc_id, h, span_start, span_end (bytes), n_docs, owner, is_first.

    A passage is a run of adjacent repeated chunks of at least ``span_bytes``. It is split into spans where ownership
    changes, so that a span holds only chunks of which its document has the smallest id (``is_first``), or only chunks
    that a smaller id holds. ``n_docs`` is the largest number of documents (distinct ids and texts) that hold one of its
    chunks, and ``owner`` the smallest id that holds its first chunk. Rows of one id count as one owner, and rows without
    an id as another one.
    """
    cut = chunks(docs, text, doc_id)
    id_key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    # A text that repeats a chunk within itself counts once; no task gathers the holders of a chunk.
    once = cut.where("NOT again").groupBy("d1", "d2").agg(F.min(id_key).alias("owner"), F.max(id_key).alias("last"), F.count(F.lit(1)).alias("n_docs"))
    repeats = cut.drop("again").join(once.where("owner < last").drop("last"), ["d1", "d2"]).drop("d1", "d2").withColumn("own", F.col("owner") == id_key)
    row = Window.partitionBy("doc_id", "h").orderBy("place")
    runs = repeats.withColumns({"run": F.col("place") - F.dense_rank().over(row), "turn": (F.col("own") != F.lag("own").over(row)).cast("int")})
    parts = runs.withColumn("part", F.coalesce(F.sum("turn").over(row), F.lit(0))).groupBy("doc_id", "h", "run", "part").agg(
        F.min("start").alias("span_start"),
        F.max(F.col("start") + F.col("size")).alias("span_end"),
        F.max("n_docs").alias("n_docs"),
        F.min(F.struct("place", "owner")).alias("first"),
        F.first("own").alias("is_first"),
    )
    passage = Window.partitionBy("doc_id", "h", "run")
    long = parts.withColumn("bytes", F.max("span_end").over(passage) - F.min("span_start").over(passage)).where(F.col("bytes") >= span_bytes)
    return long.select("doc_id", "h", "span_start", "span_end", "n_docs", F.when(F.col("first.owner") != -(1 << 63), F.col("first.owner")).alias("owner"), "is_first")


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", span_bytes: int = SPAN_BYTES) -> DataFrame:
    """``docs`` without the passages that a document of a smaller id keeps, and ``dropped_bytes``.

    A null text stays null. Cuts are moved outward to whole characters, into the text that stays.
    """
    return _without_spans(docs, repeated_spans(docs, text, doc_id, span_bytes), text, doc_id)


def _without_spans(docs: DataFrame, spans: DataFrame, text: str, doc_id: str) -> DataFrame:
    spans = spans.where(~F.col("is_first"))
    k, h, cuts, mine = (own_name(docs, n) for n in ("span_id", "span_hash", "span_cuts", "span_hash_own"))
    by_row = spans.groupBy(F.col("doc_id").alias(k), F.col("h").alias(h)).agg(F.sort_array(F.collect_list(F.struct("span_start", "span_end"))).alias(cuts))
    kept = [c for c in docs.columns if c != "dropped_bytes"]
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept], text_key(text).alias(mine))
    joined = keyed.join(by_row, keyed[f"`{doc_id}`"].eqNullSafe(by_row[k]) & (keyed[mine] == by_row[h]), "left").select(*[F.col(f"`{c}`") for c in kept], cuts)
    schema = StructType([f for f in docs.schema.fields if f.name != "dropped_bytes"]).add("dropped_bytes", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, dropped = [], []
            for value, own in zip(batch.column(text).to_pylist(), batch.column(cuts).to_pylist()):
                data, pieces, at = (value or "").encode(), [], 0
                for cut in own or ():
                    start, end = cut["span_start"], cut["span_end"]
                    while start < end and data[start] & 0xC0 == 0x80:
                        start += 1
                    while end < len(data) and end > start and data[end] & 0xC0 == 0x80:
                        end -= 1
                    pieces.append(data[at:start])
                    at = end
                left = b"".join(pieces) + data[at:]
                texts.append(left.decode() if value is not None else None)
                dropped.append(len(data) - len(left))
            out = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != cuts} | {text: pa.array(texts, pa.string()), "dropped_bytes": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return joined.mapInArrow(run, schema)


def span_report(docs: DataFrame) -> DataFrame:
    """One row for every span of a repeated passage of a document, with the bytes that its document loses in all and a
    digest of the text that it keeps. Rows equal in id and text give their spans once; rows without an id are one owner;
    null and empty texts, and an empty table, have no spans."""
    docs = docs.select("doc_id", "text")
    spans = cut_lineage(repeated_spans(docs))
    cleaned = _without_spans(docs.withColumn("of_hash", text_key("text")), spans, "text", "doc_id")
    left = cleaned.select(F.col("doc_id").alias("of_id"), "of_hash", "dropped_bytes", F.sha2("text", 256).alias("kept_sha256")).distinct()
    return spans.join(left, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_hash"))).drop("h", "of_id", "of_hash")
