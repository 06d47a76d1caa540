"""SimHash fingerprints and their search within a Hamming radius.

Every pair of neighbouring words is a term; its weight is the number of times it occurs. The bits of the term's hash
vote with the weight for or against each bit of the fingerprint. The search cuts fingerprints into blocks: two that
differ in at most ``radius`` bits agree in at least ``blocks - radius`` blocks, so every choice of that many blocks is a
table whose key they share in one case at least.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickframe.llm.common import text_of
from tickframe.session import cut_lineage

BITS = 128
_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
_SEEN = 300_000


class Fingerprints:
    """Fingerprints of texts, with a bounded memory of word hashes."""

    def __init__(self):
        self.hashes: dict[str, tuple[int, int]] = {}

    def _hash(self, word: str) -> tuple[int, int]:
        value = xxhash.xxh3_128_intdigest(word)
        if len(self.hashes) >= _SEEN:
            self.hashes.clear()
        pair = self.hashes[word] = (value >> 64, value & 0xFFFFFFFFFFFFFFFF)
        return pair

    def of(self, text: str) -> bytes:
        words = _WORDS(text)
        if not words:
            return bytes(BITS // 8)
        known, learn = self.hashes, self._hash
        terms = np.array([known.get(w) or learn(w) for w in words], dtype=np.uint64)
        if len(terms) > 1:
            terms = terms[:-1] * np.uint64(0x9E3779B97F4A7C15) + (terms[1:] ^ (terms[1:] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        terms ^= terms >> np.uint64(31)
        terms *= np.uint64(0x94D049BB133111EB)
        terms ^= terms >> np.uint64(30)
        votes = np.zeros(BITS, dtype=np.int64)
        for start in range(0, len(terms), 1 << 15):
            # Pieces of a long text vote one after the other, so that memory does not grow with its length.
            bits = np.unpackbits(terms[start : start + (1 << 15)].view(np.uint8).reshape(-1, BITS // 8), axis=1)
            votes += np.add.reduce(bits, axis=0, dtype=np.int32)
        return np.packbits(2 * votes > len(terms)).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimate of the cosine between the term weights of two texts: 1 for equal fingerprints, 0 for unrelated ones."""
    differing = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
    return max(0.0, float(np.cos(np.pi * differing / BITS)))


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``fingerprint``, 32 hexadecimal digits.

    Equal texts have equal fingerprints; null, empty and blank texts have that of no terms, all zeros. A column
    ``fingerprint`` of ``docs`` is replaced.
    """
    docs = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints()
        for batch in batches:
            found = pa.array([prints.of(t or "").hex() for t in batch.column(text).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "fingerprint"])

    schema = StructType(list(docs.schema.fields)).add("fingerprint", "string")
    return docs.mapInArrow(run, schema)


def _blocks(print_: Column, blocks: int) -> list[Column]:
    width = BITS // 4 // blocks
    return [F.substring(print_, i * width + 1, width) for i in range(blocks)]


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two fingerprints."""
    half = BITS // 8

    def number(x, start):
        return F.conv(F.substring(x, start, half), 16, -10).cast("bigint")

    return F.bit_count(number(a, 1).bitwiseXOR(number(b, 1))) + F.bit_count(number(a, half + 1).bitwiseXOR(number(b, half + 1)))


def find_near(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 8) -> DataFrame:
    """Pairs (query, found) of distinct fingerprints that differ in at most ``radius`` bits.

    Both inputs have a column ``fingerprint``; equal fingerprints count once, so a group of copies is one entry, and its
    members are found by joining on the fingerprint. Null fingerprints find nothing. Two blocks or more form a key, so
    that a single common block does not bring half the table together.
    """
    if radius >= blocks or (BITS // 4) % blocks:
        raise ValueError("more blocks than differing bits are needed, and they must divide the fingerprint")
    query = queries.select(F.col("fingerprint").alias("query")).where("query IS NOT NULL").distinct()
    found = prints.select(F.col("fingerprint").alias("found")).where("found IS NOT NULL").distinct()

    def keyed(df: DataFrame, name: str) -> DataFrame:
        parts = _blocks(F.col(name), blocks)
        keys = [F.concat(F.lit(f"{i}:"), *[parts[b] for b in chosen]) for i, chosen in enumerate(combinations(range(blocks), blocks - radius))]
        return df.select(name, F.explode(F.array(*keys)).alias("block_key"))

    near = keyed(query, "query").join(keyed(found, "found"), "block_key").where(hamming(F.col("query"), F.col("found")) <= radius)
    return near.select("query", "found").distinct()


_OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [part.split()[0] for part in _OUT.split(", ")]


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its text after an edit with the beginning of the next document.

    The next document is the one that follows in falling order of ids (null last, equal ids by text); after the last
    comes the first, and a document alone follows itself. Rows are dealt by ranges of the id and each text moves once.
    Only the first and the last document of a range also meet documents of other ranges.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    ranged = docs.select("doc_id", text_of().alias("text")).repartitionByRange(parts, F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order)

    def result(doc_id, text, print_, following, next_print, prints):
        edited = _edited(text, following)
        edited_print = prints.of(edited)
        return (
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), print_.hex(), edited_print.hex(),
            likeness(print_, edited_print), likeness(print_, next_print),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, before, part = Fingerprints(), None, TaskContext.get().partitionId()

        def out(rows):
            columns = [list(c) for c in zip(*rows)] if rows else [[] for _ in _NAMES]
            n = len(rows)
            arrays = dict(zip(_NAMES, columns)) | {"part": [None] * n, "edge": [None] * n, "edge_id": [None] * n, "edge_text": [None] * n}
            return pa.RecordBatch.from_pydict(arrays, schema=schema)

        def on_edge(kind, doc_id, text):
            none = {name: [None] for name in _NAMES}
            return pa.RecordBatch.from_pydict(none | {"part": [part], "edge": [kind], "edge_id": [doc_id], "edge_text": [text]}, schema=schema)

        kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
        schema = pa.schema([(p.split()[0], kinds[p.split()[1]]) for p in f"{_OUT}, part bigint, edge string, edge_id bigint, edge_text string".split(", ")])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                print_ = prints.of(text)
                if before is None:
                    yield on_edge("first", doc_id, text)
                else:
                    rows.append(result(*before, text, print_, prints))
                before = (doc_id, text, print_)
            yield out(rows)
        if before is not None:
            yield on_edge("last", before[0], before[1])

    done = cut_lineage(ranged.mapInArrow(run, f"{_OUT}, part bigint, edge string, edge_id bigint, edge_text string"))
    # One first and one last document for each range. Ranges are numbered in order, empty ones are absent.
    edges = done.where("edge IS NOT NULL")
    ranges = edges.where("edge = 'first'").select("part")
    numbered = ranges.select("part", F.lead("part").over(Window.orderBy("part")).alias("next_part"), F.min("part").over(Window.partitionBy(F.lit(0))).alias("first_part"))
    links = numbered.select("part", F.coalesce("next_part", "first_part").alias("next_part"))
    heads = edges.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("edge_text").alias("following"))
    pairs = edges.where("edge = 'last'").select("part", "edge_id", "edge_text").join(links, "part").join(heads, "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints()
        for batch in batches:
            rows = [result(i, t, prints.of(t), f, prints.of(f), prints) for i, t, f in zip(*[batch.column(c).to_pylist() for c in ("edge_id", "edge_text", "following")])]
            columns = [list(c) for c in zip(*rows)] if rows else [[] for _ in _NAMES]
            yield pa.RecordBatch.from_pydict(dict(zip(_NAMES, columns)))

    last = pairs.select("edge_id", "edge_text", "following").mapInArrow(finish, _OUT)
    return done.where("edge IS NULL").select(*_NAMES).unionByName(last)
