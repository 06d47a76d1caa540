"""Alignment of two tokenizers: where their tokens end at the same byte, and which tokens do so how often.

Arrow arrays carry the work inside the tasks: token lists are flattened with their parent indices, byte lengths become
ends by segmented cumulative sums, the ends of both tokenizers meet in an Acero hash join on (document, end), and linked
pairs are counted by ``Table.group_by``. Spark merges the partial counts. The most frequent pairs, at most ``HEAD_PAIRS``
whatever the input, are looked up in the tasks; all others are joined back by shuffle, and none of those can be hot.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickframe.session import cut_lineage, new_path

# Pairs that are sent to every task (17 bytes each), characters tokenized at once, pairs counted before they leave a task,
# characters of words whose ids a task keeps.
HEAD_PAIRS, SLICE_CHARS, FLUSH_PAIRS, KEPT_CHARS = 1 << 18, 1 << 20, 1 << 20, 1 << 22

_FIGURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_TOKENS = "a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
_PAIRS = "pairs array<bigint>, times array<int>"
_LONG, _INT = pa.int64(), pa.int32()
_SPACES = re.compile(r"\s \s")


class Vocabularies(NamedTuple):
    """Two tokenizers as the content of their files, so that executors need no files."""

    a: str  # byte-level BPE, JSON
    b: bytes  # pieces with byte fallback, a serialized model


def read_vocabularies(a_path: str, b_path: str) -> Vocabularies:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return Vocabularies(a.read(), b.read())


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes for themselves, the others
    for the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(printable))
    return {**{chr(b): b for b in printable}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


def byte_table(entries: Iterable[tuple[int, bytes]]) -> pa.Array:
    """Bytes of each token id; empty for ids without an entry."""
    known = dict(entries)
    return pa.array([known.get(i, b"") for i in range(max(known, default=-1) + 1)], pa.binary())


class Tokenizers:
    """Both tokenizers and the bytes of their tokens, loaded once in a task.

    No token of either reaches over a single space from the end of one word to the start of the next: A cuts before it, and
    B's pieces have spaces at their start alone. So texts are split at single spaces, every different word is encoded once
    (A's with its space), and its ids are kept for the words that come again. Where spaces stand beside other white space
    the whole text is one word.
    """

    def __init__(self, vocabularies: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabularies.a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.b)
        alphabet = byte_alphabet()
        entries = self.a.get_vocab()
        self.a_bytes = byte_table((i, bytes(alphabet[c] for c in t) if set(t) <= alphabet.keys() else t.encode()) for t, i in entries.items())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = byte_table((i, bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in enumerate(pieces))
        probe = ["a", "b's\n\nx,", "\tc", "1é.\n", "d"]
        ids = self._encode_words(probe)
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces) and all(
            whole == list(chain.from_iterable(parts)) for whole, parts in zip((x[0] for x in self._encode_words([" ".join(probe)])), ids)
        )
        self.known: tuple[dict, dict] = ({}, {})
        self.chars = 0

    def _encode_words(self, words: list[str]) -> tuple[list, list]:
        return [e.ids for e in self.a.encode_batch([f" {w}" for w in words], add_special_tokens=False)], self.b.encode(words, num_threads=1)

    def _words(self, text: str) -> list[str]:
        words = text.split(" ") if self.apart and "▁" not in text and not _SPACES.search(text) else [text]
        return [text] if "" in words else words

    def encode(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """Token ids of each text by A and by B; empty texts have none."""
        cut = [self._words(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(cut))
        places = {word: i for i, word in enumerate(dict.fromkeys(flat))}
        codes = pa.array(np.fromiter(map(places.__getitem__, flat), np.int32, len(flat)))
        missing = [word for word in places if word not in self.known[0]]
        self.chars += sum(map(len, missing))
        if self.chars > KEPT_CHARS:
            self.known, missing = ({}, {}), list(places)
            self.chars = sum(map(len, missing))
        upto = np.append(0, np.cumsum([len(words) for words in cut], dtype=np.int64))
        out = []
        for known, ids in zip(self.known, self._encode_words(missing) if missing else ((), ())):
            known.update(zip(missing, ids))
            taken = pa.array(map(known.__getitem__, places), pa.list_(_INT)).take(codes)
            out.append(pa.ListArray.from_arrays(pa.array(np.asarray(taken.offsets)[upto], _INT), taken.flatten()))
        return out[0], out[1]


def _spells(tokens: pa.Array, table: pa.Array, wanted: list[bytes]) -> np.ndarray:
    """Which lists of tokens, put together, are the wanted bytes."""
    pieces = table.take(tokens.flatten())
    ends = np.append(0, np.cumsum(pc.binary_length(pieces).to_numpy(zero_copy_only=False), dtype=np.int64))
    at = ends[np.asarray(tokens.offsets) - tokens.offsets[0].as_py()].tolist()
    body = pieces.buffers()[2].to_pybytes() if len(pieces) else b""
    return np.array([body[lo:hi] == w for lo, hi, w in zip(at[:-1], at[1:], wanted)], dtype=bool)


def _ends(tokens: pa.Array, table: pa.Array, name: str) -> pa.Table:
    """(at, place) of all tokens: document and end, as bytes from the document's start, in one number."""
    flat, parents = tokens.flatten(), pc.list_parent_indices(tokens)
    total = pc.cumulative_sum(pc.cast(pc.binary_length(table.take(flat)), _LONG))
    before = np.append(0, total.to_numpy())[np.asarray(tokens.offsets) - tokens.offsets[0].as_py()]
    ends = pc.subtract(total, pa.array(before, _LONG).take(parents))
    at = pc.add(pc.shift_left(pc.cast(parents, _LONG), pa.scalar(40, _LONG)), ends)
    return pa.table({"at": at, name: pa.array(np.arange(len(flat), dtype=np.int64))})


def _cut(values: pa.Array, after: np.ndarray) -> pa.Array:
    """``values`` as lists that end after the given places."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, after), _INT), values)


def align_texts(texts: list[str | None], load: Tokenizers, tokens: bool) -> dict[str, pa.Array]:
    """Figures and linked pairs of each text, with ``tokens`` also its ids and the places where groups end."""
    texts = [t or "" for t in texts]
    a, b = load.encode(texts)
    wanted = [f" {t}".encode() for t in texts]
    valid = _spells(a, load.a_bytes, wanted) & _spells(b, load.b_bytes, wanted) & np.array([bool(t) for t in texts], dtype=bool)
    if not valid.all():
        # Lists of unusable texts become empty, so that every text keeps its place.
        a, b = (pc.fill_null(pc.if_else(pa.array(valid), x, pa.scalar(None, x.type)), pa.scalar([], x.type)) for x in (a, b))
    met = _ends(a, load.a_bytes, "a").join(_ends(b, load.b_bytes, "b"), "at", join_type="inner", use_threads=False)
    doc, at_a, at_b = (met.column(c).combine_chunks().to_numpy() for c in ("at", "a", "b"))
    order = np.argsort(at_a, kind="stable")
    doc, at_a, at_b = doc[order] >> 40, at_a[order], at_b[order]
    upto = np.cumsum(np.bincount(doc, minlength=len(texts)))  # groups up to the end of each text
    a_flat, b_flat = a.flatten(), b.flatten()
    groups = pc.binary_join_element_wise(*(pc.binary_join(_cut(pc.cast(flat, pa.string()), at + 1), ",") for flat, at in ((a_flat, at_a), (b_flat, at_b))), "|")
    written = pc.binary_join(_cut(groups, upto), ";")
    n_a, n_b = (pc.cast(pc.list_value_length(x), _LONG) for x in (a, b))
    n_groups = pa.array(np.diff(np.append(0, upto)), _LONG)
    out = {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups,
        "n_links": n_groups,  # tokens are never empty, so one token of each side at most ends at a byte
        "groups_sha256": pa.array([hashlib.sha256(w.as_buffer()).hexdigest() if ok else "" for w, ok in zip(written, valid)], pa.string()),
    }
    pairs = a_flat.to_numpy()[at_a].astype(np.int64) * len(load.b_bytes) + b_flat.to_numpy()[at_b]
    counted = pa.table({"doc": doc, "pair": pairs}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by([("doc", "ascending"), ("pair", "ascending")])
    own = np.cumsum(np.bincount(counted.column("doc").to_numpy(), minlength=len(texts)))
    out["pairs"] = _cut(counted.column("pair").combine_chunks(), own)
    out["times"] = _cut(pc.cast(counted.column("count_all").combine_chunks(), _INT), own)
    if tokens:
        out |= {"a_ids": a, "b_ids": b}
        for name, lists, at in (("a_cuts", a, at_a), ("b_cuts", b, at_b)):
            starts = (np.asarray(lists.offsets) - lists.offsets[0].as_py())[:-1]
            out[name] = _cut(pa.array(at + 1 - starts[doc], _INT), upto)
    return out


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text or "") > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text or "")
    if texts:
        yield start, len(texts)


def _align(docs: DataFrame, vocabularies: Vocabularies, text: str, doc_id: str, wanted: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(tuple(vocabularies))
    own = StructType([StructField("doc_id", docs.schema[doc_id].dataType)])
    schema = StructType([*own.fields, *StructType.fromDDL(wanted).fields])
    names, tokens = schema.names[1:], "a_ids" in schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = Tokenizers(Vocabularies(*held.value))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _slices(texts):
                found = align_texts(texts[start:end], load, tokens)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), *(found[n] for n in names)], ["doc_id", *names])

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)


def align_documents(docs: DataFrame, vocabularies: Vocabularies, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, counts of tokens and groups, both lists of ids, and after how many ids of each list every group ends.

    Group k holds ``a_ids[a_cuts[k-1]:a_cuts[k]]`` and the same of ``b``. A text that is null or empty, or that either
    tokenizer doesn't give back byte for byte (with the space before it), has empty lists, zeros and an empty digest.
    One row for each row of ``docs``, whatever its id; further columns are left out, so none can clash.
    """
    return _align(docs, vocabularies, text, doc_id, f"{_FIGURES}, {_TOKENS}")


def count_pairs(linked: DataFrame, b_size: int) -> DataFrame:
    """``pair`` (a times ``b_size`` plus b), ``n`` links in the whole table, and ``is_best``: no pair of this b has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        for batch in batches:
            pairs, times = batch.column(0), batch.column(1)
            held.append(pa.table({"pair": pairs.flatten(), "n": pc.cast(times.flatten(), _LONG)}))
            size += len(held[-1])
            if size > FLUSH_PAIRS:
                held = [merged()]
                size = len(held[0])
                if size > FLUSH_PAIRS // 2:
                    yield from held.pop().to_batches()
                    size = 0
        if held:
            yield from merged().to_batches()

    counts = cut_lineage(linked.select("pairs", "times").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    counts = counts.withColumn("b", F.col("pair") % b_size)
    # One row for each entry of the vocabulary at most.
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))


def _head(counts: DataFrame, most: int) -> tuple[int, pa.Table, int]:
    """A power of two so that at most ``most`` pairs have as many links, these pairs, and the number of the others."""
    sizes = dict(map(tuple, counts.groupBy(F.length(F.bin("n")).alias("digits")).agg(F.count(F.lit(1))).collect()))
    least, taken = max(sizes, default=0) + 1, 0
    while least > 1 and taken + sizes.get(least - 1, 0) <= most:
        least -= 1
        taken += sizes.get(least, 0)
    bound = 1 << (least - 1) if least > 1 else 1
    return bound, counts.where(F.col("n") >= bound).orderBy("pair").toArrow(), sum(sizes.values()) - taken


def alignment_report(docs: DataFrame, vocabularies: Vocabularies, text: str = "text", doc_id: str = "doc_id", head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Counts, links that are their b's most frequent ones, links' counts summed, and the digest of the groups.

    One row for each row of ``docs``; ids may be null or repeated, since rows are numbered. Texts without tokens (see
    ``align_documents``) have zeros and an empty digest. Ties for the most frequent pair all count. An empty table gives
    an empty one.
    """
    spark = docs.sparkSession
    path = new_path(spark, "linked")
    _align(docs, vocabularies, text, doc_id, f"{_FIGURES}, {_PAIRS}").withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    linked = spark.read.parquet(path)
    counts = count_pairs(linked, len(Tokenizers(vocabularies).b_bytes))
    bound, head, rest = _head(counts, head_pairs)
    known = spark.sparkContext.broadcast(tuple(head.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n", "is_best")))
    fields = [f for f in linked.schema.fields if f.name not in ("pairs", "times")]
    schema = StructType([*fields, *StructType.fromDDL(f"n_best bigint, count_sum bigint, {_PAIRS}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            lists = batch.column("pairs")
            flat, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            place = np.minimum(np.searchsorted(pair, flat), max(0, len(pair) - 1))
            hit = pair[place] == flat if len(pair) else np.zeros(len(flat), dtype=bool)
            sums = []
            for weight in (best, n):
                of = np.zeros(len(flat), dtype=np.int64)
                of[hit] = weight[place[hit]].astype(np.int64) * times[hit]
                sums.append(np.diff(np.append(0, np.cumsum(of))[ends]))
            left = np.append(0, np.cumsum(~hit))[ends[1:]]
            open_pairs, open_times = pa.array(flat[~hit], _LONG), pa.array(times[~hit], _INT)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fields), *(pa.array(s, _LONG) for s in sums), _cut(open_pairs, left), _cut(open_times, left)],
                schema.names,
            )

    found = linked.mapInArrow(run, schema)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if not rest:
        return found.select(*columns)
    others = counts.where(F.col("n") < bound)
    links = found.select("row", F.inline(F.arrays_zip("pairs", "times")))
    more = links.join(others, links["pairs"] == others["pair"]).groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum")
    )
    both = found.drop("pairs", "times").join(more, "row", "left")
    return both.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}).select(*columns)
