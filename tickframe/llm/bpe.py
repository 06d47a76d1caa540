"""Byte-level BPE encoding and decoding over a global table of distinct words.

A text is cut into pre-tokens by a pattern. The distinct pre-tokens ("words") of all documents are gathered by one
aggregation, and each is encoded once. The ids come back in two ways with the same result: the most frequent words, at
most ``head_words`` of them whatever the input, are sent to every task; occurrences of all other words are exploded with
their place, joined with the word table by shuffle, and put back into their documents by place. Frequent words, which
would be hot join keys, thus never meet in one task. A text is cut once for both: what moves is a row of numbers, the
places of its frequent words in their order, and the other words beside it. Decoding looks ids up in the token-byte table.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import free_finished, text_of
from tickframe.session import new_path, shuffles_removed

HEAD_WORDS = 400_000
# White space after a space: such texts are matched as a whole.
SPACED = re.compile(r" \s")
FLUSH_WORDS = 300_000
CACHED_PARTS = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken file, read on the driver."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=None)
def _class_difference(name: str) -> tuple[str, str]:
    """Code points that only the regex module, and that only tiktoken's tables, count as letters (or numbers).

    The two follow different versions of Unicode. Only code points on which the regex module and Python's own tables
    differ, or that Python does not know, are tried.
    """
    ours = regex.compile(rf"\p{{{name}}}")
    theirs = tiktoken.Encoding("class", pat_str=rf"\p{{{name}}}", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    less, more = [], []
    for code in range(0x110000):
        char = chr(code)
        category = unicodedata.category(char)
        if category == "Cs":
            continue
        here = bool(ours.match(char))
        if category == "Cn" or here != (category[0] == name):
            there = bool(theirs.encode_ordinary(char))
            if here and not there:
                less.append(code)
            elif there and not here:
                more.append(code)
    return _ranges(less), _ranges(more)


def _ranges(codes: list[int]) -> str:
    out, i = [], 0
    while i < len(codes):
        j = i
        while j + 1 < len(codes) and codes[j + 1] == codes[j] + 1:
            j += 1
        out.append(f"\\U{codes[i]:08x}-\\U{codes[j]:08x}")
        i = j + 1
    return "".join(out)


def tiktoken_pattern(pattern: str) -> str:
    """The pattern for the regex module, with letters and numbers as tiktoken knows them."""
    for name in "LN":
        less, more = _class_difference(name)
        known = rf"[\p{{{name}}}{more}]"
        if less:
            known = rf"[{known}--[{less}]]"
        pattern = pattern.replace(rf"[^\s\p{{L}}\p{{N}}]", r"[^\s\p{L}\p{N}]").replace(rf"\p{{{name}}}", known)
    return "(?V1)" + pattern


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of the lowest rank is merged, the leftmost first, until none is known."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    none = len(ranks)
    pairs = [ranks.get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def merge_long_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for words of any length: a heap of pairs over a linked list, so that time stays near linear."""
    import heapq

    n, none = len(word), len(ranks)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2], none)) != none]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, j, stop = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j] and after[i] == j and end[j] == stop):
            continue
        alive[j], after[i], end[i] = False, after[j], stop
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else n
            if b < n and (r := ranks.get(word[a : end[b]], none)) != none:
                heapq.heappush(heap, (r, a, b, end[b]))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def encode_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    return merge_word(word, ranks) if len(word) <= 64 else merge_long_word(word, ranks)


def plain(part: str) -> bool:
    """Letters of the Latin blocks alone: with the space before them, one pre-token."""
    return part.isalpha() and (part.isascii() or max(part) < "\u0250")


def split_part(part: str, find: Callable) -> list[str] | None:
    """Pre-tokens of a part of a text between spaces, with the space before it; None where a pre-token may span it.

    A space before a character that is not white space always begins a pre-token, so the pre-tokens of a text are those
    of its parts, and parts repeat. Letters of the Latin blocks, with marks behind them or not, need no pattern.
    """
    if not part or part[0].isspace():
        return None
    if plain(part):
        return [" " + part]
    letters = part.rstrip(".,;:!?")
    if letters != part and plain(letters):
        return [" " + letters, part[len(letters) :]]
    return find(" " + part)


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    for value in batch.column(column):
        yield value.as_py() or ""


def _word_counter(pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        parts: Counter[str] = Counter()
        words: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            for part, n in parts.items():
                for word in split_part(part, find) or ():
                    words[word] += n
            out = pa.RecordBatch.from_pydict({"word": list(words), "n": pa.array(words.values(), pa.int64())})
            parts.clear()
            words.clear()
            return out

        seen: set[str] = set()
        waiting = 0
        for batch in batches:
            for text in _texts(batch, "text"):
                first, *rest = text.split(" ")
                words.update(find(first))
                own = set(rest)
                seen |= own
                if "" in own or SPACED.search(text):
                    words.update(find(text))
                waiting += 1
                if waiting >= 64:
                    parts.update(seen)
                    seen.clear()
                    waiting = 0
                    if len(parts) + len(words) > FLUSH_WORDS:
                        yield flush()
        parts.update(seen)
        yield flush()

    return run


def word_table(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Distinct words of all texts with their ids (bytes of little-endian numbers) and ``n``, a measure of frequency.

    ``n`` counts groups of 64 documents with the word. The table is written to the shared folder.
    """
    spark = docs.sparkSession
    shared, kind = spark.sparkContext.broadcast(ranks), id_type(ranks)
    counted = docs.select(text_of(text).alias("text")).mapInArrow(_word_counter(pattern), "word string, n bigint")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids = [np.array(encode_bytes(w.encode(), known), dtype=kind).tobytes() for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(ids, pa.binary())], ["word", "n", "ids"])

    path = new_path(spark, "words")
    # In order, neighbours share their first letters and take less room, here and in later shuffles.
    distinct = counted.groupBy("word").agg(F.sum("n").alias("n")).sortWithinPartitions("word")
    with shuffles_removed(spark):
        distinct.mapInArrow(encode, "word string, n bigint, ids binary").write.option("compression", "zstd").parquet(path)
    free_finished(spark)
    return spark.read.parquet(path)


def id_type(ranks: dict[bytes, int]) -> str:
    return "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"


def head_cut(words: DataFrame, limit: int) -> int:
    """The least frequency such that at most ``limit`` words reach it, from a histogram with steps of a sixteenth."""
    step = F.floor(F.log2("n") * 16).cast("int")
    histogram = sorted(words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)  # a few hundred rows
    total, cut = 0, None
    for row in histogram:
        total += row["words"]
        if total > limit:
            break
        cut = row["step"]
    return cut if cut is not None else 1 << 20


def word_codes(n: int) -> list[bytes]:
    """Codes of the numbers 1 to ``n``: seven bits a byte, the lowest last, all bytes but the last marked. 0 is a gap."""
    codes = []
    for number in range(1, n + 1):
        code = bytes([number & 127])
        while number := number >> 7:
            code = bytes([number & 127 | 128]) + code
        codes.append(code)
    return codes


def read_codes(coded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a row of codes, and where the last byte of each stands."""
    marks = np.frombuffer(coded, np.uint8)
    ends = np.flatnonzero(marks < 128)
    lengths = np.diff(ends, prepend=-1)
    numbers = marks[ends].astype(np.int64)
    for k in range(1, int(lengths.max(initial=0))):
        longer = lengths > k
        numbers[longer] |= (marks[ends[longer] - k].astype(np.int64) & 127) << (7 * k)
    return numbers, ends


def split_head(head: dict[str, bytes]) -> tuple[dict[str, bytes], dict[str, bytes]]:
    """The codes of plain words, by what follows their space, and of all others."""
    spaced = {w[1:]: code for w, code in head.items() if w[0] == " " and plain(w[1:])}
    return spaced, {w: code for w, code in head.items() if not (w[0] == " " and w[1:] in spaced)}


class Lookup:
    """Codes of the words of a text; where a word is not in the head, a gap, with the word beside it."""

    def __init__(self, head: tuple[dict[str, bytes], dict[str, bytes]], pattern: str):
        self.spaced, self.other = head
        self.find = regex.compile(pattern).findall
        self.known: dict[str, tuple[bytes, list[str]] | None] = {}

    def _words(self, words: list[str]) -> tuple[bytes, list[str]]:
        codes = [self.other.get(w) or w[0] == " " and self.spaced.get(w[1:]) or b"\0" for w in words]
        return b"".join(codes), [w for w, code in zip(words, codes) if code == b"\0"]

    def _part(self, part: str) -> tuple[bytes, list[str]] | None:
        if plain(part):
            return b"\0", [" " + part]
        if part not in self.known:
            words = split_part(part, self.find)
            self.known[part] = words and self._words(words)
        return self.known[part]

    def codes(self, text: str) -> tuple[bytes, list[str]]:
        """The codes in order, and the words for their gaps."""
        if len(self.known) > CACHED_PARTS:
            self.known.clear()
        first, *rest = text.split(" ")
        parts = list(map(self.spaced.get, rest))
        start, gaps = self._words(self.find(first))
        if None in parts:
            for i, code in enumerate(parts):
                if code is None:
                    found = self._part(rest[i])
                    if found is None:
                        return self._words(self.find(text))
                    parts[i] = found[0]
                    gaps += found[1]
        return start + b"".join(parts), gaps


_ROW_KEY = ("k", "h")


def _cut(head, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, squeeze = Lookup(head.value, pattern), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            known, rest = [], []
            for codes, gaps in map(lookup.codes, _texts(batch, "text")):
                known.append(squeeze(codes))
                # Apart from the codes, so that letters are not packed as numbers are.
                rest.append(squeeze(json.dumps(gaps, ensure_ascii=False, separators=(",", ":")).encode()) if gaps else b"")
            columns = [*(batch.column(c) for c in (*_ROW_KEY, "doc_id")), pa.array(known, pa.binary()), pa.array(rest, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*_ROW_KEY, "doc_id", "known", "rest"])

    return run


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words outside the head with their places among those of their row."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        found = [json.loads(expand(words)) if words else () for words in batch.column("rest").to_pylist()]
        repeat = pa.array([i for i, words in enumerate(found) for _ in words], pa.int64())
        places = pa.array([i for words in found for i in range(len(words))], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(repeat) for c in _ROW_KEY), places, pa.array([w for words in found for w in words], pa.string())], [*_ROW_KEY, "place", "word"]
        )


def _short(number: int) -> bytes:
    """A number as one byte or two, or as a mark and four."""
    if number < 1 << 12:
        return bytes([number]) if number < 128 else bytes([128 | number >> 7, number & 127])
    return struct.pack("<BI", 255, number)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a word's place and ids as one value for each run of a row's key: place, length of the ids, and the ids."""
    small = pa.array([_short(i) for i in range(1 << 12)], pa.binary())

    def short(numbers: np.ndarray) -> pa.Array:
        return small.take(pa.array(numbers)) if numbers.max() < len(small) else pa.array(map(_short, numbers.tolist()), pa.binary())

    for batch in batches:
        if not batch.num_rows:
            continue
        k, h, places = (batch.column(c).to_numpy() for c in (*_ROW_KEY, "place"))
        starts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]) | (h[1:] != h[:-1])) + 1])
        ids = batch.column("ids").cast(pa.binary())
        entries = pc.binary_join_element_wise(short(places), short(pc.binary_length(ids).to_numpy()), ids, b"")
        runs = pa.ListArray.from_arrays(pa.array(np.append(starts, batch.num_rows), pa.int32()), entries)
        yield pa.RecordBatch.from_arrays([pa.array(k[starts]), pa.array(h[starts]), pc.binary_join(runs, b"")], [*_ROW_KEY, "fill"])


def _unpacked(values: list[bytes]) -> dict[int, bytes]:
    """The ids by their places."""
    found = {}
    for value in values:
        at = 0
        while at < len(value):
            numbers = []
            for _ in range(2):
                number = value[at]
                if number == 255:
                    number, at = struct.unpack_from("<I", value, at + 1)[0], at + 5
                elif number > 127:
                    number, at = (number & 127) << 7 | value[at + 1], at + 2
                else:
                    at += 1
                numbers.append(number)
            found[numbers[0]] = value[at : at + numbers[1]]
            at += numbers[1]
    return found


def _filled(batch: pa.RecordBatch, kind: str, head: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some documents at a time, in order: the ids of all, with the joined words in their gaps, and where each document's begin and end."""
    expand = zstandard.ZstdDecompressor().decompress
    codes, fills, total = [], [], 0

    def together() -> tuple[np.ndarray, np.ndarray]:
        numbers, ends = read_codes(b"".join(codes))
        of_words = np.searchsorted(ends, np.cumsum([0, *map(len, codes)]))
        gaps = np.flatnonzero(numbers == 0)
        if np.diff(np.searchsorted(gaps, of_words)).tolist() != list(map(len, fills)):
            raise ValueError("a word was not found again for its gap")
        numbers[gaps] = len(head) + np.arange(len(gaps))
        words = [found[place] for found in fills for place in range(len(found))]
        starts, ids = _take(pa.concat_arrays([head, pa.array(words, pa.large_binary())]), numbers)
        width = np.dtype(kind).itemsize
        return np.frombuffer(ids, kind, starts[-1] // width), starts[of_words] // width

    for known, fill in zip(batch.column("known").to_pylist(), batch.column("fill").to_pylist()):
        codes.append(expand(known))
        fills.append(_unpacked(fill or []))
        total += len(codes[-1])
        if total > FLUSH_WORDS:
            yield together()
            codes, fills, total = [], [], 0
    if codes:
        yield together()


def _take(table: pa.Array, places: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """The values of ``table`` at ``places``: where each begins, and the last ends, and all one after another."""
    taken = table.take(pa.array(places))
    if not len(taken):
        return np.zeros(1, np.int64), memoryview(b"")
    return np.frombuffer(taken.buffers()[1], "<i8")[: len(taken) + 1], memoryview(taken.buffers()[2] or b"")


def _by_rank(values: dict[int, bytes]) -> pa.Array:
    """The values at the places of their ranks."""
    placed = [b""] * (max(values, default=-1) + 1)
    for rank, value in values.items():
        placed[rank] = value
    return pa.array(placed, pa.large_binary())


def _joined(table: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> Iterator[memoryview]:
    """The values of each document's ids one after another."""
    starts, values = _take(table, ids)
    at = starts[bounds].tolist()
    for start, end in zip(at, at[1:]):
        yield values[start:end]


def _encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str, doc_id: str, head_words: int):
    """Per row: doc_id, its codes, its other words, and ``fill``, the ids for the gaps; and the ids of the head by number, sent to tasks."""
    spark = docs.sparkSession
    pattern = tiktoken_pattern(pattern)
    words = word_table(docs, ranks, pattern, text)
    reaches = F.floor(F.log2("n") * 16) >= head_cut(words, head_words)
    table = words.where(reaches).toArrow().sort_by([("n", "descending"), ("word", "ascending")])  # at most head_words rows
    # Frequent words have short codes.
    head = spark.sparkContext.broadcast(split_head(dict(zip(table.column("word").to_pylist(), word_codes(table.num_rows)))))
    head_ids = spark.sparkContext.broadcast(pa.array([b"", *table.column("ids").to_pylist()], pa.large_binary()))
    # A row is found again by its id and a hash of its text, and without an id by two: rows equal in both have equal ids.
    body, id_column = text_of(text), F.col(f"`{doc_id}`")
    key = [F.coalesce(id_column.cast("bigint"), F.xxhash64(body)).alias("k"), F.xxhash64(id_column.isNull(), body).alias("h")]
    keyed = docs.select(*key, id_column.alias("doc_id"), body.alias("text"))
    # Moved once and read twice: both sides take all columns, so Spark reuses the exchange and the texts are not cut again.
    pieces = keyed.mapInArrow(_cut(head, pattern), f"k bigint, h bigint, doc_id {dict(keyed.dtypes)['doc_id']}, known binary, rest binary").repartition(*_ROW_KEY)
    rest = pieces.mapInArrow(_open, "k bigint, h bigint, place int, word string")
    tail = words.where(~reaches).select("word", "ids")
    met = rest.join(tail, "word").select(*_ROW_KEY, "place", "ids").sortWithinPartitions(*_ROW_KEY)
    filled = met.mapInArrow(_packed, "k bigint, h bigint, fill binary").groupBy(*_ROW_KEY).agg(F.collect_list("fill").alias("fill"))
    return pieces.join(filled, list(_ROW_KEY), "left").select("doc_id", "known", "rest", "fill"), head_ids


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", doc_id: str = "doc_id", head_words: int = HEAD_WORDS) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row of ``docs``; null and empty texts have no ids.

    Every match of ``pattern`` is encoded by itself, without special tokens. Ids are integers or null; other columns are
    not read. Repeated rows give repeated results.
    """
    kind = id_type(ranks)

    def run(batches):
        for batch in batches:
            at = 0
            for ids, bounds in _filled(batch, kind, head_ids.value):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(lists)), lists], ["doc_id", "ids"])
                at += len(lists)

    frame, head_ids = _encoded(docs, ranks, pattern, text, doc_id, head_words)
    return frame.mapInArrow(run, f"doc_id {dict(frame.dtypes)['doc_id']}, ids array<int>")


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id`` and ``bytes`` of every row of ``encoded`` (doc_id, ids); the table of tokens is bounded by the vocabulary."""
    tokens = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def run(batches):
        table = tokens.value
        for batch in batches:
            out = pa.array([b"".join(map(table.__getitem__, ids or ())) for ids in batch.column("ids").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), out], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, bytes binary")


def bpe_report(docs: DataFrame, ranks: dict[bytes, int], pattern: str, head_words: int = HEAD_WORDS) -> DataFrame:
    """Number of ids per document, the digest of the ids as text, and the digest of what they decode to."""
    kind = id_type(ranks)
    table = docs.sparkSession.sparkContext.broadcast((_by_rank({rank: b"%d," % rank for rank in ranks.values()}), _by_rank({rank: token for token, rank in ranks.items()})))

    def run(batches):
        names, tokens = table.value
        for batch in batches:
            counts, listed, decoded = [], [], []
            for ids, bounds in _filled(batch, kind, head_ids.value):
                counts += np.diff(bounds).tolist()
                listed += [hashlib.sha256(part[:-1]).hexdigest() for part in _joined(names, ids, bounds)]
                decoded += [hashlib.sha256(part).hexdigest() for part in _joined(tokens, ids, bounds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(listed, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    frame, head_ids = _encoded(docs, ranks, pattern, "text", "doc_id", head_words)
    return frame.mapInArrow(run, f"doc_id {dict(frame.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
