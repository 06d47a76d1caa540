"""Phrases whose words occur together more often than their parts, counted in counting quotient filters.

Words that are frequent enough get dense ids, so an n-gram is a tuple of small numbers. A permutation that can be
inverted scatters these tuples; the leading bits of the result are the quotient, the rest is the remainder, kept whole,
so a filter gives back every n-gram and its exact count. Each task fills filters, sorted by quotient and remainder, one
for every range of quotients; the filters of a range meet in one task and are merged. n-grams are counted from two words
up: those of k words only where both their parts of k-1 words may be frequent, which a bitmap of quotients tells. Its size
is fixed, so it can be sent to every task; what it lets pass wrongly is counted exactly and then dropped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.session import cut_lineage, new_path

LONGEST, LEAST, UNKNOWN = 5, 100, "und"
# Words that tasks look up themselves, bits of the fixed bitmaps (4 MB each), distinct words or n-grams held in a task, and
# n-gram occurrences a range of quotients is made for.
HEAD_WORDS, MAP_BITS, HELD_WORDS, HELD_GRAMS, RANGE_GRAMS = 400_000, 25, 200_000, 2_000_000, 1 << 21

_TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]+")
_BREAK = re.compile(rb"[ \t.,;:!?\n-\r]")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words, lower-cased in A-Z, and the marks between pieces, in lists of bounded length."""
    body = (text or "").encode().lower()  # of bytes, lower() changes A-Z alone
    start = 0
    while start < len(body):
        cut = _BREAK.search(body, start + size)
        end = cut.start() if cut else len(body)
        yield _TOKEN.findall(body[start:end])
        start = end


def _is_word(token: bytes) -> bool:
    return token[0] not in b".,;:!?\n\x0b\x0c\r"


def count_words(docs: DataFrame, text: str, lang: str, least: int) -> DataFrame:
    """``lang``, ``word``, ``n`` for words that occur ``least`` times in their language, and the sum over all words of a
    language under a null word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            rows = [(name, word.decode(), n) for name, words in held.items() for word, n in words.items() if _is_word(word)]
            totals: Counter = Counter()
            for name, _, n in rows:
                totals[name] += n
            rows += [(name, None, n) for name, n in totals.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], t) for i, t in enumerate(kinds)], ["lang", "word", "n"])

        kinds = (pa.string(), pa.string(), pa.int64())
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1).to_pylist()):
                words = held.setdefault(name, Counter())
                for tokens in tokens_of(value.as_py()):
                    words.update(tokens)
                    if len(words) > HELD_WORDS:
                        yield flush()
                        words = held.setdefault(name, Counter())
            if sum(map(len, held.values())) > HELD_WORDS:
                yield flush()
        if any(_is_word(w) for words in held.values() for w in words):
            yield flush()

    found = docs.select(F.col(f"`{text}`").cast("string"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)))
    counts = found.mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return cut_lineage(counts.where((F.col("n") >= least) | F.col("word").isNull()))


def number_words(words: DataFrame) -> DataFrame:
    """``words`` with dense ids from 1, the most frequent first. The numbers depend on sampled ranges, so they are written."""
    order = [F.desc("n"), F.col("lang"), F.col("word")]
    placed = words.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")))
    # One row for each partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(starts), "part").select("lang", "word", "n", (F.col("before") + F.col("place") + 1).alias("id"))


def bitmap(slots: DataFrame) -> np.ndarray:
    """The numbers of column ``slot`` (below 2 ** MAP_BITS) as bits of a fixed number of bytes."""
    rows = slots.groupBy(F.bitmap_bucket_number(F.col("slot") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8)
    for bucket, bits in rows.collect():
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bytes(bits), dtype=np.uint8)
    return out


def _set_in(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _rare_slot(lang: str, word: bytes) -> int:
    return zlib.crc32(lang.encode() + b"\0" + word) & ((1 << MAP_BITS) - 1)


def number_texts(docs: DataFrame, words: DataFrame, n_words: int, text: str, lang: str, head_words: int) -> DataFrame:
    """``ids``: the words of each row as ids, 0 for breaks between pieces and for words without an id.

    The ``head_words`` most frequent words are looked up in the tasks; occurrences of words that may be among the others
    are joined with them and put back into their places.
    """
    spark = docs.sparkSession
    head: dict[str, dict[bytes, int]] = {}
    table = words.where(F.col("id") <= head_words).select("lang", "word", "id").toArrow()
    for name, word, i in zip(*(table.column(c).to_pylist() for c in ("lang", "word", "id"))):
        head.setdefault(name, {})[word.encode()] = i
    rest = words.where(F.col("id") > head_words)
    slot = F.crc32(F.encode(F.concat("lang", F.lit("\0"), "word"), "UTF-8")).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rare = bitmap(rest.select(slot.alias("slot"))) if n_words > head_words else None
    held = spark.sparkContext.broadcast((head, rare))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, rare = held.value
        rows: list[tuple] = []
        size = 0

        def written() -> pa.RecordBatch:
            upto = pa.array(np.append(0, np.cumsum([len(r[1]) for r in rows])), pa.int32())
            ids = pa.ListArray.from_arrays(upto, pa.array(np.concatenate([r[1] for r in rows])))
            arrays = [pa.array([r[0] for r in rows], pa.string()), ids, pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array([r[3] for r in rows], pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(arrays, ["lang", "ids", "places", "words"])

        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1).to_pylist()):
                of = head.get(name, {})
                ids, places, open_words, start = [np.zeros(0, np.int32)], [], [], 0
                for tokens in tokens_of(value.as_py()):
                    ids.append(np.fromiter((of.get(t, 0) for t in tokens), np.int32, len(tokens)))
                    if rare is not None:
                        for i in np.flatnonzero(ids[-1] == 0).tolist():
                            if _is_word(tokens[i]) and rare[(s := _rare_slot(name, tokens[i])) >> 3] >> (s & 7) & 1:
                                places.append(start + i)
                                open_words.append(tokens[i].decode())
                    start += len(tokens)
                rows.append((name, np.concatenate(ids), places, open_words))
                size += start
                if size > HELD_GRAMS:
                    yield written()
                    rows, size = [], 0
            if rows:
                yield written()
                rows, size = [], 0

    found = docs.select(F.col(f"`{text}`").cast("string"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)))
    numbered = found.mapInArrow(run, "lang string, ids array<int>, places array<int>, words array<string>")
    path = new_path(spark, "word-ids")
    if rare is None:
        numbered.select("ids").write.parquet(path)
        return spark.read.parquet(path)
    numbered.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    opened = numbered.select("row", "lang", F.inline(F.arrays_zip("places", "words")).alias("place", "word"))
    found = opened.join(rest.select("lang", "word", "id"), ["lang", "word"]).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", F.col("id").cast("int")))).alias("found"))
    patched = numbered.select("row", "ids").join(found, "row", "left")
    return patched.select(F.when(F.col("found").isNull(), F.col("ids")).otherwise(F.transform("ids", lambda v, i: F.coalesce(F.col("found")[i], v))).alias("ids"))


def permute(cells: list[np.ndarray], bits: int, back: bool = False) -> list[np.ndarray]:
    """A permutation of tuples of ``bits``-bit numbers: twice in turn, each takes up a hash of the others. ``back`` inverts it."""
    cells, n = list(cells), len(cells)
    turns = [(turn, j) for turn in range(2) for j in range(n)]
    for turn, j in reversed(turns) if back else turns:
        h = np.full(len(cells[0]), turn * n + j + 1, dtype=np.uint64)
        for i, cell in enumerate(cells):
            if i != j:
                h = (h ^ cell) * _MULTIPLIER
                h ^= h >> np.uint64(29)
        h *= _MULTIPLIER
        cells[j] = cells[j] ^ (h >> np.uint64(64 - bits))
    return cells


def limb_bits(n: int, bits: int) -> list[int]:
    """Widths of the 64-bit numbers that hold a tuple of ``n`` numbers, as many whole ones in each as fit."""
    each = 64 // bits
    return [bits * min(each, n - at) for at in range(0, n, each)]


def pack(cells: list[np.ndarray], bits: int) -> list[np.ndarray]:
    each, out = 64 // bits, []
    for at in range(0, len(cells), each):
        limb = cells[at].copy()
        for cell in cells[at + 1 : at + each]:
            limb = limb << np.uint64(bits) | cell
        out.append(limb)
    return out


def unpack(limbs: list[np.ndarray], n: int, bits: int) -> list[np.ndarray]:
    mask, out = np.uint64((1 << bits) - 1), []
    for limb, width in zip(limbs, limb_bits(n, bits)):
        out += [limb >> np.uint64(s) & mask for s in range(width - bits, -1, -bits)]
    return out


def leading(limb: np.ndarray, width: int, wanted: int) -> np.ndarray:
    """The ``wanted`` leading bits of numbers of ``width`` bits, zeros after them where there are fewer."""
    return limb >> np.uint64(width - wanted) if width >= wanted else limb << np.uint64(wanted - width)


def count_sorted(limbs: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order, and the sums of their counts (of ones without them)."""
    order = np.lexsort(limbs[::-1]) if len(limbs) > 1 else np.argsort(limbs[0], kind="stable")
    limbs = [limb[order] for limb in limbs]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([limb[1:] != limb[:-1] for limb in limbs])
    starts = np.flatnonzero(new)
    sums = np.diff(np.append(starts, len(order))) if counts is None else np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
    return [limb[starts] for limb in limbs], sums.astype(np.int64)


def write_filter(limbs: list[np.ndarray], counts: np.ndarray, widths: list[int], quotient: int, low: int, n_slots: int) -> bytes:
    """Sorted keys of the quotients from ``low`` on as a filter: a bit for each of the ``n_slots`` quotients that occurs, a
    bit for each entry that ends its quotient's run, the remainders in whole bytes, and a byte for each count (255: the
    count follows after all of them in eight bytes)."""
    slot = (limbs[0] >> np.uint64(widths[0] - quotient)).astype(np.int64) - low
    occupied = np.zeros(n_slots, dtype=bool)
    occupied[slot] = True
    ends = np.append(slot[1:] != slot[:-1], True)
    parts = [np.packbits(occupied, bitorder="little").tobytes(), np.packbits(ends, bitorder="little").tobytes()]
    for limb, width in zip(limbs, [widths[0] - quotient, *widths[1:]]):
        rest = limb & np.uint64((1 << width) - 1)
        parts.append(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-width // 8)].tobytes())
    many = counts >= 255
    parts += [np.where(many, 255, counts).astype(np.uint8).tobytes(), counts[many].astype("<i8").tobytes()]
    return np.array([quotient, low, n_slots, len(counts)], dtype="<i8").tobytes() + b"".join(parts)


def read_filter(body: bytes, widths: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys and counts of a filter, in order."""
    quotient, low, n_slots, n = np.frombuffer(body, dtype="<i8", count=4).tolist()
    at = 32

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(body, dtype=np.uint8, count=size, offset=at - size)

    slots = np.flatnonzero(np.unpackbits(take(-(-n_slots // 8)), bitorder="little", count=n_slots))
    ends = np.unpackbits(take(-(-n // 8)), bitorder="little", count=n).astype(np.int64)
    slot = (slots[np.cumsum(ends) - ends] + low).astype(np.uint64)
    limbs = []
    for width in [widths[0] - quotient, *widths[1:]]:
        size = -(-width // 8)
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :size] = take(n * size).reshape(n, size)
        limbs.append(wide.view("<u8").reshape(n).astype(np.uint64))
    if quotient:
        limbs[0] = limbs[0] | slot << np.uint64(widths[0] - quotient)
    counts = take(n).astype(np.int64)
    many = counts == 255
    counts[many] = take(8 * int(many.sum())).view("<i8")
    return limbs, counts


def _cells(ids: np.ndarray, starts: np.ndarray, n: int) -> list[np.ndarray]:
    return [ids[starts + i].astype(np.uint64) for i in range(n)]


def places_of(ids: np.ndarray, n: int, bits: int, passing: list[np.ndarray]) -> np.ndarray:
    """Where n-grams start that hold no break and whose parts of 2 to n-1 words all are in ``passing``, a bitmap for each size."""
    ok = ids != 0
    ok = ok[:-1] & ok[1:]
    for size, bits_set in enumerate(passing, 2):
        starts = np.flatnonzero(ok)
        first = pack(permute(_cells(ids, starts, size), bits), bits)[0]
        ok[starts] = _set_in(bits_set, leading(first, limb_bits(size, bits)[0], MAP_BITS))
        ok = ok[:-1] & ok[1:]
    return np.flatnonzero(ok)


def count_grams(texts: DataFrame, n: int, bits: int, ranges: int, passing: list[np.ndarray], least: int) -> DataFrame:
    """``ids`` (of ``n`` words), ``a``, ``slot`` of all n-grams that occur ``least`` times; 2 ** ``ranges`` ranges are merged apart."""
    held = texts.sparkSession.sparkContext.broadcast(passing)
    widths = limb_bits(n, bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[list[np.ndarray], np.ndarray]] = []
        raw: list[np.ndarray] = []
        size = words = 0

        def add() -> None:
            nonlocal kept, raw, size, words
            ids = np.concatenate(raw) if raw else np.zeros(0, np.int32)
            starts = places_of(ids, n, bits, held.value) if len(ids) > 1 else np.zeros(0, np.int64)
            kept.append(count_sorted(pack(permute(_cells(ids, starts, n), bits), bits)))
            size += len(kept[-1][1])
            raw, words = [], 0

        def merge() -> None:
            nonlocal kept, size
            kept = [count_sorted([np.concatenate(x) for x in zip(*(k[0] for k in kept))], np.concatenate([k[1] for k in kept]))]
            size = len(kept[0][1])

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal kept, size
            (limbs, counts), kept, size = kept[0], [], 0
            # About as many quotients as entries; a range is a number of whole quotients.
            quotient = min(widths[0], max(ranges, len(counts).bit_length()))
            shift = max(0, quotient - ranges)
            of = leading(limbs[0], widths[0], quotient).astype(np.int64) >> shift
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            bodies = [write_filter([x[lo:hi] for x in limbs], counts[lo:hi], widths, quotient, int(of[lo]) << shift, 1 << shift) for lo, hi in zip(starts, [*starts[1:], len(of)])]
            yield pa.RecordBatch.from_arrays([pa.array(of[starts], pa.int64()), pa.array(bodies, pa.binary())], ["range", "filter"])

        for batch in batches:
            for ids in batch.column(0):
                values = ids.values
                if values is not None and len(values) >= n:
                    raw += [values.to_numpy(), np.zeros(1, np.int32)]
                    words += len(values)
                    if words > HELD_GRAMS // 2:
                        add()
                        if size > HELD_GRAMS:
                            merge()
                            if size > HELD_GRAMS // 2:
                                yield from flush()
        add()
        merge()
        if size:
            yield from flush()

    def merge_range(table: pa.Table) -> pa.Table:
        filters = [read_filter(body.as_py(), widths) for body in table.column("filter")]
        limbs, counts = count_sorted([np.concatenate(x) for x in zip(*(f[0] for f in filters))], np.concatenate([f[1] for f in filters]))
        often = counts >= least
        limbs = [limb[often] for limb in limbs]
        cells = permute(unpack(limbs, n, bits), bits, back=True)
        flat = np.stack(cells, axis=1).astype(np.int32).ravel() if len(limbs[0]) else np.zeros(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, n), pa.int32()), pa.array(flat))
        slot = leading(limbs[0], widths[0], MAP_BITS).astype(np.int64)
        return pa.table({"ids": lists, "a": pa.array(counts[often], pa.int64()), "slot": pa.array(slot, pa.int64())})

    filters = texts.select("ids").mapInArrow(fill, "range bigint, filter binary")
    return cut_lineage(filters.groupBy("range").applyInArrow(merge_range, "ids array<int>, a bigint, slot bigint"))


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, head_words: int = HEAD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Numbered words (``lang``, ``word``, ``n``, ``id``), sums of words by language (``lang``, ``n``), and all phrases of 2
    to ``longest`` words that occur ``least`` times within pieces of one language (``ids``, ``a``)."""
    spark = docs.sparkSession
    counted = count_words(docs, text, lang, least)
    totals = counted.where("word IS NULL").select("lang", "n")
    words = cut_lineage(number_words(counted.where("word IS NOT NULL")))
    n_words, occurrences = words.count(), totals.agg(F.sum("n")).first()[0] or 0
    bits = max(1, n_words.bit_length())
    if bits > 31:
        raise ValueError("more frequent words than ids of 31 bits can number")
    ranges = max(9, (occurrences // RANGE_GRAMS).bit_length())
    texts = number_texts(docs, words, n_words, text, lang, head_words)
    phrases, passing = _no_phrases(spark), []
    for n in range(2, longest + 1):
        found = count_grams(texts, n, bits, ranges, passing, least)
        phrases = phrases.unionByName(found.select("ids", "a"))
        passing = [*passing, bitmap(found)] if n < longest else passing
    return words, totals, phrases


def _no_phrases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "ids array<int>, a bigint")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, most: int = 2000, head_words: int = HEAD_WORDS, salts: int = 64) -> DataFrame:
    """Each language's ``most`` best phrases: lang, rank, phrase, a, l, r, n, score, by the rules of the ranking below.

    A phrase is cut after each of its words but the last; the cut with the lowest ``floor(1000 * a * n / (l * r))`` counts,
    the first of equal ones. A phrase goes when one that is a word longer, holds it and occurs as often exists (any longer
    one that holds it and occurs as often has such a part in between). Order: score and a descending, then the phrase by
    its UTF-8 bytes, so ranks do not depend on chance. Null languages count as ``und``, null texts as empty; rows count
    as often as they are there; further columns are left out. Without phrases the result is empty.
    """
    words, totals, phrases = phrase_counts(docs, text, lang, longest, least, head_words)
    parts = phrases.unionByName(words.select(F.array(F.col("id").cast("int")).alias("ids"), F.col("n").alias("a")))
    longer = phrases.where(F.size("ids") > 2)
    inner = longer.select("a", F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids"))
    held = inner.groupBy("ids").agg(F.max("a").alias("around"))
    kept = phrases.join(held, "ids", "left").where(F.col("around").isNull() | (F.col("around") < F.col("a"))).drop("around")
    kept = kept.withColumn("first", F.col("ids")[0].cast("bigint")).join(words.select(F.col("id").alias("first"), "lang"), "first").drop("first")
    cuts = kept.join(totals, "lang").select("lang", "ids", "a", "n", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    for name, part in (("l", "slice(ids, 1, k)"), ("r", "slice(ids, k + 1, size(ids) - k)")):
        cuts = cuts.withColumn("part", F.expr(part)).join(parts.select(F.col("ids").alias("part"), F.col("a").alias(name)), "part").drop("part")
    # 38 digits hold the products exactly; the quotient is at most 10 n, since l and r are at least a, and a at least 100.
    score = F.expr("(CAST(a AS DECIMAL(18,0)) * CAST(n AS DECIMAL(18,0)) * 1000) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "ids", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = cut_lineage(scored.select("lang", "ids", "a", "n", "cut.score", "cut.l", "cut.r"))
    spelled = scored.select("ids", F.posexplode("ids").alias("place", "id")).withColumn("id", F.col("id").cast("bigint")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("ids").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = scored.join(spelled, "ids").drop("ids").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold nearly all phrases: the best of each of its slices first, then the best of those.
    best = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= most)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
