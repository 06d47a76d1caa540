"""Similarity self-join on word shingles with adaptive multi-match prefixes, as classes and their components.

Documents with the same words are one class. The shingles of a class are ordered: first the others by their hash, last
the ones that many classes share. Of two classes with a Jaccard similarity of 0.8 or more, each misses less than a fifth
of its shingles in the other, so the first fifth and one more of each, the prefixes, share a shingle; prefixes longer by
``l - 1`` share at least ``l``. For a given pair the sizes of both tell how much they must overlap, and so how far into
each prefix the ``l`` shared shingles lie; shared ones beyond that do not count. The more candidates a class's prefix brings, by the frequencies of its shingles, the
longer its prefix is made, and the more shared shingles a pair needs before it is verified.

Candidates are not all pairs of a list. In each list a few pivots, at first the classes with the most widely shared
shingles, then any, meet the rest; verified links merge classes, and only classes of different components meet in the
next round, so a large group of near copies costs as many pairs as it has members. After two rounds, they end when few
pairs are open or the last one settled less than half of them; what is open then is compared pair by pair. Every class
carries a parity sketch of its set, folded to a small one for the first round, and a meeting becomes a row only if the
sketches leave room for the similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import WORD, ascii_lower, free_finished, let, own_name, text_of, words_of
from tickframe.llm.graph import components
from tickframe.session import cut_and_measure, cut_lineage, small_side

WIDTH = 5
PERCENT = 80
# A shingle of more classes than this goes to the end of the order.
COMMON = 32
LONGEST = 12
# Open pairs for each row of the lists that may be left to the comparison of sketches.
PAIRS_PER_ROW = 32
PIVOTS = 4
LATER_PIVOTS = 16
SKETCH_WORDS = 16  # of 64 bits
FIRST_WORDS = 4  # the sketches of the first round, in which all lists take part, folded to these
NARROW_ROWS = 1_000_000  # two numbers a row


def shingle_hashes(words: Column, width: int = WIDTH) -> Column:
    """Sorted distinct hashes of the windows of ``width`` words; of all words together where there are fewer."""
    windows = let(
        words,
        lambda w: F.when(
            F.size(w) >= width, F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        )
        .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
        .otherwise(F.array().cast("array<bigint>")),
    )
    return F.sort_array(F.array_distinct(windows))


def _least(n: Column) -> Column:
    """Length of the shortest prefix that shares a shingle with that of every partner."""
    return n - F.ceil(n * PERCENT / 100.0).cast("int") + 1


def _stored(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Per row: id, digest of its words, number of shingles, sketch, and the first shingles, enough for a prefix and some more."""
    words = words_of(ascii_lower(text_of(text)))
    joined, longest = F.array_join(F.col("w"), " "), LONGEST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            values, starts = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            sizes = np.diff(starts)
            held = np.minimum(sizes, np.maximum(1, sizes - -(-sizes * PERCENT // 100) + 1 + sizes // 24 + longest))
            ends = np.concatenate([[0], np.cumsum(held)])
            first = values[np.repeat(starts[:-1] - ends[:-1], held) + np.arange(ends[-1])]
            heads = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(first, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "d1", "d2")] + [pa.array(sizes, pa.int32()), heads, _sketches(values[starts[0] : starts[-1]], sizes)],
                ["doc_id", "d1", "d2", "n", "tokens", "bits"],
            )

    sets = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), words.alias("w")).select(
        "doc_id", F.xxhash64(joined).alias("d1"), F.hash(joined).alias("d2"), shingle_hashes(F.col("w")).alias("tokens")
    )
    return sets.mapInArrow(run, "doc_id bigint, d1 bigint, d2 int, n int, tokens array<bigint>, bits array<bigint>")


def _sketches(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """For each set its parities: how often, even or odd, the low bits of its shingles name each of the sketch's bits."""
    width, ends, made = 64 * SKETCH_WORDS, np.concatenate([[0], np.cumsum(sizes)]), [np.zeros(0, "<i8")]
    for start in range(0, len(sizes), 1000):
        some = sizes[start : start + 1000]
        own = values[ends[start] : ends[start + len(some)]]
        marks = np.bincount(np.repeat(np.arange(len(some)), some) * width + (own & (width - 1)), minlength=len(some) * width)
        made.append(np.packbits((marks & 1).astype(np.uint8), bitorder="little").view("<i8"))
    words = np.concatenate(made)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, SKETCH_WORDS), pa.int32()), pa.array(words, pa.int64()))


def _classes(stored: DataFrame) -> DataFrame:
    """One row for each digest. Only rows that share theirs with others are moved."""
    rows = stored.where("n > 0")
    several = small_side(rows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("d1", "d2"))
    alone = rows.join(several, ["d1", "d2"], "left_anti").select("d1", "d2", F.col("doc_id").alias("smallest"), "n", "tokens", "bits")
    together = rows.join(several, ["d1", "d2"], "left_semi").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("smallest"), F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("bits").alias("bits")
    )
    return alone.unionByName(together).withColumn("cid", F.coalesce("smallest", "d1"))


def similar_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    Two documents link when their shingle sets have a Jaccard similarity of at least 0.8; the component is named by the
    smallest id that links reach. Documents without words have no shingles and stay alone, as do rows without an id that
    link to none (their component is null). Rows of one id are one node. An empty table gives an empty result.
    """
    stored, by_class = _resolved(docs, text, doc_id)
    narrow = stored.select("doc_id", "d1", "d2", F.col("n").cast("bigint").alias("n_shingles"))
    # Documents without words share a digest but no class.
    return narrow.join(by_class.drop("label"), ["d1", "d2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _resolved(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """The stored rows, and for each class (d1, d2) the label and the smallest id of its component, null where all lack one."""
    stored = cut_lineage(_stored(docs, text, doc_id))
    classes = _classes(stored)
    linked = _linked(classes, docs, text, doc_id)
    free_finished(docs.sparkSession)
    named = classes.select("d1", "d2", "cid", "smallest").join(linked, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    names = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    return stored, named.join(names, "label").select("d1", "d2", "label", "component_id")


def _linked(classes: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``cid`` and ``label`` of all classes that have a link."""
    prefixes = _prefixes(classes, docs, text, doc_id)
    free_finished(docs.sparkSession)
    lists = prefixes.select("cid", "n", "l", "central", _folded("bits").alias("bits"), F.inline("prefix")).withColumn("label", F.col("cid"))
    rows = lists.count()
    labels, before, number = None, None, 0
    while True:
        # After the most central classes, pivots are any of a list, the same in lists of the same classes.
        order = F.xxhash64("cid", F.lit(number)).alias("order") if number else F.col("central").alias("order")
        member, n_pivots = F.struct(order, "cid", "label", "n", "l", "rank", "bits"), LATER_PIVOTS if number else PIVOTS
        first_of = [F.max(F.when(F.pmod(F.hash("cid"), F.lit(n_pivots)) == i, member)) for i in range(n_pivots)]
        words = SKETCH_WORDS if number else FIRST_WORDS
        # Lists of one component are settled and left out.
        pivots, measured = cut_and_measure(
            lists.groupBy("token").agg(
                F.count(F.lit(1)).alias("df"), F.min("label").alias("low"), F.max("label").alias("high"), F.array_compact(F.array(*first_of)).alias("pivots")
            ).where("low < high").select("token", "df", "pivots"),
            rows=F.count(F.lit(1)),
        )
        if not measured["rows"]:
            break
        free_finished(docs.sparkSession)
        last = False
        if number > 1:
            of_label = lists.join(pivots.select("token"), "token", "left_semi").groupBy("token", "label").agg(F.count(F.lit(1)).cast("double").alias("c"))
            per_list = of_label.groupBy("token").agg(((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))) / 2).alias("pairs"))
            pairs = per_list.agg(F.sum("pairs")).first()[0]
            last = pairs <= PAIRS_PER_ROW * rows or (before is not None and pairs > before / 2)
            before = pairs
        if last:
            # Two classes that are still apart and never met a pivot hold all their shared prefix shingles here.
            open_lists = lists.join(pivots.select("token"), "token", "left_semi")
            x, y = (open_lists.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("cid", "n", "l", "rank", "label", "bits")]) for s in "xy")
            met = x.join(y, "token").where((F.col("x_cid") < F.col("y_cid")) & (F.col("x_label") != F.col("y_label")) & _fits("x_", "y_", words) & _counts("x_", "y_"))
            shared = met.groupBy(F.col("x_cid").alias("x"), F.col("y_cid").alias("y")).agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("x_l", "y_l")).alias("need"))
            close = cut_lineage(shared.where("shared >= need").select("x", "y"))
        else:
            met = lists.join(pivots, "token").withColumn("pivot", F.explode("pivots")).where((F.col("label") != F.col("pivot.label")) & _fits("", "pivot.", words) & _counts("", "pivot."))
            near = met.select(F.least("cid", "pivot.cid").alias("x"), F.greatest("cid", "pivot.cid").alias("y")).distinct()
            close = _enough_shared(cut_lineage(near), prefixes)
        free_finished(docs.sparkSession)
        found = _verified(close, docs, text, doc_id)
        # The components so far stand for the links they were made of.
        labels = cut_lineage(components(found if labels is None else found.union(labels)).toDF("cid", "new_label"))
        free_finished(docs.sparkSession)
        if last:
            break
        # Pivots have met all others of their list, which goes on without them as long as two are left.
        longer = pivots.where("df > size(pivots) + 1").select("token", F.col("pivots.cid").alias("met"))
        left = lists.join(longer, "token").where(~F.array_contains("met", F.col("cid"))).drop("met")
        if not number:
            left = left.drop("bits").join(prefixes.select("cid", "bits"), "cid")
        number += 1
        lists = cut_lineage(
            left.join(small_side(labels, NARROW_ROWS), "cid", "left").withColumn("label", F.coalesce("new_label", "cid")).select("cid", "n", "l", "central", "bits", "token", "rank", "label")
        )
    if labels is None:
        return classes.select("cid", F.col("cid").alias("label")).limit(0)
    return labels.withColumnRenamed("new_label", "label")


def _prefixes(classes: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``cid``, ``n``, ``least``, ``l``, ``central``, ``bits`` and ``prefix``, an array of (token, rank), of the classes that share one."""
    postings = classes.select("cid", "n", F.size("tokens").alias("held"), F.posexplode("tokens").alias("rank", "token"))
    shared = cut_lineage(postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    common = small_side(shared.where(F.col("df") > COMMON).select("token"))
    n_common = postings.join(common, "token").groupBy("cid", "n", "held").agg(F.count(F.lit(1)).alias("n_common"))
    # Classes whose stored shingles are too common to fill a prefix need all of theirs.
    dense = small_side(n_common.where((F.col("held") < F.col("n")) & (F.col("held") - F.col("n_common") < _least(F.col("n")))).select("cid"))
    least = _least(F.col("n"))
    free_finished(docs.sparkSession)
    extra, full = None, None
    if dense.limit(1).count():
        flagged = _full_sets(dense, docs, text, doc_id).select("cid", "n", F.explode("tokens").alias("token")).join(
            common.withColumn("is_common", F.lit(True)), "token", "left"
        )
        last = F.coalesce("is_common", F.lit(False))
        ordered = flagged.groupBy("cid", "n").agg(F.sort_array(F.collect_set(F.struct(last.alias("late"), "token"))).alias("all"))
        full = cut_lineage(ordered.select("cid", "n", F.slice("all", 1, F.least(F.col("n"), least + LONGEST - 1)).alias("all")))
        extra = full.select(F.explode("all").alias("x")).where("NOT x.late").select("x.token").distinct()
        extra = extra.join(shared.select("token"), "token", "left_anti").withColumn("df", F.lit(1).cast("bigint"))
    live = cut_lineage(shared if extra is None else shared.unionByName(extra))
    sizes = classes.select("cid", "n", F.size("tokens").alias("held"))
    # Shared shingles grow with the documents, so they are never sent whole to the driver and every executor.
    own = postings.select("cid", "rank", "token").join(live, "token").join(sizes, "cid")
    if full is not None:
        own = own.join(dense, "cid", "left_anti")
    found = own.select("cid", "n", "held", "rank", "token", "df")
    if full is not None:
        whole = full.select("cid", "n", F.size("all").alias("kept"), F.posexplode("all").alias("place", "x"))
        whole = whole.select("cid", "n", "kept", "place", F.col("x.token").alias("token")).join(live, "token")
    of_class, so_far = Window.partitionBy("cid"), Window.partitionBy("cid").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    late = (F.col("df") > COMMON).cast("int")
    # Places in the order that puts common shingles last.
    placed = found.withColumn("late", late).withColumn("before", F.coalesce(F.sum("late").over(so_far), F.lit(0))).withColumn("n_late", F.sum("late").over(of_class))
    placed = placed.withColumn("place", F.when(F.col("late") == 1, F.col("n") - F.col("n_late") + F.col("before")).otherwise(F.col("rank") - F.col("before")).cast("int"))
    # A prefix can be as long as the order is known: over the other shingles held, or over all.
    reach = F.when(F.col("held") >= F.col("n"), F.col("n")).otherwise(F.col("held") - F.col("n_late"))
    columns = ["cid", "n", "place", "token", "df", "held", "reach"]
    placed = placed.withColumn("reach", reach.cast("int")).select(*columns)
    if full is not None:
        # Of dense classes the whole order is known.
        placed = placed.unionByName(whole.select("cid", "n", "place", "token", "df", F.col("kept").alias("held"), F.col("n").alias("reach")))
    cost = F.sum(F.when(F.col("place") < least, F.col("df"))).over(of_class)
    asked = F.least(F.lit(LONGEST), 1 + F.floor(F.log2(1 + F.coalesce(cost, F.lit(0)))).cast("int"))
    sized = placed.select(
        "*",
        least.alias("least"),
        F.greatest(F.lit(1), F.least(asked, F.col("reach") - least + 1)).alias("l"),
        F.floor(F.sum("df").over(of_class) * 1000 / F.col("held")).cast("bigint").alias("central"),
    )
    inside = sized.where(F.col("place") < F.col("least") + F.col("l") - 1)
    prefixes = inside.groupBy("cid", "n", "least", "l", "central").agg(F.collect_list(F.struct("token", F.col("place").alias("rank"))).alias("prefix"))
    return cut_lineage(prefixes.join(classes.select("cid", "bits"), "cid"))


def _full_sets(wanted: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """All shingles of the classes in ``wanted`` (cid), read again from their documents."""
    words = words_of(ascii_lower(text_of(text)))
    id_column = F.col(f"`{doc_id}`").cast("bigint")
    with_id = docs.where(id_column.isNotNull()).select(id_column.alias("cid"), text_of(text).alias("body"))
    without = docs.where(id_column.isNull()).select(F.xxhash64(F.array_join(words, " ")).alias("cid"), text_of(text).alias("body"))
    picked = with_id.unionByName(without).join(wanted, "cid", "left_semi")
    # Written here, else filters on the shingles would be moved below the join and computed for all documents.
    return cut_lineage(picked.select("cid", shingle_hashes(words_of(ascii_lower(F.col("body")))).alias("tokens"))).withColumn("n", F.size("tokens"))


def _folded(bits: str) -> Column:
    """Sketches as if they had been made with ``FIRST_WORDS`` words: parities of the same low bits add up."""

    def word(i: int) -> Column:
        out = F.get(bits, F.lit(i))
        for k in range(i + FIRST_WORDS, SKETCH_WORDS, FIRST_WORDS):
            out = out.bitwiseXOR(F.get(bits, F.lit(k)))
        return out

    return F.array(*[word(i) for i in range(FIRST_WORDS)])


def _fits(x: str, y: str, words: int = SKETCH_WORDS) -> Column:
    """Sizes and sketches that leave room for the similarity: every shingle of one set alone changes one parity at most."""
    sizes = F.least(f"{x}n", f"{y}n") * 100 >= F.greatest(f"{x}n", f"{y}n") * PERCENT
    differing = sum((F.bit_count(F.get(f"{x}bits", i).bitwiseXOR(F.get(f"{y}bits", i))) for i in range(words)), F.lit(0))
    return sizes & (differing * (100 + PERCENT) <= (F.col(f"{x}n") + F.col(f"{y}n")) * (100 - PERCENT))


def _reach(x: str, y: str) -> Column:
    """Places of ``x`` before which it shares ``need``, the smaller ``l``, shingles with a similar ``y``.

    Similar sets share at least t / (1 + t) of the sum of their sizes. Behind the ``need``-th shared shingle lie all but
    ``need`` of them, so it is not among the last of ``x``.
    """
    overlap = F.ceil((F.col(f"{x}n") + F.col(f"{y}n")) * F.lit(PERCENT) / F.lit(100 + PERCENT) - 1e-9)
    return F.col(f"{x}n") - overlap + F.least(f"{x}l", f"{y}l")


def _counts(x: str, y: str) -> Column:
    """Whether a shingle at ``rank`` of both counts for the pair."""
    return (F.col(f"{x}rank") < _reach(x, y)) & (F.col(f"{y}rank") < _reach(y, x))


def _enough_shared(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The candidate ``pairs`` (x, y) whose prefixes share as many shingles as their lengths ask."""

    def side(name: str) -> DataFrame:
        return prefixes.select(*[F.col(c).alias(f"{name}_{c}") for c in ("cid", "n", "l", "prefix")])

    def within(s: str, other: str) -> Column:
        return F.transform(F.filter(f"{s}_prefix", lambda t: t["rank"] < _reach(f"{s}_", f"{other}_")), lambda t: t["token"])

    both = pairs.join(side("x"), F.col("x") == F.col("x_cid")).join(side("y"), F.col("y") == F.col("y_cid"))
    return cut_lineage(both.where(F.size(F.array_intersect(within("x", "y"), within("y", "x"))) >= F.least("x_l", "y_l")).select("x", "y").distinct())


def _bitmaps(sets: DataFrame) -> DataFrame:
    """A bitmap of each set: a bit for the low bits of every shingle, eight bits or more a shingle in a power of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for tokens in batch.column("tokens"):
                values = tokens.values.to_numpy()
                width = 1 << max(6, int(8 * len(values) - 1).bit_length())
                marks = np.zeros(width, np.uint8)
                marks[values & (width - 1)] = 1
                bits.append(np.packbits(marks, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("n"), pa.array(bits, pa.binary())], ["cid", "n", "bits"])

    return sets.select("cid", "n", "tokens").mapInArrow(run, "cid bigint, n int, bits binary")


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ, after the longer one is folded: never more than the sets' different shingles."""
    x, y, wide, narrow = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(a), 8 * len(b)
    if wide < narrow:
        x, y, wide, narrow = y, x, narrow, wide
    while wide > narrow:
        wide //= 2
        x = (x >> wide) | (x & ((1 << wide) - 1))
    return (x ^ y).bit_count()


def _close_bitmaps(close: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) whose bitmaps leave room for the similarity; a bitmap has an eighth of the bytes of its set."""
    bitmaps = _bitmaps(sets)
    left, right = bitmaps.toDF("a", "a_n", "a_bits"), bitmaps.toDF("b", "b_n", "b_bits")
    both = close.join(left, F.col("x") == F.col("a")).join(right, F.col("y") == F.col("b")).select("x", "y", (F.col("a_n") + F.col("b_n")).alias("n"), "a_bits", "b_bits")
    share = (100 - PERCENT) / (100 + PERCENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # At similarity t at most (1 - t) / (1 + t) of the sizes' sum is not shared.
            keep = [differing_bits(a.as_py(), b.as_py()) <= share * n + 1e-6 for a, b, n in zip(batch.column("a_bits"), batch.column("b_bits"), batch.column("n").to_pylist())]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return cut_lineage(both.mapInArrow(run, "x bigint, y bigint"))


def _verified(close: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Links (a, b) among the pairs (x, y): by bitmaps, then by their whole sets."""
    wanted = close.select(F.col("x").alias("cid")).union(close.select("y")).distinct()
    sets = _full_sets(small_side(wanted), docs, text, doc_id)
    close = _close_bitmaps(close, sets)
    left, right = sets.toDF("a", "a_tokens", "a_n"), sets.toDF("b", "b_tokens", "b_n")
    both = close.join(left, F.col("x") == F.col("a")).join(right, F.col("y") == F.col("b"))
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return both.where(shared * 100 >= (F.col("a_n") + F.col("b_n") - shared) * PERCENT).select("a", "b").distinct()


def keep_representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each component: of the rows of the id that names it, and, where all rows lack an id, of these.

    Of several such rows one stays: the one whose text has the smallest hash, and any one of equal rows. Rows without
    words are in no component and stay. All columns of ``docs`` come back; an empty table gives an empty one.
    """
    stored, by_class = _resolved(docs, text, doc_id)
    by_class = cut_lineage(by_class)
    id_column, body = F.col(f"`{doc_id}`").cast("bigint"), text_of(text)
    own = {n: own_name(docs, n) for n in ("gone_id", "several_id", "row_hash", "row_place", "class_1", "class_2", "class_label", "class_id")}
    kept = [F.col(f"`{c}`") for c in docs.columns]

    def first_of(rows: DataFrame, key: str) -> DataFrame:
        window = Window.partitionBy(key).orderBy(own["row_hash"])
        hashed = rows.withColumn(own["row_hash"], F.xxhash64(body))
        return hashed.withColumn(own["row_place"], F.row_number().over(window)).where(F.col(own["row_place"]) == 1).select(*kept)

    wordless = ~body.rlike(WORD)
    rows = stored.where("n > 0 AND doc_id IS NOT NULL").join(by_class, ["d1", "d2"])
    gone = rows.where("component_id <> doc_id").select(F.col("doc_id").alias(own["gone_id"])).distinct()
    several = rows.where("component_id = doc_id").groupBy(F.col("doc_id").alias(own["several_id"])).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    several = small_side(several, NARROW_ROWS)
    worded = docs.where(id_column.isNotNull() & ~wordless)
    left = worded.join(small_side(gone, NARROW_ROWS), id_column == F.col(own["gone_id"]), "left_anti")
    alone = left.join(several, id_column == F.col(own["several_id"]), "left_anti")
    repeated = first_of(left.join(several, id_column == F.col(own["several_id"])), own["several_id"])

    # Rows without an id are found by their words.
    joined = F.array_join(words_of(ascii_lower(body)), " ")
    nameless = docs.where(id_column.isNull() & ~wordless).withColumns({own["class_1"]: F.xxhash64(joined), own["class_2"]: F.hash(joined)})
    own_class = by_class.where("component_id IS NULL").toDF(own["class_1"], own["class_2"], own["class_label"], own["class_id"])
    unnamed = first_of(nameless.join(own_class, [own["class_1"], own["class_2"]]), own["class_label"])
    return alone.union(repeated).union(unnamed).union(docs.where(wordless))
