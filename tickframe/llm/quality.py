"""Quality rules: base rules on words and lines, and distribution divergence.

The divergence compares two histograms of a document, of character classes and of common words, with those of
languages, which are summed over all documents. Distances are Jensen-Shannon distances (base 2, from 0 to 1). A document
is judged by the nearest language of its script, so that its own label is not needed, and only where it is long enough
for a histogram to say something.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import WHITE, let, own_name, text_of, words_of
from tickframe.session import cut_lineage

SYMBOLS = "#*$%&|<>"
COMMON_WORDS = {
    "en": "the of and to in a is that it for on was with as be by this are at from or an not have but".split(),
    "de": "der die und das ist in den von zu mit ein eine nicht auf für im des dem sich auch es an als".split(),
    "fr": "le la les de des du et un une en est que qui dans pour pas sur au par elle il ce se".split(),
    "es": "el la los las de del y en un una que es por con para se no su al lo como más".split(),
}
# Character classes in the order in which they are taken out of the text; the last class is the rest.
CLASSES = [r"\p{Ll}+", r"\s+", r"\p{Lu}+", r"[.,;:!?'\"()\-]+", r"\p{N}+", r"\p{L}+"]
# Scripts that are told apart besides Latin; all others count as one.
SCRIPTS = {name: rf"\p{{Is{name}}}" for name in "Cyrillic Greek Arabic Hebrew Devanagari Bengali Tamil Telugu Thai Hangul Armenian Georgian".split()}
SCRIPTS["East Asian"] = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}"


def _script_of(text: Column) -> Column:
    """The script of most of a text's letters; null for a text without letters."""

    def named(foreign):
        counts = F.array(*[F.struct((F.length(foreign) - F.length(F.regexp_replace(foreign, f"[{p}]+", ""))).alias("n"), F.lit(s).alias("script")) for s, p in SCRIPTS.items()])
        return let(F.array_max(counts), lambda top: F.when(2 * top["n"] >= F.length(foreign), top["script"]).otherwise("other"))

    def of_letters(foreign):
        latin = F.length(F.regexp_replace(text, r"[^\p{IsLatin}]+", ""))
        return F.when(F.length(foreign) == 0, F.when(text.rlike(r"\p{L}"), "Latin")).when(latin >= F.length(foreign), "Latin").otherwise(named(foreign))

    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.when(text.rlike("[A-Za-z]"), "Latin")).otherwise(let(F.regexp_replace(text, r"[\p{IsLatin}\P{L}]+", ""), of_letters))


def _class_counts(text: Column) -> Column:
    def without(pattern: str):
        # Every class is counted in what the classes before it left over.
        return lambda a: F.concat(a, F.array(F.regexp_replace(F.get(a, F.size(a) - 1), pattern, "")))

    arrays = F.array(text)
    for pattern in CLASSES:
        arrays = let(arrays, without(pattern))
    return let(
        F.transform(arrays, F.length),
        lambda n: F.concat(F.transform(F.sequence(F.lit(1), F.lit(len(CLASSES))), lambda i: F.get(n, i - 1) - F.get(n, i)), F.array(F.get(n, F.lit(len(CLASSES))))),
    )


def _common_counts(text: Column, n_words: Column, words: list[str]) -> Column:
    """Occurrences of each of ``words`` as a whole run of letters, and the number of all other words.

    Only words that a text has are counted in it, each by what is left of the found ones without it.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}++"), F.lit(0))
    found = F.filter(runs, lambda run: run.isin(words))

    def histogram(x):
        own = F.transform(x["own"], lambda w: F.size(x["found"]) - F.size(F.array_remove(x["found"], w)))
        return let(
            own,
            lambda n: F.transform(F.array(*[F.lit(w) for w in words]), lambda w: F.coalesce(F.get(n, F.array_position(x["own"], w).cast("int") - 1), F.lit(0))),
        )

    counts = let(found, lambda f: let(F.struct(f.alias("found"), F.array_distinct(f).alias("own")), histogram))
    return let(counts, lambda c: F.concat(c, F.array(F.greatest(F.lit(0), n_words - F.aggregate(c, F.lit(0), lambda a, x: a + x)))))


def jensen_shannon(counts: Column, reference: Column) -> Column:
    """Distance between a histogram of counts and a reference of probabilities; null for an empty histogram."""

    def part(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    terms = let(total, lambda t: F.zip_with(counts, reference, lambda x, q: let(x / t, lambda p: (part(p, q) + part(q, p)) / 2)))
    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))))


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the text.

    Windows are known by a hash of 64 bits. Where some are equal, they are sorted with their place; equal neighbours are
    repeated ones, and their places in order give the number of words covered.
    """
    windows = F.when(
        F.size(words) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))

    def repeated(s):
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])

    def cover(state, i):
        return F.struct(i.alias("last"), (state["n"] + F.least(F.lit(3), i - state["last"])).cast("bigint").alias("n"))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))

    def covered(hashes):
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.aggregate(F.sort_array(let(F.sort_array(placed), repeated)), start, cover)["n"]

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))


def common_words() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words})


MEASURES, CHARS, COMMON, SCRIPT = "quality", "quality_chars", "quality_common", "quality_script"


def measure_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``, a struct ``quality`` of base measures, the histograms ``quality_chars`` and
    ``quality_common``, and the script ``quality_script``. Columns of ``docs`` with these names are replaced."""
    words_name = own_name(docs, "words")
    words, body = F.col(words_name), text_of(text)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (MEASURES, CHARS, COMMON, SCRIPT)]
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)
    n_words = F.size(words)
    return docs.select(*kept, words_of(body).alias(words_name)).select(
        *kept,
        F.struct(
            n_words.cast("bigint").alias("n_words"),
            F.length(F.translate(body, WHITE, "")).cast("bigint").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
        ).alias(MEASURES),
        _class_counts(body).alias(CHARS),
        _common_counts(body, n_words, common_words()).alias(COMMON),
        _script_of(body).alias(SCRIPT),
    )


class Reference(NamedTuple):
    language: str
    script: str
    chars: list[float]
    common: list[float]
    blank: float  # distance of a text without common words


def language_references(measured: DataFrame, lang: str = "lang", min_chars: int = 200, min_words: int = 150) -> list[Reference]:
    """Character-class and common-word probabilities of every labelled language and script, whatever its share of the rows.

    Sums run over all measured documents with a language; only languages with too little text for a histogram are left out.
    """
    n_classes, n_words = len(CLASSES) + 1, len(common_words()) + 1
    sums = measured.where(F.col(f"`{lang}`").isNotNull() & F.col(SCRIPT).isNotNull()).groupBy(F.col(f"`{lang}`").alias("language"), F.col(SCRIPT).alias("script")).agg(
        *[F.sum(F.get(CHARS, F.lit(i))).cast("double").alias(f"c{i}") for i in range(n_classes)],
        *[F.sum(F.get(COMMON, F.lit(i))).cast("double").alias(f"w{i}") for i in range(n_words)],
    )
    found = []
    for row in sums.orderBy("language", "script").collect():
        chars = [row[f"c{i}"] or 0.0 for i in range(n_classes)]
        common = [row[f"w{i}"] or 0.0 for i in range(n_words)]
        if sum(chars) >= min_chars and sum(common) >= min_words:
            rest = common[-1] / sum(common)
            blank = math.sqrt(max(0.0, (math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest else 0) + (1 - rest)) / 2))
            found.append(Reference(row["language"], row["script"], [x / sum(chars) for x in chars], [x / sum(common) for x in common], blank))
    return found


def judge_measured(
    measured: DataFrame,
    references: list[Reference],
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_char_distance: float = 0.35,
    max_word_distance: float = 0.65,
    min_histogram_chars: int = 200,
    min_histogram_words: int = 150,
    max_blank_share: float = 0.95,
    min_blank: float = 0.25,
    lang: str = "lang",
) -> DataFrame:
    """Add the distances to the nearest language and the verdicts to ``quality``; the histograms are dropped.

    Only references of a document's script are compared, all of them for a text without letters; without one there is no
    verdict. The limit of the word distance is that of each language: ``max_blank_share`` of the distance that a text
    without common words has, at most ``max_word_distance``. Languages that hardly use the listed words (``min_blank``)
    say nothing about words: their own documents get no verdict of words, nor do documents without a known label where
    such a language shares the script.
    """
    of_script: dict[str | None, list[Reference]] = {None: references}
    for reference in references:
        of_script.setdefault(reference.script, []).append(reference)

    def by_script(result: Callable[[list[Reference]], Column | None], kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for script, some in of_script.items():
            value = result(some)
            if value is not None:
                out = F.when(F.col(SCRIPT).eqNullSafe(F.lit(script)), value).otherwise(out)
        return out

    def distances(counts: str, values: list[list[float]]) -> Column:
        table = F.array(*[F.array(*[F.lit(float(p)) for p in v]) for v in values])
        return let(F.col(counts), lambda c: F.transform(table, lambda q: jensen_shannon(c, q)))

    def by_chars(some: list[Reference]) -> Column | None:
        return F.array_min(distances(CHARS, [r.chars for r in some])) if some else None

    def by_words(some: list[Reference]) -> Column | None:
        using = [r for r in some if r.blank >= min_blank]
        if not using:
            return None
        limits = F.array(*[F.lit(min(max_word_distance, max_blank_share * r.blank)) for r in using])
        silent, known = [r.language for r in some if r.blank < min_blank], [r.language for r in using]
        label = F.col(f"`{lang}`")
        judged = F.coalesce(label.isin(known) & ~label.isin(silent), F.lit(False)) if silent else F.lit(True)
        return let(
            distances(COMMON, [r.common for r in using]),
            lambda d: F.struct(F.array_min(d).alias("distance"), (judged & (F.array_min(F.zip_with(d, limits, lambda x, y: x - y)) > 0)).alias("far")),
        )

    q, words = F.col(MEASURES), own_name(measured, "by_words")
    n_chars = F.aggregate(CHARS, F.lit(0), lambda s, x: s + x)
    compared = (
        measured.withColumn(words, F.when(q["n_words"] >= min_histogram_words, by_script(by_words, "struct<distance:double,far:boolean>")))
        .withColumn(
            MEASURES,
            F.struct(
                f"{MEASURES}.*",
                F.when(n_chars >= min_histogram_chars, by_script(by_chars, "double")).alias("char_distance"),
                F.col(words)["distance"].alias("word_distance"),
                F.coalesce(F.col(words)["far"], F.lit(False)).alias("far_words"),
            ),
        )
        .drop(CHARS, COMMON, SCRIPT, words)
    )
    failed = (q["n_words"] < min_words) | (q["n_repeat_words"] * 100 > q["n_words"] * max_repeat_percent)
    far = F.coalesce(q["char_distance"] > max_char_distance, F.lit(False)) | q["far_words"]
    shown = [q[f.name].alias(f.name) for f in compared.schema[MEASURES].dataType.fields if f.name != "far_words"]
    return compared.withColumn(MEASURES, F.struct(*shown, failed.alias("base_failed"), (~failed & ~far).alias("kept")))


def judge_quality(docs: DataFrame, text: str = "text", lang: str = "lang", **limits) -> DataFrame:
    """All columns of ``docs`` and a struct ``quality``: base measures, distances to the nearest language and verdicts.

    A null text has no words and fails the base rules as any text below ``min_words``. Texts shorter than a histogram's
    minimum get no verdict from it, and without references (no labelled rows) only the base rules count. Repeated rows
    are judged alike. A column ``quality`` of ``docs`` is replaced. ``limits`` are those of ``judge_measured``. The texts
    are read twice, as they are not kept between the sums and the verdicts.
    """
    measured = measure_quality(docs, text)
    return judge_measured(measured, language_references(measured, lang), lang=lang, **limits)


def quality_report(docs: DataFrame) -> DataFrame:
    """One narrow row per document. Measures and histograms are written once, so the texts are read once."""
    measured = cut_lineage(measure_quality(docs.select("doc_id", "text", "lang")).drop("text"))
    return judge_measured(measured, language_references(measured)).select("doc_id", f"{MEASURES}.*")
