"""Language identification over every choice of known languages, and what it does with the others."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import langid

LANGUAGES = ("de", "en", "es", "fr")


def sampled(rows):
    """Samples as the fit makes them: each text whole and as a few of its words."""
    languages, buckets, counts = [], [], []
    for n, (language, letters) in enumerate(rows):
        words = letters.split()
        start = n % max(1, len(words))
        for piece in (letters, f" {' '.join(words[start : start + 2 + n % 8])} "):
            if piece.strip():
                held = langid.bucket_counts(piece)
                used = np.flatnonzero(held)
                languages.append(language)
                buckets.append(used.astype(np.int32))
                counts.append(held[used].astype(np.int32))
    starts = np.append(0, np.cumsum([len(b) for b in buckets]))
    return langid.Samples(languages, starts, np.concatenate(buckets), np.concatenate(counts))


@pytest.fixture(scope="module", params=["sf0.01", "sf0.1"])
def prose(request, spark):
    """Rows to learn from (at most 600 of a language) and rows that are held out, 800 at most."""
    table = spark.read.parquet(f"/root/testdata/{request.param}/documents.parquet")
    found = table.select("lang", langid.letters_of(F.col("text")).alias("letters"), (langid.fold(F.col("doc_id")) == 2).alias("out")).orderBy(F.xxhash64("doc_id")).collect()
    known = {x: [(r.lang, r.letters) for r in found if not r.out and r.lang == x][:600] for x in LANGUAGES}
    return known, [(r.lang, langid.bucket_counts(r.letters)) for r in found if r.out and r.letters.strip()][:800]


@pytest.mark.parametrize("known", [c for n in (2, 3, 4) for c in itertools.combinations(LANGUAGES, n)])
def test_any_choice_of_languages(prose, known):
    learnt, held_out = prose
    model = langid.train(sampled([r for x in known for r in learnt[x]]))
    assert np.isfinite(model.weights).all() and np.abs(model.weights).max() < 1000
    judged = [(language, *model.judge(counts)) for language, counts in held_out]
    own, foreign = [j for j in judged if j[0] in known], [j for j in judged if j[0] not in known]
    assert np.mean([model.languages[best] == language for language, best, _, _ in own]) > 0.97
    assert np.mean([far > model.limit for *_, far in own]) <= 0.02
    assert not foreign or np.mean([far > model.limit for *_, far in foreign]) >= 0.9


def test_a_left_out_language_is_rejected_by_the_fit(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table.where("lang <> 'fr'"))
    found = langid.predict(table, model).groupBy("lang").agg(F.avg(F.col("lang_rejected").cast("double")).alias("share"))
    shares = {r.lang: r.share for r in found.collect()}
    assert shares.pop("fr") > 0.9 and max(shares.values()) <= 0.02


def test_weights_that_are_no_numbers_are_an_error(monkeypatch):
    samples = sampled([("a", "abc abd"), ("b", "xyz xyy")] * 4)
    monkeypatch.setattr(langid, "_learn", lambda *a: (np.full((langid.BUCKETS, 2), np.nan), np.zeros(2)))
    with pytest.raises(ValueError):
        langid.train(samples)


def test_small_samples_and_single_languages():
    assert langid.train(langid.Samples([], np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))) is None
    one = langid.train(sampled([("a", "abc")]))
    assert one.languages == ["a"] and one.judge(langid.bucket_counts(" abc "))[:2] == (0, 1.0)


def test_odd_rows(spark):
    draw = random.Random(3)
    words = {"a": "abcde", "b": "vwxyz"}
    data = [(i, " ".join("".join(draw.choices(words[x], k=4)) for _ in range(20)), x) for i in range(80) for x in "ab"]
    data += [(None, "abcd", "a"), (7, None, "a"), (8, "", "b"), (9, "123 !", "b"), (10, "vwxy " * 30_000, None), (10, "vwxy " * 30_000, None)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string").withColumns({c: F.lit(7) for c in ("letters", "language", "lang_pred", "drawn")})
    found = langid.predict(frame, langid.fit(frame)).where("lang IS NULL OR text IS NULL OR length(text) < 6").collect()
    assert {(r.text and r.text[:4], r.lang_pred, r.lang_rejected, r.letters) for r in found} == {
        ("abcd", "a", False, 7), (None, "und", True, 7), ("", "und", True, 7), ("123 ", "und", True, 7), ("vwxy", "b", False, 7),
    }
    assert all(0 <= r.lang_score <= 1 for r in found) and len(found) == 6
    report = langid.language_report(frame.limit(0))
    assert report.collect() == [] and report.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
