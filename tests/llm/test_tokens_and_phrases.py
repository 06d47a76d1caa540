"""Tokenizer alignment, phrase mining and the rule ensemble against plain Python, with odd rows and both ways of look-up."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tickframe.llm import alignment, collocations, rule_ensemble

SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "  two  spaces ", "the cat sat on the mat", "<|endoftext|> and </s> <s> <0x41> <unk>", "a▁b", "ﬁne Å x y", "l'été déjà vu, 12345 日本語 \U000323b0!",
    "tabs\tand\nlines\r\n\n\nend ", "\x1c\x85  x", "x" * 3000, "the mat sat on the cat. The the THE!", "🙂🙂 it's we'll I'D 'sx''s", "the cat sat on the mat",
]


@pytest.fixture(scope="module")
def both():
    return alignment.read_vocabularies(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


def plain_alignment(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text, and the groups, by whole-text encoding."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letters = {**{chr(x): x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174}}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if chr(x) not in letters)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    found = []
    for text in texts:
        spelled = f" {text}".encode()
        ids_a = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a, bytes_b = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a], [piece(i) for i in ids_b]
        if not text or b"".join(bytes_a) != spelled or b"".join(bytes_b) != spelled:
            found.append(([], [], []))
            continue
        ends_a, ends_b = ({sum(map(len, x[: k + 1])): k for k in range(len(x))} for x in (bytes_a, bytes_b))
        cuts = [(ends_a[e], ends_b[e]) for e in sorted(ends_a.keys() & ends_b.keys())]
        groups = [(ids_a[i + 1 : k + 1], ids_b[j + 1 : m + 1]) for (i, j), (k, m) in zip([(-1, -1), *cuts], cuts)]
        found.append((ids_a, ids_b, groups))
    linked = Counter((x[-1], y[-1]) for _, _, groups in found for x, y in groups)
    most = defaultdict(int)
    for (_, y), n in linked.items():
        most[y] = max(most[y], n)
    rows = []
    for ids_a, ids_b, groups in found:
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        counts = [(linked[x[-1], y[-1]], most[y[-1]]) for x, y in groups]
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        rows.append((len(ids_a), len(ids_b), len(groups), len(groups), sum(n == m for n, m in counts), sum(n for n, _ in counts), digest))
    return rows, [f[2] for f in found]


@pytest.mark.parametrize("head", [0, 3, alignment.HEAD_PAIRS])
def test_alignment(spark, both, head, monkeypatch):
    real = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    texts = TEXTS + real
    monkeypatch.setattr(alignment, "SLICE_CHARS", 20_000)
    monkeypatch.setattr(alignment, "KEPT_CHARS", 30_000)
    monkeypatch.setattr(alignment, "FLUSH_PAIRS", 300)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("pairs", F.lit(1)).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in alignment.alignment_report(frame, both, head_pairs=head).collect()}
    expected = plain_alignment(texts)[0]
    assert got == dict(enumerate(expected))
    assert expected[0] == expected[6] == (0, 0, 0, 0, 0, 0, "") and expected[4][2] > 0


def test_alignment_lists(spark, both):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    groups = plain_alignment(TEXTS)[1]
    for r in alignment.align_documents(frame, both).collect():
        cuts = list(zip([0, *r.a_cuts], r.a_cuts, [0, *r.b_cuts], r.b_cuts))
        assert [(r.a_ids[i:j], r.b_ids[k:m]) for i, j, k, m in cuts] == groups[r.doc_id]


def test_words_are_encoded_as_whole_texts(both):
    draw, load = random.Random(4), alignment.Tokenizers(both)
    assert load.apart
    texts = ["".join(draw.choice(" \n\t'sabXé日本\x1c\x85 ▁0 1.ﬁ𝒳🙂") for _ in range(40)) for _ in range(500)]
    texts += ["".join(draw.choice(" \n'sab1,") for _ in range(30)).replace("  ", " ").strip() for _ in range(2000)]
    a, b = load.encode(texts)
    assert a.to_pylist() == [e.ids for e in load.a.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]
    assert b.to_pylist() == load.b.encode(texts)


def odd(spark):
    data = [(None, None, None), (1, "a b c a b c", "en"), (1, "a b c a b c", "en"), (None, "a b a b", "und"), (2, "", None)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    for name in ("row", "pairs", "times", "n", "a", "ids", "slot", "word", "id", "stats", "y", "draw", "quality_score", "n_best"):
        frame = frame.withColumn(name, F.lit(7))
    return frame


def test_alignment_of_odd_rows(spark, both):
    frame = odd(spark)
    got = sorted((tuple(r) for r in alignment.alignment_report(frame, both).collect()), key=str)
    expected, _ = plain_alignment([r.text for r in frame.collect()])
    assert got == sorted(((r.doc_id, *e) for r, e in zip(frame.collect(), expected)), key=str)
    assert alignment.alignment_report(frame.limit(0), both).collect() == []


def plain_collocations(rows, least, most):
    counts, words_of = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            for n in range(1, 6):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        n, found = words_of[lang], []
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in often.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def phrase_rows():
    draw = random.Random(8)
    names = ["Aa", "b", "c", "é", "日本", "x-y", "\x01z", "l'un", "d"]
    rows = []
    for i in range(60):
        words = draw.choices(names, weights=range(1, 10), k=draw.randint(0, 80))
        rows.append(("".join(w + draw.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "! "]) for w in words), draw.choice(["en", None, "fr"])))
    return [*rows, *[("one two three four five six", "en")] * 5, (None, "en"), ("", None), (" \n.", "xx")]


@pytest.mark.parametrize("head,most,flush", [(400_000, 2000, 2_000_000), (3, 12, 40), (0, 5, 40)])
def test_collocations(spark, monkeypatch, head, most, flush):
    monkeypatch.setattr(collocations, "HELD_GRAMS", flush)
    monkeypatch.setattr(collocations, "HELD_WORDS", max(8, flush // 10))
    rows = phrase_rows()
    frame = spark.createDataFrame(rows, "text string, lang string").withColumn("ids", F.lit(1)).repartition(4)
    got = collocations.collocations(frame, least=4, most=most, head_words=head, salts=3)
    expected = plain_collocations(rows, 4, most)
    assert len(expected) > 10 and sorted(map(tuple, got.collect())) == expected


def test_collocations_of_odd_rows(spark):
    frame = odd(spark)
    got = collocations.collocations(frame, least=2)
    assert sorted(map(tuple, got.collect())) == plain_collocations([(r.text, r.lang) for r in frame.collect()], 2, 2000)
    assert collocations.collocations(frame.limit(0)).collect() == []
    assert collocations.collocations(frame).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 10**12
    words = spark.createDataFrame([("en", "a", 3 * big, 1), ("en", "b", 2 * big, 2)], "lang string, word string, n bigint, id bigint")
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n bigint")
    phrases = spark.createDataFrame([([1, 2], big + 7)], "ids array<int>, a bigint")
    import unittest.mock

    with unittest.mock.patch.object(collocations, "phrase_counts", lambda *a, **b: (words, totals, phrases)):
        assert collocations.collocations(words).first().score == 1000 * (big + 7) * 10**14 // (6 * big * big)


@pytest.mark.parametrize("bits,n", [(1, 2), (3, 5), (13, 5), (16, 4), (25, 5), (31, 3), (31, 5)])
def test_filters_give_back_what_they_hold(bits, n):
    random_ = np.random.default_rng(bits * n)
    cells = [random_.integers(0, 1 << bits, 5000, dtype=np.uint64) for _ in range(n)]
    scattered = collocations.permute(cells, bits)
    assert all((a == b).all() for a, b in zip(collocations.permute(scattered, bits, back=True), cells))
    limbs, widths = collocations.pack(scattered, bits), collocations.limb_bits(n, bits)
    assert all((a == b).all() for a, b in zip(collocations.unpack(limbs, n, bits), scattered))
    keys, counts = collocations.count_sorted(limbs)
    assert counts.sum() == 5000 and Counter(zip(*(k.tolist() for k in keys), counts.tolist())) == Counter((*key, c) for key, c in Counter(zip(*(x.tolist() for x in limbs))).items())
    counts = counts * random_.choice([1, 254, 255, 256, 10**12], len(counts))
    quotient = min(widths[0], 12)
    body = collocations.write_filter(keys, counts, widths, quotient, 0, 1 << quotient)
    back, sums = collocations.read_filter(body, widths)
    assert (sums == counts).all() and all((a == b).all() for a, b in zip(back, keys))
    if bits > 3:
        leading = collocations.leading(limbs[0], widths[0], 4)
        assert np.bincount(leading.astype(int), minlength=16).max() < 2 * 5000 / 16  # the permutation scatters


def test_statistics_are_plain_figures():
    got = dict(zip(rule_ensemble.STATISTICS, rule_ensemble.statistics("The cat, THE CAT!\nthe cat | a\n\nthe cat | a")))
    assert (got["chars"], got["words"], got["lines"], got["bars"], got["stops"]) == (42, 12, 3, 2 / 12, 1 / 12)
    assert got["repeated_lines"] == 1 / 3 and got["capital_words"] == 2 / 12 and got["distinct_words"] == 8 / 12 and got["one_letter_words"] == 4 / 12
    assert rule_ensemble.statistics(None) == rule_ensemble.statistics("") == [0.0] * len(rule_ensemble.STATISTICS)
    assert len(rule_ensemble.statistics(" \n")) == len(rule_ensemble.STATISTICS)


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, rule_ensemble.fit(docs, labels)


def test_rules_on_held_out_rows(judged):
    docs, labels, model = judged
    found = rule_ensemble.classifier_report(docs, labels).join(labels, "doc_id").where("held_out")
    rows = found.select("score", "quality", "predicted").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(bad) > 10 and np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert 0 < len(model.rules) + len(model.linear) < 80 and len(model.rules) > 0


def test_compiled_rules_give_the_margin(judged, spark):
    docs, _, model = judged
    rows = [(r.quality_score, r.text) for r in rule_ensemble.score_quality(docs, model).select("quality_score", "text").collect()]
    x = np.array([rule_ensemble.statistics(t) for _, t in rows])
    assert np.allclose([s for s, _ in rows], 1 / (1 + np.exp(-model.margin(x))), atol=1e-9)


def test_held_out_labels_are_not_learnt(judged):
    docs, labels, model = judged
    turned = labels.withColumn("quality", F.when(rule_ensemble.fold(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rule_ensemble.fit(docs, turned) == model
    assert rule_ensemble.fit(docs.unionByName(docs), labels.unionByName(labels)) == model


def test_rules_without_labels_and_odd_rows(spark, judged):
    docs, labels, model = judged
    frame = odd(spark)
    for some, score in ((labels.limit(0), 0.5), (labels.where("quality = 1").limit(9), None), (labels.withColumn("quality", F.lit(None).cast("int")), 0.5)):
        fitted = rule_ensemble.fit(docs, some)
        assert not fitted.rules and not fitted.linear
        got = rule_ensemble.score_quality(frame, fitted).collect()
        assert len(got) == 5 and all(0 <= r.quality_score <= 1 and r.stats == 7 for r in got)
        assert score is None or {r.quality_score for r in got} == {score}
    assert rule_ensemble.score_quality(frame.limit(0), model).collect() == []
    got = rule_ensemble.classifier_report(frame, labels.limit(0)).collect()
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]


def test_lasso_is_sparse_and_finds_the_signal():
    draw = np.random.default_rng(1)
    x = np.append(draw.normal(size=(800, 10)), np.ones((800, 1)), axis=1)
    y = (x[:, 0] - x[:, 1] + 0.3 * draw.normal(size=800) > 0).astype(float)
    w = rule_ensemble.lasso(x, y, 0.05)
    assert w[0] > 0.3 and w[1] < -0.3 and (np.abs(w[2:10]) < 1e-6).all()
