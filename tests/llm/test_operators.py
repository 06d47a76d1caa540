"""Operators against plain Python on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
import public_tokenizers  # noqa: E402

from tickframe.llm import bpe, chunking, graph, langid, license_scan, line_dedup, mixing, ngram_join, quality, sharding, simhash  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF_DIR = "/root/testdata/sf0.001"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 5))) for _ in range(n))


def rows():
    base = prose(1, 120)
    words = base.split()
    near = [" ".join(words[:i] + ["x%d" % i] + words[i + 1 :]) for i in range(0, 120, 10)]
    texts = [base, base.upper(), *near, None, "", " \n ", "one two", "ONE two", "the MIT License.", "see CC BY-NC 4.0, cc by cc by", prose(2, 3000)]
    texts += [f"Shared line\n{prose(10 + i, 20)}\n  shared LINE\t\n" for i in range(12)]
    texts += ["GNU General Public License, version 3.\nSPDX-License-Identifier: Apache-2.0", "a" * 5000, "  two  spaces \t\n\n x ", "l'été déjà vu, 12345 日本語 \u0558\U000323b0!"]
    return [(i * 7, t, ["en", None, "de"][i % 3], ["a", "b", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def texts():
    return {r[0]: r[1] for r in rows()}


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, and names that operators use themselves."""
    data = [(None, None, None, None), (1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (None, "x y", "en", "s"), (2, "", None, None)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string")
    for name in ("plain", "words", "letters", "group", "of_text", "mix_hash", "threshold", "key", "size", "shard", "line", "h", "start", "fingerprint"):
        frame = frame.withColumn(name, F.lit(7))
    return frame


def test_licenses(docs, texts):
    rules = license_scan.default_rules()
    for r in license_scan.license_report(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(texts[r.doc_id])
        standing = brute.license_hits(texts[r.doc_id], rules)[1]
        labels = {rules[d[3]].label for d in standing} | {x for x in r.base_labels.split(",") if x}
        assert (r.labels, r.n_hits) == (",".join(sorted(labels)), len(standing))


def alternatives(tree):
    """Some texts that a parsed pattern matches: every branch, with and without every optional part."""
    out = [""]
    for kind, value in tree:
        name = str(kind)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "IN":
            more = ["1"] if str(value[0][0]) == "CATEGORY" else [chr(v) for _, v in value]
        elif name == "ANY":
            more = ["x"]
        elif name == "BRANCH":
            more = [x for branch in value[1] for x in alternatives(branch)]
        elif name == "SUBPATTERN":
            more = alternatives(value[3])
        else:
            assert name in ("MAX_REPEAT", "MIN_REPEAT")
            more = [*([""] if value[0] == 0 else []), *alternatives(value[2])]
        out = [a + b for a in out for b in more]
    return out


def test_keywords_cover_every_alternative():
    from re import _parser

    for rule in license_scan.default_rules():
        for text in alternatives(_parser.parse(rule.pattern)):
            assert not text.endswith(" "), rule
            assert set(text.split()) & set(rule.keywords), (rule, text)


def test_licenses_without_gate(spark):
    texts = ["GPL3", "uses GPL2 code", "the beerware license", "FreeBSD license", "licensed under the FreeBSD license", "an MIT style license here", "MIT-style licence", "for noncommercial use only", "the licence terms", "nothing"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rules = license_scan.default_rules()
    for r in license_scan.license_report(frame).collect():
        standing = brute.license_standing_ungated(texts[r.doc_id], rules)
        assert (r.labels, r.n_hits) == (",".join(sorted({rules[n].label for n in standing})), len(standing))
        assert (r.n_hits > 0) == (texts[r.doc_id] != "nothing")


def test_bpe(docs, texts, spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    known = brute.tiktoken_encoding()
    for head in (0, 40, bpe.HEAD_WORDS):
        found = {r.doc_id: r for r in bpe.bpe_report(docs, ranks, public_tokenizers.PATTERN, head).collect()}
        for i, t in texts.items():
            ids = known.encode_ordinary(t or "")
            assert (found[i].n_tokens, found[i].ids_sha256) == (len(ids), brute.sha(",".join(map(str, ids))))
            assert found[i].decoded_sha256 == brute.sha(t or "")
    encoded = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode_documents(encoded, ranks).collect()} == {i: t or "" for i, t in texts.items()}


def test_bpe_merges():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    r = random.Random(3)
    for n in (1, 2, 30, 65, 400):
        word = bytes(r.choice(b"abcdethenionrs") for _ in range(n))
        assert bpe.merge_word(word, ranks) == bpe.merge_long_word(word, ranks) == brute.tiktoken_encoding().encode_ordinary(word.decode())


def test_texts_are_cut_once_and_moved_once(spark):
    """Both sides of the last join read one exchange; before, texts were cut for the known ids and again for the other words."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    known = brute.tiktoken_encoding()
    texts = [None, "", " ", "\0 \0", "thequick the, ñandú Ωmega x y", "one\n two  three", "zq" * 5000, " ".join(f"w{i}q the" for i in range(5000)), "the " * 300]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[4]), (3, texts[4]), (None, texts[4]), (None, "the 'other' one"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    for head in (0, 300, bpe.HEAD_WORDS, 9):
        report = bpe.bpe_report(frame, ranks, public_tokenizers.PATTERN, head)
        wanted = []
        for i, t in rows:
            ids = known.encode_ordinary(t or "")
            wanted.append((str(i), len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t or "")))
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in report.collect()) == sorted(wanted)
    report.write.format("noop").mode("overwrite").save()
    rows_of = report._jdf.queryExecution()
    rows_of.executedPlan().execute().count()
    assert "ReusedExchange" in rows_of.executedPlan().toString()


def test_codes():
    numbers = [1, 127, 128, 300, 16383, 16384, 70000]
    codes = bpe.word_codes(70000)
    found, ends = bpe.read_codes(b"\0".join(codes[n - 1] for n in numbers))
    assert found[::2].tolist() == numbers and not found[1::2].any() and len(ends) == 13
    packed = b"".join(bpe._short(x) + bpe._short(len(y)) + y for x, y in ((0, b"ab"), (129, b""), (4096, b"c" * 5000)))
    assert bpe._unpacked([packed]) == {0: b"ab", 129: b"", 4096: b"c" * 5000}
    assert bpe._unpacked([]) == {}


def test_quality(docs, texts):
    for r in quality.quality_report(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality_base(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def written(seed, n, letters, common=()):
    r = random.Random(seed)
    return " ".join(r.choice(common) if common and r.random() < 0.4 else "".join(r.choice(letters) for _ in range(r.randint(3, 8))) for _ in range(n))


def test_quality_keeps_rare_scripts_and_fails_word_salad(spark):
    latin, english = "abcdefghijklmnopqrstuvwxyz", quality.COMMON_WORDS["en"]
    data = [(i, written(i, 300, latin, english), "en") for i in range(300)]
    data += [(1000, written(1000, 300, "的一是不了人我在有他这为之大来以个中上们"), "zh"), (1001, written(1001, 300, "ابتثجحخدذرزسشصضطظعغ"), None)]
    data += [(1002, written(1002, 300, "абвгдежзиклмнопрст"), None), (1003, written(1003, 300, "абвгдежзиклмнопрст"), "ru")]
    data += [(2000, written(2000, 300, latin), "en"), (2001, written(2001, 3000, latin), None), (2002, "0123456789 " * 60, "en")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in quality.quality_report(frame).collect()}
    assert not found[2000].kept and not found[2001].kept and not found[2000].base_failed and not found[2001].base_failed
    assert all(r.kept for i, r in found.items() if i < 2000)
    assert not found[2002].kept


def test_mixing_reaches_targets(docs):
    found = mixing.mix_sources(docs).collect()
    by = {}
    for r in found:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.mix_copies <= 3
    total = sum(r.mix_size for r in found)
    assert abs(sum(v[0].mix_target for v in by.values()) - total) < 1e-6 * total
    for v in by.values():
        assert v[0].mix_target <= 3 * v[0].mix_source_size
        assert abs(sum(r.mix_size * r.mix_copies for r in v) - v[0].mix_target) <= max(r.mix_size for r in v) / 2 + 1
    assert sum(r.mix_copies for r in found) == mixing.repeat_taken(mixing.mix_sources(docs)).count()


def test_sharding(docs, texts):
    found = sharding.shard_report(docs, 4).collect()
    group, slots, sizes = {}, {}, {}
    for r in found:
        t = texts[r.doc_id] or ""
        assert r.size == len(t.encode()) + 8
        assert group.setdefault(t, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    draw = random.Random(5)
    numbers = [draw.randint(1, 1000) for _ in range(200)]
    sums = [0] * 7
    for n, s in zip(numbers, sharding.difference_items(numbers, 7)):
        sums[s] += n
    assert max(sums) - min(sums) <= 3


def test_line_dedup(docs, texts):
    order = list(texts)
    expected = dict(zip(order, brute.line_dedup([texts[i] for i in order])))
    for r in line_dedup.line_report(docs).collect():
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == expected[r.doc_id]


def test_simhash(docs, texts, spark):
    edits = brute.edited(list(texts.items()))
    found = simhash.edit_report(docs).collect()
    assert len(found) == len(texts)
    prints = {}
    for r in found:
        assert (r.n_chars, r.edited_sha256) == (edits[r.doc_id][0], brute.sha(edits[r.doc_id][1]))
        assert prints.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint
    keys = sorted({r.fingerprint for r in found})
    table = spark.createDataFrame([(k,) for k in keys], "fingerprint string")
    got = {(r.query, r.found) for r in simhash.find_near(table, table, radius=6).collect()}
    assert got == {(a, b) for a in keys for b in keys if (int(a, 16) ^ int(b, 16)).bit_count() <= 6}


def test_chunks(spark):
    passage = prose(99, 60)
    data = [(i, f"{prose(200 + i, 80)} {passage} {prose(300 + i, 80)}") for i in range(5)] + [(9, prose(77, 300)), (10, None)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    spans = chunking.repeated_spans(frame).collect()
    assert {r.doc_id for r in spans} == set(range(5))
    assert {r.doc_id for r in spans if r.is_first} == {0}
    cleaned = {r.doc_id: r for r in chunking.drop_repeats(frame).collect()}
    assert cleaned[0].text == data[0][1] and cleaned[9].text == data[5][1] and cleaned[10].text is None
    assert all(cleaned[i].dropped_bytes >= 80 for i in range(1, 5))
    body = (prose(5, 4000)).encode()
    ends = chunking.boundaries(body)
    assert ends[-1] == len(body) and all(0 < b - a <= chunking.MOST for a, b in zip([0, *ends], ends))


def test_chunks_stay_with_their_owner(spark):
    x, y, z = prose(401, 80), prose(402, 80), prose(403, 80)
    data = [(1, f"{prose(411, 80)} {x} {y} {prose(412, 80)}"), (5, f"{prose(413, 80)} {x} {y} {z} {prose(414, 80)}"), (9, f"{prose(415, 80)} {y} {z} {prose(416, 80)}")]
    data.append((12, data[1][1]))
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    cleaned = {r.doc_id: r for r in chunking.drop_repeats(frame).collect()}
    for passage in (x, y, z):
        middle = passage[130:-130]
        assert [i for i, r in sorted(cleaned.items()) if middle in r.text] == [5 if passage == z else 1]
    whole = {i: data for i, data in data}

    def held(text):
        body, out, at = text.encode(), set(), 0
        for end in chunking.boundaries(body):
            out.add(body[at:end])
            at = end
        return out

    kept = set().union(*(held(t) for t in whole.values()))
    assert all(any(c in r.text.encode() for r in cleaned.values()) for c in kept)
    assert any(r.is_first for r in chunking.repeated_spans(frame).where("doc_id = 5").collect())
    report = chunking.span_report(frame).collect()
    assert {(r.doc_id, r.dropped_bytes, r.kept_sha256) for r in report} == {(i, r.dropped_bytes, brute.sha(r.text)) for i, r in cleaned.items()}


def test_chunk_counts_are_of_documents(spark):
    passage = prose(420, 120)
    texts = {1: f"{passage} {passage} {passage}", 2: f"{prose(421, 60)} {passage}"}
    frame = spark.createDataFrame([*texts.items(), (2, texts[2])], "doc_id bigint, text string")
    assert {r.n_docs for r in chunking.repeated_spans(frame).collect()} == {2}


def test_language_on_held_out_rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.language_report(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1))).first()
    assert n > 100 and right > 0.97
    assert found.where("rejected").count() <= 0.03 * n


def test_every_language_is_learnt(spark):
    data = [(70 * k + n, " ".join(written(1000 * n + k + i, 12, chr(0x4E00 + 8 * n) + chr(0x4E01 + 8 * n)) for i in range(3)), f"l{n:02}") for n in range(70) for k in range(6)]
    data += [(9000 + i, "zq zqq qz", "l70") for i in range(8)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    for total in (langid.SAMPLE_TOTAL, 71):
        model = langid.fit(frame, total=total)
        assert model.languages == [f"l{n:02}" for n in range(71)]
    assert langid.fit(frame.limit(0)) is None


def test_ngram_join(docs, texts, monkeypatch):
    expected = brute.components(list(texts.items()))
    for common, longest in ((64, 12), (3, 4), (1, 1)):
        monkeypatch.setattr(ngram_join, "COMMON", common)
        monkeypatch.setattr(ngram_join, "LONGEST", longest)
        got = sorted(map(tuple, ngram_join.similar_classes(docs).select("doc_id", "n_shingles", "component_id").collect()))
        assert got == expected


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 103: 100}


def reports():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return {
        "licenses": license_scan.scan_licenses,
        "license report": license_scan.license_report,
        "bpe": lambda d: bpe.bpe_report(d, ranks, public_tokenizers.PATTERN),
        "quality": quality.judge_quality,
        "mixing": mixing.mix_sources,
        "shards": sharding.assign_shards,
        "shard report": sharding.shard_report,
        "lines": line_dedup.drop_frequent_lines,
        "fingerprints": simhash.fingerprint,
        "edits": simhash.edit_report,
        "chunks": chunking.drop_repeats,
        "languages": lambda d: langid.predict(d, langid.fit(d)),
        "classes": ngram_join.similar_classes,
    }


@pytest.mark.parametrize("name", list(reports()))
def test_odd_and_empty_tables(odd, name):
    run = reports()[name]
    assert len(run(odd).collect()) == 5
    assert run(odd.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op4_mixing", "op6_line_dedup"])
def test_query_matches_sql(spark, name):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from compare import connect, difference

    from tickframe.llm.queries import QUERIES

    assert difference(spark, connect(SF_DIR), SF_DIR, name, QUERIES[name]) is None


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages, outputs = dict(corpus_pipeline.STAGES), []
    for name, stage in stages.items():
        docs = stage(spark, docs, SF_DIR).checkpoint()
        outputs.append(docs.collect())
        if name != "encoding":
            assert docs.columns == corpus_pipeline.COLUMNS
    raw = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    languages, lines, apart, mixed, encoded = outputs
    assert 0.9 * len(raw) <= len(languages) <= len(raw)
    expected = brute.line_dedup([r.text for r in languages])
    by_id = {r.doc_id: r for r in lines}
    assert all(brute.sha(by_id[r.doc_id].text or "") == e[2] for r, e in zip(languages, expected))
    components = brute.components([(r.doc_id, r.text) for r in lines])
    assert {r.doc_id for r in apart} == {c for _, _, c in components} and len(apart) == len({r.doc_id for r in apart})
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in apart}
    known = brute.tiktoken_encoding()
    assert sorted((r.doc_id, r.n_tokens) for r in encoded) == sorted((r.doc_id, len(known.encode_ordinary(r.text or ""))) for r in mixed)
