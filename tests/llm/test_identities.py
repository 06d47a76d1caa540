"""Rows that share or lack an id, and tables whose columns have the names that operators make."""

import os
import sys

import public_tokenizers
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
from test_operators import prose  # noqa: E402

from tickframe.llm import bpe, chunking, mixing, ngram_join, sharding  # noqa: E402

# Two pairs of words with one hash of 32 bits.
TWINS = ["w33552 q234864", "w238111 q1666777"]


def test_texts_without_ids_whose_short_hashes_meet(spark):
    frame = spark.createDataFrame([(None, t) for t in TWINS] + [(-1, TWINS[0]), (0, TWINS[1])], "doc_id bigint, text string")
    assert frame.select(F.hash("text")).distinct().count() == 1
    ranks, known = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), brute.tiktoken_encoding()
    got = sorted((str(r.doc_id), r.decoded_sha256, r.n_tokens) for r in bpe.bpe_report(frame, ranks, public_tokenizers.PATTERN, 0).collect())
    expected = [("None", t) for t in TWINS] + [("-1", TWINS[0]), ("0", TWINS[1])]
    assert got == sorted((i, brute.sha(t), len(known.encode_ordinary(t))) for i, t in expected)


def test_passages_are_cut_from_the_right_rows(spark):
    passage = prose(3, 200)
    texts = [(1, passage), (None, f"{prose(4, 50)} {passage}"), (None, f"{passage} {prose(5, 50)}"), (None, prose(6, 120))]
    frame = spark.createDataFrame(texts + texts[1:2], "doc_id bigint, text string")
    left = [(r.doc_id, r.text, r.dropped_bytes) for r in chunking.drop_repeats(frame).collect()]
    # Rows without an id are one owner, smaller than any id.
    assert len(left) == 5 and all(text in dict.fromkeys(t for _, t in texts) and not cut for i, text, cut in left if i is None)
    assert [cut > 500 for i, _, cut in left if i == 1] == [True]
    spans = chunking.repeated_spans(frame).collect()
    assert len({(r.doc_id, bytes(r.h), r.span_start) for r in spans}) == len(spans) and {r.n_docs for r in spans} == {3}


def test_one_row_of_a_component_stays(spark):
    base = prose(1, 120)
    near = " ".join([*base.split()[:119], "other"])
    data = [(7, base), (7, base), (7, "an other text of the same id"), (9, near), (None, base), (None, near)]
    data += [(None, prose(2, 90)), (None, prose(2, 90)), (None, prose(2, 90).upper()), (None, prose(3, 40)), (None, ""), (None, None), (8, " "), (8, " "), (12, "one two")]
    names = ("gone_id", "several_id", "row_hash", "row_place", "class_1", "class_label", "d1", "rows", "label", "n")
    frame = spark.createDataFrame(data, "doc_id bigint, text string").withColumns({n: F.lit(5) for n in names})
    kept = ngram_join.keep_representatives(frame)
    assert kept.columns == frame.columns
    found = sorted((str(r.doc_id), (r.text or "").lower()) for r in kept.collect())
    assert [i for i, _ in found].count("7") == 1 and ("9", near) not in found
    rest = [f for f in found if f[0] != "7"]
    assert rest == sorted([("None", prose(2, 90)), ("None", prose(3, 40)), ("None", ""), ("None", ""), ("8", " "), ("8", " "), ("12", "one two")])
    assert ngram_join.keep_representatives(frame.limit(0)).collect() == []


def test_names_that_operators_make(spark):
    names = ("own_shard", "bag_shard", "own_item", "bag_item", "group", "span_hash", "span_hash_own", "span_id", "mix_copy", "mix_of_mine", "gone_id")
    frame = spark.createDataFrame([(1, "a b c", "s"), (2, prose(1, 100), "s"), (3, prose(1, 100), None)], "doc_id bigint, text string, source string").withColumns({n: F.lit(5) for n in names})
    for made in (sharding.assign_shards(frame), chunking.drop_repeats(frame), mixing.repeat_taken(mixing.mix_sources(frame)), ngram_join.keep_representatives(frame)):
        rows = made.collect()
        assert rows and all(r[n] == 5 for r in rows for n in names)


def test_items_are_summed_in_many_tasks_and_divided_in_one(spark):
    frame = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), 5).alias("text"))
    groups = frame.groupBy(F.md5("text").alias("item")).agg(F.sum(F.length("text")).alias("size"))
    plan = sharding.balance(groups, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" not in plan and "RoundRobinPartitioning(1)" in plan or "SinglePartition" in plan


def test_a_run_of_the_pipeline_leaves_its_result_only(spark, tmp_path):
    import corpus_pipeline

    from tickframe.session import shared_dir

    def tables():
        folder = f"{shared_dir(spark)}/tickframe"
        return {n for n in (os.listdir(folder) if os.path.isdir(folder) else ()) if n.rsplit("-", 1)[0] in {k.replace(" ", "-") for k, _ in corpus_pipeline.STAGES}}

    before = tables()
    os.makedirs(tmp_path / "in")
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "in")).count() > 30
    assert {n.rsplit("-", 1)[0] for n in tables() - before} == {"encoding"}
