"""What operators may not do again for every row, pair or word, with results against plain Python."""

import os
import re
import sys

import numpy as np
import regex
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from tickframe import session  # noqa: E402
from tickframe.llm import graph, line_dedup, ngram_join, quality  # noqa: E402

ODD = [
    None,
    "",
    "The cat, the dog and THE_the 4the thé thé für fur Más",
    "a a a b a a a b",
    "one two three one two three four one two three",
    "el la los el-la l'est d'un\nder Die DAS \U0001d5ba the\U0001d5ba no1no",
    "x " * 40 + "of to in " * 7,
]


def plain_counts(text, words):
    runs = regex.findall(r"\p{L}+", (text or "").lower())
    return [runs.count(w) for w in words]


def plain_repeats(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_common_words_are_not_searched_one_by_one(spark):
    frame = spark.createDataFrame(list(enumerate(ODD)), "doc_id int, text string")
    measured = quality.measure_quality(frame)
    words = quality.common_words()
    for row in measured.collect():
        text = ODD[row.doc_id]
        assert list(row.quality_common)[:-1] == plain_counts(text, words)
        assert row.quality.n_repeat_words == plain_repeats(text)
    # A text without repeated windows sorts none, and the list of words is not cut out of the text word by word.
    plan = frame.select(quality._common_counts(F.col("text"), F.lit(0), words))._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(" not in plan and "array_remove" in plan
    assert "array_distinct" in frame.select(quality._repeat_words(F.split("text", " ")))._jdf.queryExecution().optimizedPlan().toString()


def test_near_misses_do_not_become_rows_of_the_join(spark):
    """Sets that share most of their shingles and still too few: their sketches differ by more than links may."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 300)
    sets = [np.concatenate([base[:265], rng.integers(0, 1 << 62, 35)]) for _ in range(40)]  # 265 of 335, 0.79
    sets += [np.concatenate([base[:260], rng.integers(0, 1 << 62, 40)]) for _ in range(40)]  # 0.76 or less
    sets += [np.concatenate([base[:290], rng.integers(0, 1 << 62, 10)]) for _ in range(5)]  # 0.93
    flat = np.concatenate(sets).astype("<i8")
    bits = ngram_join._sketches(flat, np.array([len(s) for s in sets], np.int32)).to_pylist()
    frame = spark.createDataFrame([(i, 300, b) for i, b in enumerate(bits)], "cid long, n int, bits array<bigint>")
    x, y = (frame.select(*[F.col(c).alias(f"{s}_{c}") for c in frame.columns]) for s in "xy")
    met = {(r.x_cid, r.y_cid) for r in x.join(y, F.col("x_cid") < F.col("y_cid")).where(ngram_join._fits("x_", "y_")).select("x_cid", "y_cid").collect()}
    assert {(i, j) for i in range(80, 85) for j in range(i + 1, 85)} <= met  # a link is never lost
    assert sum(i >= 40 and j < 80 for i, j in met) <= 0.1 * 40 * 39 / 2
    folded = frame.select(ngram_join._folded("bits").alias("bits")).collect()
    assert [list(r.bits) for r in folded] == [np.bitwise_xor.reduce(np.array(b).reshape(-1, ngram_join.FIRST_WORDS)).tolist() for b in bits]


def test_shared_shingles_are_not_sent_to_the_driver(spark, monkeypatch):
    """They grow with the documents; a table of them may be small enough to broadcast only where there are few."""
    sent, keep = [], ngram_join.small_side
    monkeypatch.setattr(ngram_join, "small_side", lambda df, *limit: sent.append(df.columns) or keep(df, *limit))
    texts = [" ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(61)), "other words " * 3]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.component_id for r in ngram_join.similar_classes(frame).collect()) == [0, 0, 2]
    assert sent and not [columns for columns in sent if "df" in columns]


def jobs_of(spark, name, run):
    """The result of ``run``, and how many jobs and tasks it took."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        result = run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    tracker = context.statusTracker()
    jobs = tracker.getJobIdsForGroup(name)
    stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    return result, len(jobs), sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)


def test_rounds_over_a_small_graph_take_few_tasks(spark):
    """Rounds were dealt over all partitions however small the graph (42 tasks here), and a job of its own compared them."""
    edges = spark.createDataFrame([(2 * i + 1, 2 * i) for i in range(300)] + [(1, 3)], "a bigint, b bigint")
    got, _, tasks = jobs_of(spark, "components", lambda: {r.node: r.label for r in graph.components(edges).collect()})
    assert got == {n: 0 if n < 4 else n - n % 2 for n in range(600)}
    assert tasks < 40


def test_rows_are_counted_while_they_are_written(spark):
    rows = spark.range(1000).where("id % 10 = 0")
    _, cut, _ = jobs_of(spark, "cut", lambda: session.cut_lineage(rows))
    small, jobs, _ = jobs_of(spark, "small", lambda: session.small_side(rows))
    assert jobs == cut
    large, _, _ = jobs_of(spark, "large", lambda: session.small_side(rows, 99))
    hinted = ["ResolvedHint" in f._jdf.queryExecution().analyzed().toString() for f in (small, large)]
    assert hinted == [True, False] and small.count() == large.count() == 100
    empty, measured = session.cut_and_measure(rows.where("id < 0"), rows=F.count(F.lit(1)), most=F.max("id"))
    assert measured == {"rows": 0, "most": None} and not empty.count()


def test_lines_do_not_carry_their_text(spark, monkeypatch):
    """What is made of the whole text is made once for each row, before its lines are."""
    plans = []
    for name in ("cut_lineage", "small_side"):
        keep = getattr(line_dedup, name)
        monkeypatch.setattr(line_dedup, name, lambda df, keep=keep: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    texts = [f"Shared line\nown {i}\n\n shared LINE\t" for i in range(12)] + [None, "", "\n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = sorted(map(tuple, line_dedup.line_report(frame).select("doc_id", "n_lines", "n_dropped").collect()))
    assert got == [(i, 4, 2) for i in range(12)] + [(12, 1, 0), (13, 1, 0), (14, 2, 0)]
    carried = [held for plan in plans for held in re.findall(r"\[([^\[\]]*)\], (?:true|false), \[", plan)]
    assert len(carried) >= 2 and not [held for held in carried if "text" in held]


def test_pipeline_hands_small_batches_to_python(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    import pyarrow as pa

    def sizes(spark, docs, sf_dir):
        return docs.mapInArrow(lambda batches: (pa.record_batch([pa.array([b.num_rows], pa.int64())], ["doc_id"]) for b in batches), "doc_id bigint")

    spark.range(2500).toDF("doc_id").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", sizes)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [500, 1000, 1000]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
