"""Line deduplication over levelled sorted runs of line hashes.

Every document gives each of its distinct line keys once. Documents come in batches. A batch first drops, by a merge
anti-join with the runs, the keys that are already known to be frequent, then adds the counts of the others as a run of
its own. When a level holds ``fan_in`` runs they are merged into one run of the next level, so the number of runs grows
with the logarithm of the number of batches. Runs are bucketed tables sorted by key: joins and merges of runs move
nothing. After the last batch one merge over all runs gives the frequent keys; the counts are exact.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm.common import WHITE, ascii_lower, let, own_name, text_of
from tickframe.session import cut_lineage, small_side


def line_key(line: Column) -> Column:
    """A line without surrounding white space. A-Z are put into lower case before, in the whole text at once."""
    return F.btrim(line, F.lit(WHITE))


def _lowered_lines(text: str) -> Column:
    return F.split(ascii_lower(text_of(text)), "\n", -1)


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value))


class LineRuns:
    """Runs of (key, docs) in levels, kept as bucketed tables of the session's warehouse."""

    def __init__(self, spark: SparkSession, min_docs: int, buckets: int, fan_in: int = 2):
        self.spark, self.min_docs, self.buckets, self.fan_in = spark, min_docs, buckets, fan_in
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, counts: DataFrame, level: int) -> None:
        table = f"{self.name}_{self.written}"
        self.written += 1
        counts.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key").saveAsTable(table)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table)

    def _merged(self, tables: list[str]) -> DataFrame:
        runs = self.spark.table(tables[0])
        for table in tables[1:]:
            other = self.spark.table(table).withColumnRenamed("docs", "more")
            runs = runs.join(other, "key", "full").select("key", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"))
        return runs

    def tables(self) -> list[str]:
        return [table for level in self.levels for table in level]

    def add(self, batch: DataFrame) -> None:
        """Add a batch of (key, docs) with distinct keys."""
        for table in self.tables():
            frequent = self.spark.table(table).where(F.col("docs") >= self.min_docs).select("key")
            batch = batch.join(frequent.hint("merge"), "key", "left_anti")
        self._write(batch, 0)
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)
            self._drop(full)
            level += 1

    def frequent(self) -> DataFrame:
        """Keys found in at least ``min_docs`` documents over all batches."""
        return self._merged(self.tables()).where(F.col("docs") >= self.min_docs).select("key")

    def _drop(self, tables: list[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table} PURGE")

    def close(self) -> None:
        self._drop(self.tables())


def _line_keys(docs: DataFrame, keys: Column, text: str, doc_id: str, batches: int) -> DataFrame:
    """``batch`` and ``key`` of each distinct line key of every row."""
    # The batch is made before the lines, else every line would carry its whole text and measure it again.
    batch = F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.length(text_of(text))), F.lit(batches)).cast("int")
    held = docs.select(batch.alias("batch"), F.array_distinct(keys).alias("lines"))
    return held.select("batch", F.explode_outer("lines").alias("line")).where("line IS NOT NULL").select("batch", _digest(F.col("line")).alias("key"))


def _line_places(docs: DataFrame, text: str) -> DataFrame:
    """``of``, the digest of the text, ``place`` and ``key`` of all lines; the digest is made once for each row."""
    held = docs.select(_digest(text_of(text)).alias("of"), _lowered_lines(text).alias("lines"))
    return held.select("of", F.posexplode_outer("lines").alias("place", "line")).select("of", "place", _digest(line_key(F.col("line"))).alias("key"))


def frequent_lines(docs: DataFrame, text: str, doc_id: str, min_docs: int, min_chars: int, batches: int) -> DataFrame:
    """Digests of the line keys that at least ``min_docs`` documents hold."""
    spark = docs.sparkSession
    keys = F.filter(F.transform(_lowered_lines(text), line_key), lambda k: F.length(k) >= min_chars)
    staged = cut_lineage(_line_keys(docs, keys, text, doc_id, batches).groupBy("batch", "key").agg(F.count(F.lit(1)).alias("docs")))
    runs = LineRuns(spark, min_docs, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        for batch in range(batches):
            runs.add(staged.where(F.col("batch") == batch).select("key", "docs"))
        return cut_lineage(runs.frequent())
    finally:
        runs.close()


def drop_frequent_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = 10, min_chars: int = 1, batches: int = 4
) -> DataFrame:
    """``docs`` with frequent lines taken out of the text, and ``line_count`` and ``line_drops`` (lines before, and gone).

    Lines are split at the line feed; a null or empty text is one empty line, and null stays null. A key of at least
    ``min_chars`` code points found in at least ``min_docs`` rows loses all its lines; a key counts once in a row however
    often it occurs there. Repeated rows count as rows. Other lines stay in order; if none stays the text is empty.
    """
    frequent = frequent_lines(docs, text, doc_id, min_docs, min_chars, batches)
    # Which lines go depends on the text alone, so places are gathered and joined by the text's digest.
    hits = _line_places(docs, text).join(small_side(frequent), "key", "left_semi").groupBy("of").agg(F.sort_array(F.collect_set("place")).alias("places"))
    of, gone = own_name(docs, "of_text"), own_name(docs, "gone_places")
    hits = small_side(hits.toDF(of, gone))
    kept = [c for c in docs.columns if c not in ("line_count", "line_drops")]
    marked = docs.select(*[F.col(f"`{c}`") for c in kept], _digest(text_of(text)).alias(of)).join(hits, of, "left")
    lines = F.split(text_of(text), "\n", -1)

    def stays(lines: Column) -> Column:
        edges = F.concat(F.array(F.lit(-1)), F.col(gone), F.array(F.size(lines)))
        return let(
            edges,
            lambda e: F.flatten(
                F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda k: F.slice(lines, F.get(e, k - 1) + 2, F.get(e, k) - F.get(e, k - 1) - 1))
            ),
        )

    cleaned = F.when(F.col(gone).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(let(lines, stays), "\n"))
    return marked.select(
        *[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in kept],
        F.size(lines).cast("bigint").alias("line_count"),
        F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias("line_drops"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    done = drop_frequent_lines(docs.select("doc_id", "text"))
    return done.select("doc_id", F.col("line_count").alias("n_lines"), F.col("line_drops").alias("n_dropped"), F.sha2(text_of(), 256).alias("kept_sha256"))
