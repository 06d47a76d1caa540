"""The operators of this package as registered queries over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickframe.llm import alignment, bpe, chunking, collocations, langid, license_scan, line_dedup, mixing, ngram_join, quality, rule_ensemble, sharding, simhash

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.bpe_report(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.selectExpr("doc_id", "mix_size AS size", "mix_source_size AS source_size", "mix_target AS target", "mix_size * mix_copies AS taken")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edit_report(documents(spark, sf_dir))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.span_report(documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(documents(spark, sf_dir))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_classes(documents(spark, sf_dir))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classifier_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = alignment.read_vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.alignment_report(documents(spark, sf_dir), both)


MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source
),
w AS (SELECT *, CASE place % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight FROM s),
r AS (
  SELECT *, 3.0::DOUBLE * source_size / weight AS stop,
         coalesce(sum(source_size * 3) OVER (ORDER BY 3.0::DOUBLE * source_size / weight RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS capped,
         sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total
  FROM w
),
l AS (SELECT (total - capped) / free AS level FROM r WHERE stop >= (total - capped) / free ORDER BY stop LIMIT 1),
t AS (SELECT source, source_size, least(CAST(source_size * 3 AS DOUBLE), weight * level) AS target FROM r, l),
p AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS here
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
b AS (SELECT *, floor(target - whole * source_size) AS budget FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN upto <= budget OR (upto - here <= budget AND 2 * (budget - (upto - here)) >= here) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM b
"""

_KEY = r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LINES_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT r, place, line, {_KEY} AS key FROM x),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT r, place, line, key IN (SELECT key FROM f) AS gone FROM k),
g AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS kept
  FROM m GROUP BY r
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256
FROM g JOIN d USING (r)
"""

_MARKS = r"[.,;:!?\x0A-\x0D]"
COLLOCATIONS_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_MARKS}')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM d),
t AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
s AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT lang, words, i, unnest(range(1, least(5, len(words) - i + 1) + 1)) AS m FROM s),
f AS (SELECT lang, words[i : i + m - 1] AS phrase, CAST(count(*) AS BIGINT) AS a FROM g GROUP BY 1, 2 HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE len(phrase) > 1),
x AS (SELECT lang, a, phrase, unnest([phrase[:-2], phrase[2:]]) AS part FROM c WHERE len(phrase) > 2),
h AS (SELECT lang, part, max(a) AS around FROM x GROUP BY 1, 2),
k AS (SELECT c.lang, c.phrase, c.a, unnest(range(1, len(c.phrase))) AS k FROM c LEFT JOIN h ON h.lang = c.lang AND h.part = c.phrase WHERE around IS NULL OR around < c.a),
q AS (
  SELECT k.lang, k.phrase, k.a, k.k, l.a AS l, r.a AS r, t.n, (k.a::HUGEINT * t.n * 1000) // (l.a::HUGEINT * r.a) AS score
  FROM k JOIN t USING (lang) JOIN f l ON l.lang = k.lang AND l.phrase = k.phrase[1 : k.k] JOIN f r ON r.lang = k.lang AND r.phrase = k.phrase[k.k + 1 :]
),
b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT *, array_to_string(phrase, ' ') AS spelled FROM b)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, spelled) AS rank, spelled AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM o
QUALIFY rank <= 2000
"""

QUERIES: dict[str, Query] = {
    "op1_license_scan": Query(op1_license_scan),
    "op2_bpe": Query(op2_bpe),
    "op3_quality": Query(op3_quality),
    "op4_mixing": Query(op4_mixing, MIXING_SQL),
    "op5_sharding": Query(op5_sharding),
    "op6_line_dedup": Query(op6_line_dedup, LINES_SQL),
    "op7_simhash": Query(op7_simhash),
    "op8_chunk_dedup": Query(op8_chunk_dedup),
    "op9_language": Query(op9_language),
    "op10_ngram_join": Query(op10_ngram_join),
    "op11_quality_rules": Query(op11_quality_rules),
    "op12_collocations": Query(op12_collocations, COLLOCATIONS_SQL),
    "op13_alignment": Query(op13_alignment),
}
