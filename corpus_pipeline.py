"""A training corpus from raw documents in five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickframe.llm import bpe, langid, line_dedup, mixing, ngram_join
from tickframe.session import new_path, remove_own, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises; it learns from the labelled ones among them."""
    return langid.predict(docs, langid.fit(docs)).where("NOT lang_rejected").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share are taken out of the texts."""
    cleaned = line_dedup.drop_frequent_lines(docs)
    return cleaned.selectExpr("doc_id", "text", "lang", "source", "CASE WHEN line_drops > 0 THEN CAST(length(text) AS BIGINT) ELSE n_chars END AS n_chars")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_representatives(docs).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by their weights; a document taken twice or three times is there as often."""
    return mixing.repeat_taken(mixing.mix_sources(docs)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded bytes of every document."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.bpe_report(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("lines", lines),
    ("near copies", near_copies),
    ("mixing", mix),
    ("encoding", encode),
]

# The language model and the encoding have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        with small_batches(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            # The next table is written, so this one is not read again.
            remove_own(spark, before)
        before = path
    return docs
