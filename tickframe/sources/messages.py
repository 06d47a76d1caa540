"""Tick messages: any source that yields a ``value`` column (a topic, or files in tests)."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topic: str,
    starting: str | dict = "earliest",
    ending: str | dict | None = None,
    fail_on_data_loss: bool = False,
) -> dict:
    """Options of a topic. ``starting`` and ``ending`` are ``earliest``, ``latest``, or offsets by partition; an ending
    bounds a table, and a stream has none: its own checkpoint says where it goes on."""

    def offsets(where: str | dict) -> str:
        return where if isinstance(where, str) else json.dumps({topic: {str(k): v for k, v in where.items()}})

    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets(starting),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    return {**options, "endingOffsets": offsets(ending)} if ending is not None else options


def read_messages(
    spark: SparkSession, format: str = "kafka", path: str | None = None, schema=None, **options
) -> DataFrame:
    """All retained messages as a bounded table."""
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def stream_messages(
    spark: SparkSession, format: str = "kafka", path: str | None = None, schema=None, **options
) -> DataFrame:
    """The same source as an unbounded table; offsets live in the query's checkpoint."""
    reader = spark.readStream.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


NULL_KEYS = "null_keys"


def parse_documents(texts: DataFrame, keys: Iterable[str], column: str = "value") -> DataFrame:
    """JSON texts as a ``symbol`` and some ``keys``, each as text, ``null_keys`` and ``document``, the text itself.

    ``null_keys`` names the wanted keys that a document has with a null, so they can be told from those it lacks. Numbers
    are parsed where they are used. What is no JSON object has nulls only.
    """
    wanted = list(dict.fromkeys(["symbol", *keys]))
    fields = F.from_json(F.col(column).cast("string"), "map<string,string>")
    # A generator's output is computed once, however many columns take from it.
    rows = texts.select(F.col(column).cast("string").alias("document"), F.inline(F.array(F.struct(fields.alias("_fields")))))
    named = F.array(*[F.lit(key) for key in wanted])
    empty = F.filter(named, lambda key: F.map_contains_key(F.col("_fields"), key) & F.col("_fields")[key].isNull())
    nulls = F.coalesce(empty, F.array().cast("array<string>")).alias(NULL_KEYS)
    return rows.select(*[F.col("_fields")[key].alias(key) for key in wanted], nulls, "document")


def read_documents(spark: SparkSession, path: str, keys: Iterable[str]) -> DataFrame:
    """JSON documents, one a line, as ``parse_documents`` gives them."""
    return parse_documents(spark.read.text(path), keys)
