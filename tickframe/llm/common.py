"""Expressions that several operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and all other letters as they are; texts of ASCII alone take the faster function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def word_alternatives(words: Iterable[str]) -> str:
    """A regular expression for any of the words, which need no escapes; branches by first letter keep failures cheap."""
    by_letter: dict[str, list[str]] = {}
    for word in sorted(set(words), key=lambda w: (w[0], -len(w), w)):
        by_letter.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in by_letter.items())


def own_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def free_finished(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files and checkpoints that nothing refers to any more.

    It does so only when the driver collects garbage, by default every half hour; until then the files of finished jobs
    stay on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
