"""Language identification: averaged hashed subword embeddings with a linear softmax.

Character n-grams of the letters of a text are hashed into buckets; each bucket has an embedding, a text is the average
of its embeddings, and a linear softmax gives the languages. The model is trained by stochastic gradient descent in
numpy on a bounded sample of labelled rows, with steps that adapt to each weight, and its probabilities are calibrated
on rows left out of the training. A softmax shares its whole probability among the languages it knows, so it cannot tell
a text in none of them. Rejection therefore asks how well the n-grams of a text fit those of its language in the sample:
their cross entropy, less that of the language's own texts, against the spread expected for a text of its length. Texts
beyond nearly all of the labelled ones are rejected. Prediction runs over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickframe.llm.common import own_name, text_of

BUCKETS, DIMENSIONS, LONGEST = 1 << 13, 16, 4
# Rows of one language, and of all languages together, that the model learns from; a language has one row at least.
SAMPLE_PER_LANGUAGE, SAMPLE_TOTAL = 600, 12_000
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # embeddings times the linear layer: one row of scores for each bucket
    bias: np.ndarray
    temperature: float
    profile: np.ndarray  # logarithm of the share of each bucket in the sample's texts of each language
    entropy: np.ndarray  # mean cross entropy of a language's own texts
    spread: tuple[float, float]  # variance of a text's cross entropy: a part that shrinks with its length, and the rest
    limit: float  # distances above it are rejected

    def judge(self, counts: np.ndarray) -> tuple[int, float, float]:
        """The most probable language, its probability, and how far the text is from that language's own texts."""
        n = counts.sum()
        p = _softmax((counts.astype(np.float32) @ self.weights / n + self.bias) / self.temperature)
        best = int(p.argmax())
        return best, float(p[best]), self.distance(counts / n, n, best)

    def distance(self, shares: np.ndarray, n: float, language: int) -> float:
        off = -float(shares @ self.profile[:, language]) - float(self.entropy[language])
        return off / (self.spread[0] / n + self.spread[1]) ** 0.5


class Samples(NamedTuple):
    """Texts as n-gram buckets: those of row i are ``buckets[starts[i]:starts[i + 1]]``."""

    languages: list[str]
    starts: np.ndarray
    buckets: np.ndarray
    counts: np.ndarray

    def shares(self, rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS), dtype=np.float32)
        for i, row in enumerate(rows):
            own = slice(self.starts[row], self.starts[row + 1])
            x[i, self.buckets[own]] = self.counts[own] / max(1, self.counts[own].sum())
        return x


def letters_of(text: Column) -> Column:
    """Lower-case letters of a text, every run of other characters as one space."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), r"[^\p{L}\p{M}]+", " ")


def bucket_counts(letters: str) -> np.ndarray:
    """How often each bucket occurs among the n-grams of one to four characters."""
    code = np.frombuffer(letters.encode("utf-32-le"), dtype=np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    step = 1 << 20
    for start in range(0, len(code), step):
        piece = code[start : start + step + LONGEST - 1]
        h = np.zeros(len(piece), dtype=np.uint32)
        for n in range(1, LONGEST + 1):
            if len(piece) < n:
                break
            h = h[: len(piece) - n + 1] * np.uint32(0x01000193) + piece[n - 1 :] * np.uint32(0x9E3779B1)
            # n-grams that begin in the next piece are counted there.
            own = h[:step]
            mixed = (own ^ (own >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF)
            counts += np.bincount(mixed >> np.uint32(19), minlength=BUCKETS)
    return counts


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _learn(samples: Samples, truth: np.ndarray, rows: np.ndarray, n_languages: int, epochs: int, rate: float, batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after stochastic gradient steps, each divided by the root of the squares of its weight's steps so
    far: no step is longer than ``rate``, whatever the scale of the gradients."""
    random = np.random.default_rng(7)
    parts = [random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32), random.normal(0, 0.1, (DIMENSIONS, n_languages)).astype(np.float32), np.zeros(n_languages, dtype=np.float32)]
    squares = [np.full_like(part, 1e-8) for part in parts]
    for epoch in range(epochs):
        order = random.permutation(rows)
        for start in range(0, len(order), batch):
            some = order[start : start + batch]
            x = samples.shares(some)
            embeddings, linear, bias = parts
            hidden = x @ embeddings
            p = _softmax(hidden @ linear + bias)
            p[np.arange(len(some)), truth[some]] -= 1
            p /= len(some)
            for part, square, gradient in zip(parts, squares, (x.T @ (p @ linear.T), hidden.T @ p, p.sum(axis=0))):
                square += gradient * gradient
                part -= rate * (1 - epoch / epochs) * gradient / np.sqrt(square)
    return parts[0] @ parts[1], parts[2]


def train(samples: Samples, epochs: int = 12, rate: float = 0.1, batch: int = 32, keep: float = 0.998) -> Model | None:
    """A model of the samples, of which every fifth only calibrates; None without samples. Weights that are no finite
    numbers are an error."""
    languages = sorted(set(samples.languages))
    if not languages:
        return None
    number = {language: i for i, language in enumerate(languages)}
    truth = np.array([number[language] for language in samples.languages])
    rows = np.arange(len(truth))
    learning, checking = rows[rows % 5 != 4], rows[rows % 5 == 4]
    learning = np.append(learning, [r for r in checking if truth[r] not in set(truth[learning])]).astype(np.int64)
    checking = checking if len(checking) else learning
    weights, bias = _learn(samples, truth, learning, len(languages), epochs, rate, batch)
    if not (np.isfinite(weights).all() and np.isfinite(bias).all()):
        raise ValueError("training gave weights that are no finite numbers")
    scores = np.concatenate([samples.shares(part) @ weights + bias for part in np.array_split(checking, -(-len(checking) // 256))])
    temperatures = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
    losses = [-np.log(np.maximum(_softmax(scores / t)[np.arange(len(checking)), truth[checking]], 1e-9)).mean() for t in temperatures]

    sizes = np.array([samples.counts[a:b].sum() for a, b in zip(samples.starts[:-1], samples.starts[1:])])
    held = np.zeros((len(languages), BUCKETS))
    for row in learning:
        own = slice(samples.starts[row], samples.starts[row + 1])
        held[truth[row], samples.buckets[own]] += samples.counts[own]
    profile = np.log((held + 0.5) / (held.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)).T
    crossed = np.array([-(samples.counts[a:b] @ profile[samples.buckets[a:b], t]) / max(1, n) for a, b, t, n in zip(samples.starts[:-1], samples.starts[1:], truth, sizes)])
    # A language's own level and the spread around it, by least squares over what the profile has seen and what it has not.
    entropy = np.array([np.average(crossed[truth == t], weights=sizes[truth == t]) for t in range(len(languages))])
    off = crossed - entropy[truth]
    shape = np.stack([1 / np.maximum(1, sizes), np.ones(len(sizes))], axis=1)
    spread = np.maximum(np.linalg.lstsq(shape, off * off, rcond=None)[0], [1.0, 0.02])
    far = off / np.sqrt(shape @ spread)
    limit = max(5.0, float(np.quantile(far, keep)))
    return Model(languages, weights.astype(np.float32), bias, temperatures[int(np.argmin(losses))], profile.astype(np.float32), entropy, (float(spread[0]), float(spread[1])), limit)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", held_out: int = 2, per_language: int = SAMPLE_PER_LANGUAGE, total: int = SAMPLE_TOTAL) -> Model | None:
    """Train on rows with a language whose fold is not ``held_out``: some ``per_language`` rows of each, drawn by a hash,
    fewer where the languages together would exceed ``total``, but always one of each.

    The sample is the bound of the training; all else (the languages, their sizes, the predictions) covers every row.
    Each sampled text gives two samples: itself and a few words from its middle, so that short texts are learnt too.
    """
    usable = docs.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull() & (fold(F.col(f"`{doc_id}`")) != held_out))
    drawn = F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.lit("sample")), F.lit(1_000_003)) / 1_000_003.0
    sizes = usable.groupBy(F.col(f"`{lang}`").alias("language")).agg(F.count(F.lit(1)).alias("rows"), F.min(drawn).alias("least")).collect()
    if not sizes:
        return None
    per_language = max(1, min(per_language, total // len(sizes)))
    limits = docs.sparkSession.createDataFrame([(r["language"], per_language / r["rows"], r["least"]) for r in sizes], "language string, share double, least double")
    name = F.col(f"`{lang}`")
    candidates = usable.select(name.alias("language"), drawn.alias("drawn"), F.col(f"`{text}`").alias("text")).join(F.broadcast(limits), "language")
    sample = candidates.where((F.col("drawn") < F.col("share")) | (F.col("drawn") == F.col("least"))).select("language", "drawn", letters_of(F.col("text")).alias("letters"))
    # Twice the expected number of each language bounds what reaches the driver, so none takes the place of another.
    place = F.row_number().over(Window.partitionBy("language").orderBy("drawn", "letters"))
    sample = sample.withColumn("place", place).where(F.col("place") <= 2 * per_language).drop("place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for language, draw, letters in zip(*[batch.column(c).to_pylist() for c in ("language", "drawn", "letters")]):
                words = letters.split()
                start = int(draw * 1_000_003) % max(1, len(words))
                for piece in (letters, f" {' '.join(words[start : start + 2 + start % 8])} "):
                    if piece.strip():
                        counts = bucket_counts(piece)
                        used = np.flatnonzero(counts)
                        rows.append((language, draw, used.astype(np.int32), counts[used].astype(np.int32)))
            columns = [[row[i] for row in rows] for i in range(4)]
            kinds = (pa.string(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["language", "drawn", "buckets", "counts"])

    table = sample.mapInArrow(run, "language string, drawn double, buckets array<int>, counts array<int>")
    got = table.orderBy("drawn", "language", "counts").toArrow()  # the order makes the result repeatable
    buckets, counts = (got.column(name).combine_chunks() for name in ("buckets", "counts"))
    flat = [x.flatten().to_numpy() if len(x) else np.zeros(0, np.int32) for x in (buckets, counts)]
    starts = np.asarray(buckets.offsets).astype(np.int64) if len(buckets) else np.zeros(1, np.int64)
    model = train(Samples(got.column("language").to_pylist(), starts - starts[0], *flat))
    # The sample's memory goes back, else Arrow keeps it for as long as the driver runs.
    del got, buckets, counts, flat
    pa.default_memory_pool().release_unused()
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_rejected``.

    A null text or one without letters is ``und`` with score 0 and rejected, as is every text without a model. Other
    texts get the most probable language; they are rejected when they are further from its texts than nearly all of these.
    Columns of ``docs`` with these names are replaced.
    """
    made = ("lang_pred", "lang_score", "lang_rejected")
    docs = docs.drop(*made)
    letters = own_name(docs, "letters")
    held = docs.sparkSession.sparkContext.broadcast(model and tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value and Model(*held.value)
        for batch in batches:
            names, scores, rejected = [], [], []
            for value in batch.column(letters):
                value = value.as_py()
                if model is None or not value or not value.strip():
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                best, p, far = model.judge(bucket_counts(value))
                names.append(model.languages[best])
                scores.append(min(1.0, p))
                rejected.append(far > model.limit)
            kept = [(c, n) for c, n in zip(batch.columns, batch.schema.names) if n != letters]
            yield pa.RecordBatch.from_arrays(
                [c for c, _ in kept] + [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [n for _, n in kept] + list(made),
            )

    schema = StructType(list(docs.schema.fields)).add("lang_pred", "string").add("lang_score", "double").add("lang_rejected", "boolean")
    has_letter = text_of(text).rlike(r"\p{L}")
    return docs.withColumn(letters, F.when(has_letter, letters_of(text_of(text)))).mapInArrow(run, schema)


def language_report(docs: DataFrame) -> DataFrame:
    found = predict(docs.select("doc_id", "text"), fit(docs)).drop("text")
    return found.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )
