"""Quality of texts by a sparse ensemble of rules over statistics of the text.

Shallow boosted trees propose rules: every path from a root is a conjunction of limits on statistics. A lasso logistic
regression over the rules and the statistics themselves keeps few of them, with a weight each. The kept rules become one
Spark column expression over the statistics, so scoring needs no model object. Statistics come from Arrow batches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickframe.llm.common import own_name

# Labelled documents that the model learns from at most, drawn by a hash of their ids.
SAMPLE = 16_000
TREES, DEPTH, BINS = 40, 3, 32

_SPACE, _SYMBOLS, _STOPS, _PAUSES = b" \t\n\x0b\x0c\r", b"#*$%&|<>{}[]\\/=+~^_@`", b".!?", b",;:"
_UPPER, _LOWER, _DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
STATISTICS = (
    "chars", "words", "lines", "mean_word", "longest_word", "upper", "digits", "symbols", "stops", "pauses", "exclamations", "bars", "spaces", "beyond_ascii",
    "words_with_symbols", "capital_words", "one_letter_words", "long_words", "distinct_words", "top_word", "repeated_pairs", "mean_line", "short_lines", "repeated_lines", "unended_lines",
)


def statistics(text: str | None) -> list[float]:
    """The figures named in ``STATISTICS``; shares of 0 where there is nothing to share. Null is as empty."""
    body = (text or "").encode()
    if not body:
        return [0.0] * len(STATISTICS)
    held = np.bincount(np.frombuffer(body, dtype=np.uint8), minlength=256)
    share = lambda some, all_: some / all_ if all_ else 0.0
    of = lambda group: int(held[list(group)].sum())
    chars = len(body) - int(held[0x80:0xC0].sum())
    beyond = int(held[0xC0:].sum())
    words = body.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    letters = of(_UPPER) + of(_LOWER) + beyond
    lines = [line for line in body.split(b"\n") if line.strip()]
    in_line = [line.count(b" ") + 1 for line in lines]
    pairs = Counter(zip(words, words[1:]))
    ends = b"".join(line.rstrip()[-1:] for line in lines)
    odd = sum(c for w, c in counts.items() if w.translate(None, _SYMBOLS) != w)
    capital = sum(c for w, c in counts.items() if w.upper() == w and w.lower() != w and len(w) > 1)
    return [
        float(chars), float(n), float(len(lines)), share(chars - of(_SPACE), n), float(lengths.max(initial=0)), share(of(_UPPER), letters), share(of(_DIGITS), chars), share(of(_SYMBOLS), chars),
        share(of(_STOPS), n), share(of(_PAUSES), n), share(of(b"!"), n), share(of(b"|"), n), share(of(_SPACE), chars), share(beyond, chars),
        share(odd, n), share(capital, n), share(int((lengths == 1).sum()), n), share(int((lengths > 15).sum()), n), share(len(counts), n), share(max(counts.values(), default=0), n), share(n - 1 - len(pairs), n) if n else 0.0,
        share(n, len(lines)), share(sum(k < 4 for k in in_line), len(lines)), share(len(lines) - len(set(lines)), len(lines)), share(sum(e not in b".!?:\"')" for e in ends), len(lines)),
    ]


def with_statistics(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` and column ``name``, a struct of the statistics of the whole text."""
    schema = StructType(list(docs.schema.fields)).add(name, StructType.fromDDL(", ".join(f"{s} double" for s in STATISTICS)))
    kind, place = pa.struct([(s, pa.float64()) for s in STATISTICS]), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(v.as_py()) for v in batch.column(place)], dtype=np.float64).reshape(-1, len(STATISTICS))
            found = pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], schema.names)

    return docs.mapInArrow(run, schema)


class Rule(NamedTuple):
    """Limits on statistics: (number of the statistic, above, limit). All must hold: a value is above, or is not above, its limit."""

    limits: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for at, above, limit in self.limits:
            out &= (x[:, at] > limit) == above
        return out


class Linear(NamedTuple):
    """A statistic, kept between two bounds and scaled by its spread."""

    at: int
    low: float
    high: float
    spread: float

    def values(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x[:, self.at], self.low, self.high) / self.spread


class Ensemble(NamedTuple):
    bias: float
    rules: list[tuple[Rule, float]]
    linear: list[tuple[Linear, float]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum(w * t.holds(x) for t, w in self.rules) + sum(w * t.values(x) for t, w in self.linear) + np.zeros(len(x))

    def score(self, stats: str) -> Column:
        """The score over the statistics in the struct column ``stats``, from 0 to 1."""

        def value(at: int) -> Column:
            return F.col(f"`{stats}`.`{STATISTICS[at]}`")

        total = F.lit(self.bias)
        for rule, weight in self.rules:
            held = F.lit(True)
            for at, above, limit in rule.limits:
                held = held & (value(at) > F.lit(limit) if above else value(at) <= F.lit(limit))
            total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        for term, weight in self.linear:
            total = total + F.least(F.greatest(value(term.at), F.lit(term.low)), F.lit(term.high)) * F.lit(weight / term.spread)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def _grow(binned: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int, path: tuple, leaves: list, least: int = 10) -> None:
    """Split ``rows`` by the statistic and limit that lower the loss most; ``leaves`` gets (path, rows, value)."""

    def gain(g, h):
        return g * g / (h + 1.0)

    g_all, h_all = grad[rows].sum(), weight[rows].sum()
    best = (1e-6, -1, -1)
    if depth and len(rows) >= 2 * least:
        for at, limits in enumerate(edges):
            if not len(limits):
                continue
            codes = binned[rows, at]
            g, h, n = (np.cumsum(np.bincount(codes, w, minlength=len(limits) + 1))[:-1] for w in (grad[rows], weight[rows], np.ones(len(rows))))
            gains = np.where((n >= least) & (len(rows) - n >= least), gain(g, h) + gain(g_all - g, h_all - h) - gain(g_all, h_all), 0)
            k = int(gains.argmax())
            best = max(best, (float(gains[k]), -at, -k), key=lambda b: b[0])
    if best[1] == -1 and best[2] == -1 or best[0] <= 1e-6:
        leaves.append((path, rows, -g_all / (h_all + 1.0)))
        return
    at, k = -best[1], -best[2]
    above = binned[rows, at] > k
    for side in (False, True):
        _grow(binned, edges, grad, weight, rows[above == side], depth - 1, (*path, (at, side, float(edges[at][k]))), leaves, least)


def _simplified(path: tuple) -> tuple:
    """The tightest limit for each statistic and side, in a fixed order."""
    out: dict[tuple[int, bool], float] = {}
    for at, above, limit in path:
        old = out.get((at, above))
        out[at, above] = limit if old is None else max(old, limit) if above else min(old, limit)
    return tuple((at, above, limit) for (at, above), limit in sorted(out.items()))


def propose_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> list[Rule]:
    """Paths, whole and cut short, of boosted trees; of rules that hold for the same rows only the shortest."""
    random = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    edges = [e[e < c.max()] for e, c in zip(edges, x.T)]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    margin, paths = np.zeros(len(y)), set()
    for _ in range(trees):
        p = _sigmoid(margin)
        grad, weight = p - y, p * (1 - p)
        leaves: list = []
        _grow(binned, edges, grad, weight, np.flatnonzero(random.random(len(y)) < 0.5), depth, (), leaves)
        # Leaves give values to all rows, not only to those that the tree has seen.
        for path, _, value in leaves:
            margin[Rule(path).holds(x)] += 0.3 * value
            paths |= {_simplified(path[:k]) for k in range(1, len(path) + 1)}
    seen, rules = set(), []
    for path in sorted(paths, key=lambda q: (len(q), q)):
        held = Rule(path).holds(x)
        keys = {np.packbits(held).tobytes(), np.packbits(~held).tobytes()}
        if 0 < held.sum() < len(x) and not keys & seen:
            seen |= keys
            rules.append(Rule(path))
    return rules


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray | None = None, rounds: int = 400) -> np.ndarray:
    """Weights of a logistic regression with an absolute-value penalty on all but the last column, by accelerated proximal steps."""
    w = np.zeros(x.shape[1]) if start is None else start.copy()
    vector = np.ones(x.shape[1])
    for _ in range(20):  # the largest curvature, by power iteration
        vector = x.T @ (x @ vector)
        vector /= max(np.linalg.norm(vector), 1e-12)
    step = 1 / max(1e-9, 1.02 * 0.25 * np.linalg.norm(x @ vector) ** 2 / len(y))
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        new = ahead - step * (x.T @ (_sigmoid(x @ ahead) - y)) / len(y)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        done = np.abs(new - w).max() < 1e-5
        w, t = new, t_new
        if done:
            break
    return w


def learn(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """An ensemble from statistics and labels (0 or 1). The penalty is the largest whose loss on every fifth row, left out
    of the fit, is within one standard error of the best. One label alone gives its share, an empty sample 0.5."""
    if len(y) < 20 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return Ensemble(float(np.log(share / (1 - share))), [], [])
    checked = np.arange(len(y)) % 5 == 4
    if y[~checked].min() == y[~checked].max():
        checked[:] = False
    rules = propose_rules(x[~checked], y[~checked])
    bounds = np.quantile(x[~checked], [0.025, 0.975], axis=0)
    terms = [Linear(at, float(lo), float(hi), float(s)) for at, (lo, hi) in enumerate(bounds.T) if hi > lo and (s := 2.5 * np.clip(x[~checked, at], lo, hi).std()) > 0]
    columns = np.stack([*(r.holds(x).astype(float) for r in rules), *(t.values(x) for t in terms), np.ones(len(y))], axis=1)
    means = np.append(columns[~checked, :-1].mean(axis=0), 0.0)
    columns -= means
    fit, hold = (columns[~checked], y[~checked]), (columns[checked], y[checked]) if checked.any() else (columns, y)
    most = np.abs(fit[0][:, :-1].T @ (fit[1] - fit[1].mean())).max() / len(fit[1])
    w, tried = None, []
    for penalty in most * np.geomspace(0.5, 0.002, 12):
        w = lasso(*fit, penalty, w)
        z = hold[0] @ w
        losses = np.logaddexp(0, z) - hold[1] * z
        tried.append((float(losses.mean()), float(losses.std() / len(losses) ** 0.5), w))
    limit = sum(min(tried, key=lambda t: t[0])[:2])
    w = next(w for loss, _, w in tried if loss <= limit)
    parts = [*rules, *terms]
    kept = [(p, float(v)) for p, v in zip(parts, w) if abs(v) > 1e-9]
    return Ensemble(float(w[-1] - means @ w), [(p, v) for p, v in kept if isinstance(p, Rule)], [(p, v) for p, v in kept if isinstance(p, Linear)])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", held_out: int = 1, sample: int = SAMPLE) -> Ensemble:
    """Learn from labelled documents whose fold is not ``held_out``, ``sample`` of them at most, drawn by a hash of the id.

    Labels other than 0 and 1 are left out; several of one id count as their mean, rounded (a half up). Of several rows
    with one id the one with the smallest statistics is learnt from. Null ids are never learnt from.
    """
    named = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("double").alias("y")).where("y IN (0, 1)").where(fold(F.col("id")) != held_out)
    drawn = named.groupBy("id").agg(F.avg("y").alias("y")).select("id", (F.col("y") >= 0.5).cast("double").alias("y"), F.xxhash64("id", F.lit("sample")).alias("draw"))
    drawn = drawn.orderBy("draw", "id").limit(sample)
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).join(F.broadcast(drawn), "id")
    found = with_statistics(rows, "stats").groupBy("id", "y", "draw").agg(F.min("stats").alias("stats")).orderBy("draw", "id").select("y", "stats.*").toArrow()
    table = np.stack([found.column(c).to_numpy() for c in ("y", *STATISTICS)], axis=1) if len(found) else np.zeros((0, 1 + len(STATISTICS)))
    return learn(table[:, 1:], table[:, 0])


def score_quality(docs: DataFrame, ensemble: Ensemble, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``quality_score`` (0 to 1, higher: label 1 likelier) and ``quality_predicted`` (1 from a
    score of a half on, else 0). Null and empty texts have the score of statistics that are all 0. Columns of ``docs``
    with these two names are replaced, others stay; equal texts have equal scores."""
    docs = docs.drop("quality_score", "quality_predicted")
    stats = own_name(docs, "stats")
    scored = with_statistics(docs, stats, text).withColumn("quality_score", ensemble.score(stats)).drop(stats)
    return scored.withColumn("quality_predicted", F.when(F.col("quality_score") >= 0.5, 1).otherwise(0))


def classifier_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row; null ids are held in, as they have no fold."""
    found = score_quality(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted"))
