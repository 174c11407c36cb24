"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees on a bounded sample of labelled documents give rules: each path from a root is a conjunction of
comparisons of statistics. A logistic regression with lasso penalty weighs the rules, most to zero. What is left is a Spark
column expression over the statistics, so scoring is a projection inside code generation.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, in_batches

#: Labelled rows that a model is fitted on at most: those with the smallest hash of the id.
SAMPLE_ROWS = 20_000
#: Trees, their depth, thresholds tried for a statistic, least rows in a leaf, and the shrinkage of boosting.
TREES, DEPTH, CUTS, LEAF, RATE = 40, 3, 32, 20, 0.3
#: Lasso penalty on the mean loss, and steps of the solver.
PENALTY, STEPS = 2e-4, 600

STATISTICS = ["words", "word_bytes", "upper", "digits", "sentence_marks", "shouts", "symbols", "other_bytes", "lines", "distinct_words", "repeats", "second_repeats", "single_words", "marked_words"]
_UPPER, _LETTERS, _DIGITS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)]), bytes(range(48, 58))
_SENTENCE, _SYMBOLS, _HIGH = b".,;:?'\"-()", b"#$%&*+/<=>@[\\]^_`{|}~", bytes(range(128, 256))


def statistics(text: bytes) -> list[float]:
    """The STATISTICS of a whole text; shares are of bytes, letters or words. An empty text has zeros."""
    words, size = text.split(), len(text)
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    kept = lambda chars: size - len(text.translate(None, chars))
    letters = kept(_LETTERS)
    ends = b" ".join(words)
    marked = sum(ends.count(c + b" ") + ends.endswith(c) for c in (b"!", b"#", b"$", b"%", b"&", b"*", b"|"))
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        kept(_UPPER) / max(1, letters),
        kept(_DIGITS) / size,
        kept(_SENTENCE) / size,
        text.count(b"!") / size,
        kept(_SYMBOLS) / size,
        kept(_HIGH) / size,
        text.count(b"\n") / n,
        len(set(words)) / n,
        sum(map(operator.eq, words, islice(words, 1, None))) / n,
        sum(map(operator.eq, words, islice(words, 2, None))) / n,
        list(map(len, words)).count(1) / n,
        marked / n,
    ]


def with_statistics(docs: DataFrame, text_col: str, stat_cols: list[str]) -> DataFrame:
    """docs with the statistics of text_col (null: empty) in stat_cols; text_col itself stays."""
    schema = T.StructType(list(docs.schema))
    for name in stat_cols:
        schema = schema.add(name, "double")
    at = [c.lower() for c in docs.columns].index(text_col.lower())

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(x.as_py() or b"") for x in batch.column(at).cast(pa.binary())], float).reshape(-1, len(stat_cols))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(rows[:, k]) for k in range(len(stat_cols)))], names=schema.names)

    return docs.transform(in_batches, made, schema)


@dataclass(frozen=True)
class Rule:
    """Holds where every (statistic's place, whether above, threshold) holds."""

    tests: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, above, cut in self.tests:
            out &= (x[:, k] > cut) == above
        return out

    def column(self, stats: list[Column]) -> Column:
        out = F.lit(True)
        for k, above, cut in self.tests:
            out = out & (stats[k] > cut if above else stats[k] <= cut)
        return out


@dataclass(frozen=True)
class Model:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, weight in zip(self.rules, self.weights):
            z += weight * rule.holds(x)
        return 1 / (1 + np.exp(-z))

    def column(self, stats: list[Column]) -> Column:
        z = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            z = z + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _tree(binned: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, path: tuple, paths: list, out: np.ndarray) -> None:
    """Grows a tree on rows by Newton gain, adds the path of each node to paths and each leaf's value to out."""
    g, h = grad[rows].sum(), hess[rows].sum()
    if path:
        paths.append(path)
    best = (1e-6, -1, -1)
    if depth and len(rows) >= 2 * LEAF:
        for k in range(binned.shape[1]):
            b, m = binned[rows, k], len(cuts[k]) + 1
            gl, hl, nl = (np.cumsum(np.bincount(b, w, m))[:-1] for w in (grad[rows], hess[rows], None))
            if not len(gl):
                continue
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(nl < LEAF) | (len(rows) - nl < LEAF)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0] + 1e-9:
                best = float(gain[at]), k, at
    _, k, at = best
    if k < 0:
        out[rows] += RATE * g / (h + 1)
        return
    low = binned[rows, k] <= at
    for above, part in ((False, rows[low]), (True, rows[~low])):
        _tree(binned, cuts, grad, hess, part, depth - 1, (*path, (k, above, float(cuts[k][at]))), paths, out)


def boosted_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    """The distinct rules of all nodes of gradient-boosted trees for logistic loss."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 2)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    z, paths = np.full(len(y), np.log(rate / (1 - rate))), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        _tree(binned, cuts, y - p, p * (1 - p), np.arange(len(y)), depth, (), paths, z)
    return list(dict.fromkeys(Rule(tuple(sorted(set(p)))) for p in paths))


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and free bias that minimise mean logistic loss + penalty * sum |weight|, by accelerated proximal gradient."""
    n = len(y)
    a1 = np.c_[a, np.ones(n)].astype(np.float64)
    v = np.ones(a1.shape[1])
    for _ in range(30):  # the largest curvature, by power iteration
        v = a1.T @ (a1 @ v)
        v /= np.linalg.norm(v)
    rate = 1 / (1.05 * 0.25 * float(v @ (a1.T @ (a1 @ v))) / n)
    w = u = np.zeros(a1.shape[1])
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a1 @ u)))
        new = u - rate * (a1.T @ (p - y)) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        u, w = new + (last - 1) / t * (new - w), new
    return w[:-1], float(w[-1])


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of the probability of label 1. Without labels it is one half everywhere; with one kind of label, near to it."""
    if not len(y):
        return Model((), (), 0.0)
    rate = (y.sum() + 1) / (len(y) + 2)
    if y.min() == y.max():
        return Model((), (), float(np.log(rate / (1 - rate))))
    rules = boosted_rules(x, y.astype(float))
    weights, bias = lasso_logistic(np.stack([r.holds(x) for r in rules], axis=1), y.astype(float)) if rules else (np.zeros(0), float(np.log(rate / (1 - rate))))
    used = np.flatnonzero(np.abs(weights) > 1e-9)
    return Model(tuple(rules[i] for i in used), tuple(float(weights[i]) for i in used), bias)


def held_out(id_col: str) -> Column:
    """Whether labels of a row are kept from fitting: crc32 of the id as text is 0 modulo 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """A model fitted on at most `rows` labelled documents outside the held-out fold, those with the smallest hash of the id.

    Rows with a null id or a label other than 0 and 1 are not used; of repeated labels of an id the larger one is; repeated
    documents are each used. Neither ids nor any other column than text_col are seen by the model.
    """
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("y"))
    chosen = chosen.orderBy(F.xxhash64(id_col), id_col).limit(rows).select(F.col(id_col).alias("id"), "y")
    # At most `rows` ids and labels: bounded for a broadcast.
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    stats = [f"s{k}" for k in range(len(STATISTICS))]
    got = with_statistics(texts, "text", stats).select("id", "y", *stats).orderBy(F.xxhash64("id"), "id", *stats).limit(rows).toPandas()
    return fit(got[stats].to_numpy(float), got["y"].to_numpy())


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """docs with score (probability of label 1) and predicted (1 from threshold on).

    A null text scores as an empty one. Rows are scored one by one, whatever repeats; other columns pass through, those named
    like results are replaced; an empty table gives an empty table.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    stats = fresh(docs, *(f"s{k}" for k in range(len(STATISTICS))))
    out = with_statistics(docs, text_col, stats).withColumn("score", model.column([F.col(c) for c in stats]))
    return out.select(*docs.columns, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
