"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; web text carries no label. The share of good documents in web text (class prior)
is estimated by the best-bin method: a first classifier tells positives from unlabelled text, and the prior is the least
ratio, over thresholds, of the share of unlabelled to the share of positive documents above it, with a margin for the
size of the sample. The final model minimises the non-negative unbiased risk: with f(x) the model, l the logistic loss and
p the prior, p E+[l(f)] + max(0, E_u[l(-f)] - p E+[l(-f)]); where the second part would fall below zero, its gradient is turned.

Only training is done on a bounded sample (`SAMPLE` rows of each kind, chosen by a hash of the id). Every text is scored.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.session import small_side

SAMPLE = 12_000
FOLDS, HELD_OUT = 5, 0
NAMES = ["log_words", "word_length", "distinct", "repeated", "symbol_pairs", "bare_symbols", "symbols", "digits", "capitals", "stops", "stop_pairs",
         "line_words", "repeated_lines", "longest_word", "long_words"]
_CLASS = np.zeros(256, np.uint8)
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[ord("A"):ord("Z") + 1] = 3
_CLASS[[ord(c) for c in ".!?"]] = 4
_CLASS[[ord(c) for c in " \t\n\r\v\f"]] = 5


def held_out(doc_id: Column) -> Column:
    """Rows that learning never sees the labels of; a null id is one of them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def features(text: str) -> list[float]:
    """Shape of a text; language, source and ids play no part. An empty text has zeros."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    kinds = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    symbol, stop, space = kinds == 1, kinds == 4, np.concatenate([[True], kinds == 5, [True]])
    digit_share, capital_share = np.count_nonzero(kinds == 2) / len(kinds), np.count_nonzero(kinds == 3) / len(kinds)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    lengths = np.fromiter(map(len, words), np.int32, n)
    return [
        math.log1p(n), math.log1p(lengths.mean()), len(set(words)) / n ** 0.9, sum(map(eq, words, words[1:])) / n,
        np.count_nonzero(symbol[1:] & symbol[:-1]) / n, np.count_nonzero(symbol & space[:-2] & space[2:]) / n, np.count_nonzero(symbol) / len(kinds),
        digit_share, capital_share, np.count_nonzero(stop) / n, np.count_nonzero(stop[1:] & stop[:-1]) / n, math.log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), math.log1p(lengths.max()), np.count_nonzero(lengths > 25) / n,
    ]


@dataclasses.dataclass(frozen=True)
class Model:
    """A linear model over standardised features, their square roots and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(expanded((x - self.mean) / self.scale) @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def expanded(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -8, 8)
    return np.hstack([z, np.sign(z) * np.sqrt(np.abs(z)), np.maximum(z - 1, 0), np.maximum(-z - 1, 0)])


def descend(gradient, n: int, steps: int, rate: float = 0.03) -> np.ndarray:
    """Adam from zero."""
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Best-bin estimate of the share of positives among the unlabelled scores."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.sort(positive)
    above_p = 1 - np.arange(len(cuts)) / len(cuts)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    margin = np.sqrt(np.log(4 / delta) / (2 * len(positive))) + np.sqrt(np.log(4 / delta) / (2 * len(unlabelled)))
    best = int(np.argmin((above_u + margin) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 600, decay: float = 1e-3) -> Model:
    """Feature rows of trusted positives and of unlabelled text to a model."""
    both = np.vstack([positive, unlabelled])
    if not len(positive) or not len(unlabelled):
        width = both.shape[1]
        return Model(np.zeros(width), np.ones(width), np.zeros(4 * width), 0.0, 0.5)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    p, u = (np.c_[expanded((x - mean) / scale), np.ones(len(x))] for x in (positive, unlabelled))
    # First classifier on one half, prior on the other, and the other way round; the larger one, since losing good text costs more.
    prior = 0.0
    for parity in (0, 1):
        half_p, half_u = np.arange(len(p)) % 2 == parity, np.arange(len(u)) % 2 == parity
        if not half_p.any() or not half_u.any() or half_p.all() or half_u.all():
            half_p, half_u = np.ones(len(p), bool), np.ones(len(u), bool)

        def first(w: np.ndarray, half_p=half_p, half_u=half_u) -> np.ndarray:
            return -((1 - _sigmoid(p[half_p] @ w)) @ p[half_p]) / half_p.sum() + (_sigmoid(u[half_u] @ w) @ u[half_u]) / half_u.sum() + decay * w

        guide = descend(first, p.shape[1], steps // 2)
        rest_p, rest_u = (half_p, half_u) if half_p.all() else (~half_p, ~half_u)
        prior = max(prior, class_prior(p[rest_p] @ guide, u[rest_u] @ guide))

    def risk(w: np.ndarray) -> np.ndarray:
        fp, fu = p @ w, u @ w
        sp, su = _sigmoid(fp), _sigmoid(fu)
        as_positive = -prior * ((1 - sp) @ p) / len(p)
        as_negative = (su @ u) / len(u) - prior * (sp @ p) / len(p)
        negative_risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        return (as_positive + as_negative if negative_risk >= 0 else -as_negative) + decay * w

    w = descend(risk, p.shape[1], steps)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def sampled_features(docs: DataFrame, ids: DataFrame, rows: int) -> pd.DataFrame:
    """Feature rows of the documents whose ids (doc_id, kind) are in a sample of at most `rows` rows; of documents that share an id, the one
    with the smallest text, so that no more rows than ids come to the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"kind": batch["kind"], "x": [features(t or "") for t in batch["text"]]})

    chosen = docs.select("doc_id", "text").join(small_side(ids, rows), "doc_id").groupBy("doc_id", "kind").agg(F.min("text").alias("text")).select("kind", "text")
    return chosen.mapInPandas(run, "kind int, x array<double>").toPandas()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from at most `sample` trusted positives (quality 1, outside the held-out fold) and `sample` unlabelled documents.

    Labels that contradict each other for an id, and null labels, are not trusted. Without positives every score is 0.5.
    """
    trusted = (labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("r"))
               .where("q = 1 and r = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    web = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(sample)
    ids = trusted.withColumn("kind", F.lit(1)).union(web.withColumn("kind", F.lit(0)))
    found = sampled_features(docs, ids, 2 * sample)
    x = np.array(found["x"].tolist(), dtype=float).reshape(-1, len(NAMES))
    kind = found["kind"].to_numpy()
    order = np.lexsort((*x.T, kind))  # the same sums in the same order, whatever the partitions
    x, kind = x[order], kind[order]
    mixed = np.random.default_rng(5).permutation(len(x))
    return train(x[mixed][kind[mixed] == 1], x[mixed][kind[mixed] == 0])


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` with `name`, between 0 and 1; null texts count as empty. An input column of that name is replaced."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([features(t or "") for t in texts])))

    kept = [c for c in docs.columns if c.lower() != name.lower()]
    return docs.select(*[F.col(f"`{c}`") for c in kept], scored(F.col("text")).alias(name))
