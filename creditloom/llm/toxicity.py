"""Toxicity by weak supervision.

Many voters look at a text and say toxic, clean, or nothing. Lexicon voters stand for words and word beginnings that mark toxic
text (drawn from the labelled training rows, by how surprising their share in toxic text is); pattern voters look at density, shouting and
marks. A generative label model sees only the votes: for a hidden class it estimates how often each voter speaks and how
often it is right (expectation-maximisation), and how voters still move together inside a class. Voters that repeat
each other share one voice: the evidence of a voter is divided by the sum of its correlations. The posterior
of the hidden class is the label on which a linear classifier is trained; the classifier scores every text.

Labels are used to draw the lexicon, from a bounded sample (`SAMPLE` rows of each class, chosen by a hash of the id), and to weigh the sampled rows
back to the classes' true shares, so that a score means the same at every table size.
"""

from __future__ import annotations

import dataclasses
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stored
from creditloom.llm.quality import _sigmoid, descend, held_out
from creditloom.session import small_side

SAMPLE = 6_000
TERMS, VOTERS = 400, 60
PREFIXES = (3, 4, 5, 6, 7, 8)
_WORD = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 300_000
PATTERNS = ["dense", "very_dense", "several", "shouts", "marks", "none"]


def terms_of(word: str) -> list[str]:
    """The word itself, and its beginnings marked by a star."""
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


class Lookup:
    """Terms in a text; what a word matches is remembered for a bounded number of words."""

    def __init__(self, terms: list[str]) -> None:
        self.index = {t: i for i, t in enumerate(terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def hits(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= _CACHE_WORDS:
                self.known.clear()
            found = self.known[word] = tuple(self.index[t] for t in terms_of(word) if t in self.index)
        return found


def vector(text: str, lookup: Lookup) -> tuple[list[int], list[float]]:
    """Terms present, and [share of words hit, hit words (log), words (log), share of shouted words, marks per word]."""
    words = _WORD.findall(text.lower())
    n = len(words)
    if not n:
        return [], [0.0] * 5
    present: set[int] = set()
    hit = 0
    known = lookup.known
    for w in words:
        found = known.get(w)
        if found is None:
            found = lookup.hits(w)
        if found:
            hit += 1
            present.update(found)
    capitals = sum(1 for w in text.split() if len(w) > 2 and w.isupper())
    return sorted(present), [hit / n, math.log1p(hit), math.log1p(n), capitals / n, text.count("!") / n]


def votes(present: list[int], facts: list[float], voters: int) -> np.ndarray:
    """One vote per voter: 1 toxic, -1 clean, 0 silent. Lexicon voters first, then PATTERNS."""
    out = np.zeros(voters + len(PATTERNS), np.int8)
    out[[i for i in present if i < voters]] = 1
    share, hits, _, shouts, marks = facts
    out[voters:] = (share >= 0.01, share >= 0.03, hits > math.log(2.5), shouts > 0.3, marks > 0.2, -int(hits == 0))
    return out


def label_model(v: np.ndarray, rounds: int = 50, prior: float = 0.1, weight: np.ndarray | None = None) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Posterior of the toxic class per row, and the estimates: accuracy of each voter, correlations, class share. Rows count by `weight`.

    The start is the majority of the votes. Each round estimates P(vote | class) with one pseudo-count and sets posteriors from
    the voters' evidence, divided by how much a voter repeats others.
    """
    n, m = v.shape
    weight = np.ones(n) if weight is None else weight
    toxic, clean = (v == 1).astype(np.float32), (v == -1).astype(np.float32)
    balance = toxic.sum(axis=1) - clean.sum(axis=1)
    post = np.clip(np.where(balance > 0, 0.95, np.where(balance < 0, 0.05, prior)), 0.01, 0.99)
    voice, share, table = np.ones(m), prior, np.full((2, 3, m), 1 / 3)
    correlation = np.eye(m)
    for round_ in range(rounds):
        share = float(np.clip(np.average(post, weights=weight), 1e-3, 1 - 1e-3))
        rows = []
        for w in (weight * (1 - post), weight * post):
            said_clean, said_toxic = w @ clean, w @ toxic
            rows.append(np.stack([said_clean, w.sum() - said_clean - said_toxic, said_toxic]) + 0.5)
        table = np.stack(rows) / np.array([r.sum(axis=0) for r in rows])[:, None, :]
        if round_ in (3, 10):
            # What is left of each vote after its class mean; voters that move together share a voice.
            means = np.stack([table[c][2] - table[c][0] for c in (0, 1)])
            left = v - (np.outer(1 - post, means[0]) + np.outer(post, means[1]))
            spread = np.sqrt(np.average(left**2, axis=0, weights=weight)) + 1e-9
            correlation = ((left * weight[:, None]).T @ left) / weight.sum() / np.outer(spread, spread)
            voice = 1 / np.maximum(1, np.clip(correlation, 0, 1).sum(axis=1))
        logs = (np.log(table[1]) - np.log(table[0])) * voice
        evidence = clean @ (logs[0] - logs[1]) + toxic @ (logs[2] - logs[1]) + logs[1].sum()
        fresh = _sigmoid(evidence + math.log(share / (1 - share)))
        done = np.abs(fresh - post).max() < 1e-6 and round_ > 10
        post = fresh
        if done:
            break
    speaks = np.stack([table[c][0] + table[c][2] for c in (0, 1)])
    right = (share * table[1][2] + (1 - share) * table[0][0]) / np.maximum(share * speaks[1] + (1 - share) * speaks[0], 1e-9)
    return post, {"accuracy": right, "correlation": correlation, "share": np.array(share)}


@dataclasses.dataclass(frozen=True)
class Model:
    terms: list[str]
    weights: np.ndarray
    bias: float
    accuracy: np.ndarray

    def score(self, texts: list[str], lookup: Lookup) -> np.ndarray:
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            present, facts = vector(t, lookup)
            out[i] = self.weights[present].sum() + self.weights[len(self.terms):] @ facts + self.bias
        return _sigmoid(out)


def lexicon(labelled: DataFrame, terms: int) -> list[str]:
    """Terms that mark toxic text, most telling first, from `labelled` (doc_id, text, toxic).

    A term counts once per document. It is kept when its count in toxic documents would be a surprise for a term that doesn't care
    about the class, with room for the number of terms looked at, and it is several times as frequent there.
    """
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                found = sorted({t for w in set(_WORD.findall((text or "").lower())) for t in terms_of(w)})
                yield pd.DataFrame({"term": found, "toxic": np.full(len(found), toxic, np.int32)})

    sizes = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n_toxic, n_clean = int(sizes["t"]), int(sizes["n"] - sizes["t"])
    if not n_toxic:
        return []
    share = n_toxic / (n_toxic + n_clean)
    counts = labelled.mapInPandas(words, "term string, toxic int").groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where("a >= 2")
    # Kullback-Leibler surprise of a hits in toxic text out of a + b.
    p = F.col("a") / (F.col("a") + F.col("b"))
    surprise = F.col("a") * F.log(p / share) + F.when(F.col("b") > 0, F.col("b") * F.log((1 - p) / (1 - share + 1e-12))).otherwise(0.0)
    many = max(counts.count(), 1)
    times = (F.col("a") + 0.5) / (n_toxic + 1) / ((F.col("b") + 0.5) / (n_clean + 1))
    best = counts.where(times > 4).where(surprise > math.log(many) + 2).orderBy(F.desc(F.round(surprise, 9)), "term").limit(terms)
    return [r["term"] for r in best.collect()]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS, voters: int = VOTERS) -> Model:
    """Learns from at most `sample` labelled documents of each class outside the held-out fold, weighed back to the classes' shares among all
    labels. Contradicting and null labels are left out; of documents that share an id the one with the smallest text is learned from.

    Without toxic examples the lexicon is empty and scores stay low.
    """
    labelled = (labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
                .where("toxic = other and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    every = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    each = [labelled.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    chosen = each[0].union(each[1])
    known = chosen.sparkSession.createDataFrame(chosen.collect(), "doc_id bigint, toxic int")  # at most 2 x sample ids
    learned = stored(docs.select("doc_id", "text").join(small_side(known, 2 * sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-sample")
    words = lexicon(learned, terms)
    spoken = min(voters, len(words))

    def see(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Lookup(words)
        for batch in batches:
            found = [vector(t or "", lookup) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "present": [f[0] for f in found], "facts": [f[1] for f in found]})

    seen = learned.select("toxic", "text").mapInPandas(see, "toxic int, present array<int>, facts array<double>").toPandas()
    rows = sorted((tuple(p), tuple(f), k) for p, f, k in zip(seen["present"], seen["facts"], seen["toxic"], strict=True))
    if not rows or not words:
        return Model(words, np.zeros(len(words) + 5), -4.0, np.zeros(0))
    drawn = {k: min(n, sample) for k, n in every.items()}
    weight = np.array([every[k] / drawn[k] for _, _, k in rows])
    v = np.stack([votes(list(p), list(f), spoken) for p, f, _ in rows]).astype(np.int8)
    post, found = label_model(v, prior=0.2, weight=weight)
    x = np.zeros((len(rows), len(words) + 6))
    for i, (p, f, _) in enumerate(rows):
        x[i, list(p)] = 1
        x[i, len(words):-1] = f
    x[:, -1] = 1
    penalty = np.full(x.shape[1], 1e-4)

    def risk(w: np.ndarray) -> np.ndarray:
        return (weight * (_sigmoid(x @ w) - post)) @ x / weight.sum() + penalty * w

    w = descend(risk, x.shape[1], 500, 0.05)
    return Model(words, w[:-1], float(w[-1]), found["accuracy"])


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` with `name`, between 0 and 1; null texts count as empty. An input column of that name is replaced."""
    def make():
        state: list[Lookup] = []

        @F.pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            if not state:
                state.append(Lookup(model.terms))
            return pd.Series(model.score([t or "" for t in texts], state[0]), dtype="float64")

        return scored

    kept = [c for c in docs.columns if c.lower() != name.lower()]
    return docs.select(*[F.col(f"`{c}`") for c in kept], make()(F.col("text")).alias(name))
