"""Quality classifier by positive-unlabelled learning.

A small network on statistics of the whole text minimises the non-negative unbiased risk
(Kiryo et al., 2017): trusted positives stand for good text, unlabelled web text for the
mixture of good and bad, and the share of good text in the mixture, the class prior, is
estimated from the ranking of both by a first classifier (best bin estimate, Garg et al.,
2021). No negative label is used.

Nulls: a null text counts as empty and is scored like one. Without positives or unlabelled
text every score is 0.5. An empty table gives an empty result; repeated rows give repeated
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.llm.common import fold, labelled_sample, table

FOLDS, HELD_OUT = 3, 1
POSITIVES = 4000  # trusted positives that the network is fitted on
UNLABELLED = 8000  # unlabelled texts that it is fitted on
THRESHOLD = 0.5
HIDDEN = 16
SYMBOLS = b"!|#$%&*?@<>=_~^+{}[]\\/\"'()-:;.,"


def features(text: str) -> list[float]:
    """Statistics of the whole text; all are defined for the empty one."""
    raw = text.encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = max(1, len(raw))
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct = len(set(words))
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    pairs = len(set(zip(words, words[1:], strict=False)))
    upper, lower = count[65:91].sum(), count[97:123].sum()
    ends = sum(w[-1:] in b".,;:?" for w in words)
    doubled = sum(w[-2:-1] == w[-1:] and not w[-1:].isalnum() and w[-1] < 128 for w in words)
    return [
        np.log1p(len(words)), len(raw) / n_words, upper / max(1, upper + lower), lower / n,
        count[48:58].sum() / n, count[128:].sum() / n, count[10] / n, count[9] / n,
        distinct / n_words, np.log1p(n_words - distinct), pairs / max(1, len(words) - 1),
        len(set(lines)) / n_lines, np.log1p(n_lines), ends / n_words, doubled / n_words,
        sum(len(w) == 1 for w in words) / n_words, sum(len(w) > 20 for w in words) / n_words,
        count[:32].sum() / n, *(100 * count[s] / n for s in SYMBOLS),
    ]


class Network(NamedTuple):
    """One hidden layer behind standardised features."""

    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_risk(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int = 60, rate: float = 0.01,
    batch: int = 512, decay: float = 1e-4, seed: int = 5,
) -> Network:
    """Minimise prior * R+(P) + max(0, R-(U) - prior * R-(P)) under the logistic loss.

    Where the second part is below zero the step goes the other way on it alone. Without a
    prior, positives are told from unlabelled text as if that were negative.
    """
    rng = np.random.default_rng(seed)
    both = np.vstack([positive, unlabelled])
    mean, spread = both.mean(axis=0), both.std(axis=0) + 1e-6
    p = np.clip((positive - mean) / spread, -6, 6)
    u = np.clip((unlabelled - mean) / spread, -6, 6)
    w = [rng.normal(0, p.shape[1] ** -0.5, (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(epochs):
        rng.shuffle(u)
        for start in range(0, len(u), batch):
            bu = u[start : start + batch]
            bp = p[rng.integers(0, len(p), min(batch, len(p)))]
            x = np.vstack([bp, bu])
            h = np.tanh(x @ w[0] + w[1])
            z = h @ w[2] + w[3]
            s, k = _sigmoid(z), len(bp)
            up = np.zeros(len(x))  # gradient of the risk by the margin
            if prior is None:
                up[:k], up[k:] = (s[:k] - 1) / k, s[k:] / len(bu)
            else:
                negative = -np.log1p(-np.clip(s, 0, 1 - 1e-12))
                rest = negative[k:].mean() - prior * negative[:k].mean()
                up[:k], up[k:] = -prior * s[:k] / k, s[k:] / len(bu)
                if rest < 0:
                    up *= -1
                else:
                    up[:k] += prior * (s[:k] - 1) / k
            back = up[:, None] * w[2] * (1 - h**2)
            grads = [x.T @ back + decay * w[0], back.sum(0), h.T @ up + decay * w[2], up.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Network(mean, spread, w[0], w[1], w[2], float(w[3][0]))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: the least ratio of both tails of a ranking.

    Half of either set trains the ranking, the other half is ranked. Above a score that only
    positives reach, the tails differ by exactly this share; the slack covers small tails.
    """
    ranker = fit_risk(positive[::2], unlabelled[::2], None, epochs=20)
    p, u = np.sort(ranker.margin(positive[1::2])), np.sort(ranker.margin(unlabelled[1::2]))
    if not len(p) or not len(u):
        return 0.5
    cuts = np.unique(p)
    tail_p = 1 - np.searchsorted(p, cuts) / len(p)
    tail_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(np.log(20) / (2 * len(u))) + np.sqrt(np.log(20) / (2 * len(p)))
    best = np.argmin((tail_u + slack) / tail_p)
    return float(np.clip(tail_u[best] / tail_p[best], 0.02, 0.98))


def train(positives: list[str], unlabelled: list[str]) -> tuple[Network, float] | None:
    """The network and the estimated class prior; None without texts of either kind."""
    if len(positives) < 4 or len(unlabelled) < 4:
        return None
    p, u = (np.array([features(t) for t in texts]) for texts in (positives, unlabelled))
    prior = class_prior(p, u)
    return fit_risk(p, u, prior), prior


def unlabelled_sample(documents: DataFrame, folds: int, held_out: int, limit: int) -> list[str]:
    """At most ``limit`` texts outside the held-out fold, chosen by a hash of the id."""
    ids = (
        documents.select("doc_id").where(fold(F.col("doc_id"), folds) != held_out).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select(F.col("doc_id").alias("chosen"))
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("chosen"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(limit)
    return [r.text or "" for r in rows.toLocalIterator()]


def score(documents: DataFrame, network: Network | None) -> DataFrame:
    """doc_id and the score, from 0 to 1, of every text."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if network is None or texts.empty:
                yield pd.Series(np.full(len(texts), 0.5))
            else:
                yield pd.Series(_sigmoid(network.margin(np.array([features(t) for t in texts]))))

    return documents.select("doc_id", scores(F.coalesce("text", F.lit(""))).alias("score"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; labels of the held-out fold are never read."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where("quality = 1")
    positives = [t for _, t, _ in labelled_sample(documents, labels, "quality", FOLDS, HELD_OUT, POSITIVES)]
    model = train(positives, unlabelled_sample(documents, FOLDS, HELD_OUT, UNLABELLED))
    scored = score(documents, model and model[0])
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
