"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Every word enters with what training learned about it: how much more often the word itself
and its character n-grams occur in toxic texts. The network reads windows of words in both
directions, pools them by attention and gives each window a score. Windows of ``WINDOW`` words
start every ``STRIDE`` words over the whole text and stand for all overlapping windows: every word
lies in one, and a passage of up to WINDOW - STRIDE + 1 words lies whole in one; a longer passage
may lie whole in none. The highest window score is the text's, calibrated to a probability.

Nulls: a null text counts as empty; an empty text has no window and gets the lowest score, 0.
Without labels of both classes every score is 0. An empty table gives an empty result;
repeated rows give repeated rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.llm.common import fold, labelled_sample, table

FOLDS, HELD_OUT = 4, 2
SAMPLE = 6000  # labelled texts that the model is fitted on
THRESHOLD = 0.3
WINDOW, STRIDE = 32, 16  # words
HIDDEN = 8
GRAMS = (3, 4, 5)  # bytes, with a blank at either end of the word
BUCKETS = 1 << 18
PRIOR_COUNT = 8.0  # pseudo-texts that pull rare words and n-grams to no evidence
CHUNK = 1 << 20  # bytes of text that are turned into words at once
WINDOWS_AT_ONCE = 2048
INPUTS = 3 + 2 * len(GRAMS)

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int64)


class Words(NamedTuple):
    """Words as hash buckets, with the buckets of their character n-grams by length."""

    n: int
    word: np.ndarray
    length: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # buckets, first per word, has any


def read_words(words: list[bytes]) -> Words:
    """Hash buckets of ``words`` and of their character n-grams, all as arrays."""
    n = len(words)
    buffer = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint64)
    length = np.fromiter(map(len, words), dtype=np.int64, count=n)
    start = np.concatenate([[1], 1 + np.cumsum(length + 1)])[:-1] if n else np.zeros(0, np.int64)
    blank = buffer == 32
    grams = []
    for size in GRAMS:
        ends = len(buffer) - size + 1
        if not n or ends <= 0:
            grams.append((np.zeros(0, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)))
            continue
        h = np.zeros(ends, dtype=np.uint64)
        broken = np.zeros(ends, dtype=bool)
        for k in range(size):
            h = h * _MIX + buffer[k : k + ends] + np.uint64(1)
            if 0 < k < size - 1:
                broken |= blank[k : k + ends]
        at = np.flatnonzero(~broken)
        first = np.searchsorted(at, start - 1)  # n-grams that begin at the blank before the word
        after = np.searchsorted(at, start + length)
        grams.append((_bucket(h[at]), first, after > first))
    # A word's own hash: the sum of its bytes, each times a weight of its place in the word.
    inside = np.flatnonzero(~blank)
    if n:
        own = np.repeat(np.arange(n), length)
        offset = inside - start[own]
        weight = (np.minimum(offset, 63).astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _MIX
        value = (buffer[inside] + np.uint64(7)) * weight
        value ^= value >> np.uint64(31)
        value *= np.uint64(0x94D049BB133111EB)
        filled = length > 0
        total = np.zeros(n, dtype=np.uint64)
        total[filled] = np.add.reduceat(value, (np.cumsum(length) - length)[filled])
        word = _bucket(total + length.astype(np.uint64))
    else:
        word = np.zeros(0, np.int64)
    return Words(n, word, length, grams)


class Evidence(NamedTuple):
    """Smoothed log-odds of toxic against other texts, by hash bucket."""

    word: np.ndarray
    gram: np.ndarray

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """One row of network inputs per word."""
        w = read_words(words)
        out = np.zeros((w.n, INPUTS), dtype=np.float32)
        if not w.n:
            return out
        out[:, 0] = 1.0  # a word, not padding
        out[:, 1] = self.word[w.word]
        out[:, 2] = np.log1p(w.length) - 1.5
        for k, (bucket, first, some) in enumerate(w.grams):
            # One value more than there are n-grams: words at the end may have none.
            value = np.append(self.gram[bucket], np.float32(-np.inf))
            count = np.diff(np.append(first, len(bucket)))
            out[:, 3 + 2 * k] = np.where(some, np.maximum.reduceat(value, first), 0)
            value[-1] = 0
            out[:, 4 + 2 * k] = np.where(some, np.add.reduceat(value, first) / np.maximum(count, 1), 0)
        return out


def learn_evidence(texts: list[bytes], toxic: np.ndarray) -> tuple[Evidence, dict[int, Evidence]]:
    """Log-odds by the number of toxic and other texts that a bucket occurs in.

    Also, by class, the log-odds as a text of that class sees them if it is itself left out:
    the network must not learn from a text's own share in the counts.
    """
    counts = np.zeros((2, 2, BUCKETS))  # word or n-gram, class
    for text, label in zip(texts, toxic, strict=True):
        w = read_words(text.split())
        counts[0, label, np.unique(w.word)] += 1
        grams = [bucket for bucket, _, _ in w.grams]
        counts[1, label, np.unique(np.concatenate(grams))] += 1
    total = np.array([max(1, (toxic == 0).sum()), max(1, (toxic == 1).sum())], dtype=float)
    prior = PRIOR_COUNT * total / total.sum()

    def odds(other: np.ndarray, own: np.ndarray) -> Evidence:
        found = np.log((own + prior[1]) / prior[1]) - np.log((other + prior[0]) / prior[0])
        return Evidence(*np.clip(found, -3, 6).astype(np.float32))

    less = np.maximum(counts - 1, 0)
    return odds(counts[:, 0], counts[:, 1]), {
        0: odds(less[:, 0], counts[:, 1]), 1: odds(counts[:, 0], less[:, 1])
    }


def window_starts(n_words: int) -> np.ndarray:
    """Starts of all overlapping windows; the last one reaches the end."""
    return np.arange(0, max(1, n_words - WINDOW + STRIDE), STRIDE) if n_words else np.zeros(0, np.int64)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Network:
    """Weights by name: for each direction x, h (input and state to gates), b; then attention
    ``a`` and output ``w``, ``c``. Gates stand in the order update, reset, new state."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.weights: dict[str, np.ndarray] = {}
        for d in "fb":
            self.weights |= {
                f"x{d}": rng.normal(0, 0.3, (INPUTS, 3 * HIDDEN)), f"h{d}": rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)),
                f"b{d}": np.zeros(3 * HIDDEN),
            }
        self.weights |= {"a": rng.normal(0, 0.3, 2 * HIDDEN), "w": rng.normal(0, 0.3, 2 * HIDDEN), "c": np.zeros(1)}

    def single(self) -> Network:
        """A copy in single precision, for ``infer``."""
        copy = Network()
        copy.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}
        return copy

    def _run(self, d: str, gates: np.ndarray, keep: list | None) -> np.ndarray:
        """States of one direction; ``gates``: windows x words x inputs to the gates."""
        h2g, n = self.weights[f"h{d}"], HIDDEN
        h = np.zeros((gates.shape[0], n), dtype=gates.dtype)
        states = np.empty((*gates.shape[:2], n), dtype=gates.dtype)
        steps = range(gates.shape[1]) if d == "f" else range(gates.shape[1] - 1, -1, -1)
        for t in steps:
            own = h @ h2g
            both = _sigmoid(gates[:, t, : 2 * n] + own[:, : 2 * n])
            update, reset = both[:, :n], both[:, n:]
            new = 2 * _sigmoid(2 * (gates[:, t, 2 * n :] + reset * own[:, 2 * n :])) - 1
            if keep is not None:
                keep.append((t, h, own, update, reset, new))
            h = new + update * (h - new)
            states[:, t] = h
        return states

    def margin(self, gates: dict[str, np.ndarray], real: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Window scores; ``real``: windows x words, false where padded."""
        w = self.weights
        kept = {"f": None, "b": None} if keep is None else {"f": [], "b": []}
        states = np.concatenate([self._run(d, gates[d], kept[d]) for d in "fb"], axis=2)
        score = np.where(real, states @ w["a"], -np.inf)
        share = np.exp(score - score.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", share, states)
        if keep is not None:
            keep |= {"steps": kept, "states": states, "share": share, "pooled": pooled}
        return pooled @ w["w"] + w["c"][0]

    def infer(self, x: np.ndarray, at: np.ndarray, real: np.ndarray) -> np.ndarray:
        """``margin`` of windows whose words are rows ``at`` of ``x``, for scoring only.

        The inputs to the gates are worked out once per word, not once per window, and of a
        state only its products with the attention and output weights are kept. Gates use
        sigmoid(z) = (1 + tanh(z / 2)) / 2 with the half folded into the weights.
        """
        n = HIDDEN
        half = np.repeat(np.array([0.5, 1.0], dtype=np.float32), [2 * n, n])
        by_step = np.ascontiguousarray(at.T)
        scores = np.zeros((len(by_step), len(at), 2), dtype=np.float32)
        for d, part in (("f", slice(0, n)), ("b", slice(n, 2 * n))):
            gates = (x @ self.weights[f"x{d}"] + self.weights[f"b{d}"]) * half
            h2g = self.weights[f"h{d}"] * half
            out = np.stack([self.weights["a"][part], self.weights["w"][part]], axis=1)
            h = np.zeros((len(at), n), dtype=np.float32)
            for t in range(len(by_step)) if d == "f" else range(len(by_step) - 1, -1, -1):
                gate = gates.take(by_step[t], axis=0)
                own = h @ h2g
                both = np.tanh(gate[:, : 2 * n] + own[:, : 2 * n]) * np.float32(0.5) + np.float32(0.5)
                new = np.tanh(gate[:, 2 * n :] + both[:, n:] * own[:, 2 * n :])
                h = new + both[:, :n] * (h - new)
                scores[t] += h @ out
        attention = np.where(real.T, scores[:, :, 0], -np.inf)
        share = np.exp(attention - attention.max(axis=0))
        return (share * scores[:, :, 1]).sum(axis=0) / share.sum(axis=0) + self.weights["c"][0]

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.weights[f"x{d}"] + self.weights[f"b{d}"] for d in "fb"}

    def gradients(self, x: np.ndarray, real: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted logistic loss and its gradient by back-propagation through time."""
        w, n, kept = self.weights, HIDDEN, {}
        p = _sigmoid(self.margin(self.gates(x), real, kept))
        loss = -(importance * (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))).sum()
        up = importance * (p - y)
        states, share, pooled = kept["states"], kept["share"], kept["pooled"]
        out = {"w": pooled.T @ up, "c": up.sum(keepdims=True)}
        to_pooled = up[:, None] * w["w"]
        along = np.einsum("nh,nth->nt", to_pooled, states)
        to_score = share * (along - (share * along).sum(axis=1, keepdims=True))
        out["a"] = np.einsum("nt,nth->h", to_score, states)
        to_states = share[:, :, None] * to_pooled[:, None, :] + to_score[:, :, None] * w["a"]
        for d, part in (("f", slice(0, n)), ("b", slice(n, 2 * n))):
            h2g = w[f"h{d}"]
            out |= {f"x{d}": np.zeros_like(w[f"x{d}"]), f"h{d}": np.zeros_like(h2g), f"b{d}": np.zeros_like(w[f"b{d}"])}
            back = np.zeros_like(kept["steps"][d][0][1])
            for t, h, own, update, reset, new in reversed(kept["steps"][d]):
                back = back + to_states[:, t, part]
                d_new = back * (1 - update) * (1 - new**2)
                d_update = back * (h - new) * update * (1 - update)
                d_reset = d_new * own[:, 2 * n :] * reset * (1 - reset)
                d_gates = np.concatenate([d_update, d_reset, d_new], axis=1)
                d_own = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                out[f"x{d}"] += x[:, t].T @ d_gates
                out[f"b{d}"] += d_gates.sum(axis=0)
                out[f"h{d}"] += h.T @ d_own
                back = back * update + d_own @ h2g.T
        return float(loss), out


class ToxicityModel(NamedTuple):
    evidence: Evidence
    network: Network
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * margin + self.shift)

    def score(self, texts: list[str]) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        for part in _parts(texts):
            words = [split(texts[i]) for i in part]
            best[part] = best_windows(self.evidence, self.network, words)
        return np.where(np.isfinite(best), self.probability(np.where(np.isfinite(best), best, 0)), 0.0)


def split(text: str) -> list[bytes]:
    """Words of the whole text, A-Z lower-cased."""
    return text.encode("utf-8", "replace").lower().split()


def _parts(texts: list[str]) -> Iterator[list[int]]:
    """Consecutive texts of about CHUNK characters together."""
    part, size = [], 0
    for i, text in enumerate(texts):
        part.append(i)
        size += len(text)
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def _windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and end of every window, words numbered through all texts."""
    starts = [window_starts(n) for n in lengths]
    owner = np.repeat(np.arange(len(lengths)), [len(s) for s in starts])
    before = np.cumsum(lengths) - lengths
    first = np.concatenate([*starts, np.zeros(0, np.int64)]).astype(np.int64) + before[owner]
    return owner, first, (before + lengths)[owner]


def best_windows(evidence: Evidence, network: Network, texts: list[list[bytes]]) -> np.ndarray:
    """The highest window score of every text; -inf without words."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    best = np.full(len(texts), -np.inf)
    owner, first, end = _windows(lengths)
    if not len(owner):
        return best
    words = [w for t in texts for w in t]
    step = 1 << 18  # words whose inputs are held at once
    for lo in range(0, len(owner), WINDOWS_AT_ONCE):
        part = slice(lo, lo + WINDOWS_AT_ONCE)
        low, high = first[part][0], min(len(words), first[part][-1] + WINDOW)
        x = np.concatenate([evidence.inputs(words[i : min(i + step, high)]) for i in range(low, high, step)])
        x = np.concatenate([x, np.zeros((1, INPUTS), np.float32)])  # padding comes last
        place = first[part][:, None] + np.arange(WINDOW)
        real = place < end[part][:, None]
        at = np.where(real, place - low, len(x) - 1)
        np.maximum.at(best, owner[part], network.infer(x, at, real))
    return best


def _training_windows(evidence: dict[int, Evidence], texts: list[bytes], labels: np.ndarray, network: Network | None, rng: np.random.Generator):
    """For each text its key window, and for the others of it one drawn at random.

    The key window is the one with the highest score, before the first round the one with
    the most evidence.
    """
    rows, reals, owners, keys = [], [], [], []
    for i, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        x = evidence[int(labels[i])].inputs(words)
        x = np.concatenate([x, np.zeros((1, INPUTS), np.float32)])
        place = window_starts(len(words))[:, None] + np.arange(WINDOW)
        real = place < len(words)
        at = np.where(real, place, len(words))
        windows = x[at]
        if network is None:
            worth = windows[:, :, 1].max(axis=1) + windows[:, :, 5].max(axis=1) + windows[:, :, 7].max(axis=1)
        else:
            worth = network.infer(x, at, real)
        chosen = dict.fromkeys([int(worth.argmax()), int(rng.integers(len(windows)))])
        for k, c in enumerate(chosen):
            rows.append(windows[c].copy())  # a view would keep all windows of the text
            reals.append(real[c].copy())
            owners.append(i)
            keys.append(k == 0)
    return np.array(rows, dtype=np.float64), np.array(reals), np.array(owners), np.array(keys)


def fit(texts: list[str], labels: list[int], rounds: int = 2, epochs: int = 5, rate: float = 0.01, seed: int = 3) -> ToxicityModel | None:
    """Evidence and network from 85 % of the texts, calibration from the others.

    Key windows of a toxic text are toxic; all windows of the others are not. A toxic text's
    random window teaches nothing and is left out.
    """
    y = np.array(labels, dtype=np.int64)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    raw = [t.encode("utf-8", "replace").lower() for t in texts]
    calibration = np.zeros(len(y), dtype=bool)
    for label in (0, 1):
        own = rng.permutation(np.flatnonzero(y == label))
        calibration[own[: len(own) * 15 // 100]] = True
    training = [raw[i] for i in np.flatnonzero(~calibration)]
    own_y = y[~calibration]
    evidence, left_out = learn_evidence(training, own_y)
    network, moments, step = Network(seed), None, 0
    for k in range(rounds):
        x, real, owner, key = _training_windows(left_out, training, own_y, network.single() if k else None, rng)
        target = own_y[owner].astype(float)
        use = np.flatnonzero(key | (target == 0))
        x, real, target = x[use], real[use], target[use]
        weight = np.where(target == 1, 0.5 / max(1, target.sum()), 0.5 / max(1, (1 - target).sum()))
        weight *= len(target)
        for _ in range(epochs):
            order = rng.permutation(len(target))
            for lo in range(0, len(order), 128):
                b = order[lo : lo + 128]
                _, grads = network.gradients(x[b], real[b], target[b], weight[b] / len(b))
                moments = moments or {n: (np.zeros_like(g), np.zeros_like(g)) for n, g in grads.items()}
                step += 1
                for name, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m, v = moments[name]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    network.weights[name] = network.weights[name] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    network = network.single()
    best = np.array([best_windows(evidence, network, [raw[i].split()])[0] for i in np.flatnonzero(calibration)])
    known = np.isfinite(best)
    slope, shift = calibrate(best[known], y[calibration][known].astype(float))
    return ToxicityModel(evidence, network, slope, shift)


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps on smoothed labels."""
    if len(y) == 0 or y.min() == y.max():
        return 1.0, 0.0
    ones, zeros = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.column_stack([margin, np.ones_like(margin)])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (w - [1.0, 0.0])), -1, 1)
    return max(float(w[0]), 1e-3), float(w[1])


def train(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE, folds: int = FOLDS, held_out: int = HELD_OUT) -> ToxicityModel | None:
    """A model from at most ``limit`` labelled texts outside the held-out fold."""
    sample = labelled_sample(documents, labels, "toxic", folds, held_out, limit)
    return fit([t for _, t, _ in sample], [y for _, _, y in sample])


def score(documents: DataFrame, model: ToxicityModel | None, column: str = "score") -> DataFrame:
    """``documents`` with a score from 0 to 1 of every whole text in ``column``."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.zeros(len(texts)) if model is None else model.score(texts.tolist()), dtype=float)

    return documents.withColumn(column, scores(F.coalesce("text", F.lit(""))))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; labels of the held-out fold are never read."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    return score(documents, model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
