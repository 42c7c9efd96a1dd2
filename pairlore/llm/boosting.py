"""Gradient-boosted trees for two classes, on numpy arrays.

Features are binned by quantiles once; trees grow level by level on histograms of the logistic
loss. A model is a small list of arrays that goes to the executors with the task. ``fit`` takes
arrays, ``fit_table`` a table of any size, whose histograms Spark adds up.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairlore.sources.scratch import saved

UNIT = 2.0**30  # parts of 1 that gradients are added up in, the same in any order


class Trees(NamedTuple):
    """Complete binary trees: ``feature`` and ``cut`` per inner node, ``leaf`` per leaf."""

    base: float
    feature: np.ndarray  # trees x (2^depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # trees x 2^depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 32,
    l2: float = 1.0,
    least: float = 1.0,
    weights: np.ndarray | None = None,
) -> Trees:
    """Trees for labels 0 and 1, or shares of 1; without rows or with one class only, a constant.

    ``weights`` are the numbers of rows that each one stands for, 1 by default.
    """
    x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
    n = np.ones(len(y)) if weights is None else np.asarray(weights, dtype=np.float64)
    rate_of_one = ((n * y).sum() + 0.5) / (n.sum() + 1.0)
    base = float(np.log(rate_of_one / (1 - rate_of_one)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(y) == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    margin, found = np.full(len(y), base), ([], [], [])
    columns = x.shape[1]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = n * (y - p), n * p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * columns + np.arange(columns)) * bins + binned
            size = width * columns * bins
            g = np.bincount(cell.ravel(), np.repeat(gradient, columns), size).reshape(width, columns, bins)
            h = np.bincount(cell.ravel(), np.repeat(weight, columns), size).reshape(width, columns, bins)
            gl, hl = g.cumsum(2), h.cumsum(2)
            gr, hr = gl[:, :, -1:] - gl, hl[:, :, -1:] - hl
            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - gl[:, :, -1:] ** 2 / (hl[:, :, -1:] + l2)
            gain[(hl < least) | (hr < least)] = 0
            for k in range(width):
                best = int(gain[k].argmax())
                f, b = divmod(best, bins)
                if gain[k].flat[best] > 1e-9 and b < len(edges[f]):
                    feature[first + k], cut[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        at = node - inner
        leaf = rate * np.bincount(at, gradient, leaves) / (np.bincount(at, weight, leaves) + l2)
        margin += leaf[at]
        for kept, value in zip(found, (feature, cut, leaf), strict=True):
            kept.append(value)
    return Trees(base, *map(np.stack, found))


def fit_table(
    rows: DataFrame,
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 32,
    l2: float = 1.0,
    least: float = 1.0,
) -> Trees:
    """``fit`` on all rows (x array<double>, label 0 or 1) of a table.

    Quantiles are exact and taken in Spark. The rows are binned once, to a byte a feature; each
    level of a tree is one pass over them, which hands on sums per node, feature and bin.
    """
    inner, leaves = 2**depth - 1, 2**depth
    seen = rows.agg(F.count("*").alias("n"), F.sum("label").alias("ones"), F.max(F.size("x")).alias("columns")).first()
    ones = seen.ones or 0
    rate_of_one = (ones + 0.5) / (seen.n + 1.0)
    base = float(np.log(rate_of_one / (1 - rate_of_one)))
    nothing = np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves))
    if ones in (0, seen.n):
        return Trees(base, *nothing)
    columns = seen.columns
    shares = F.array(*(F.lit(i / bins) for i in range(1, bins)))
    quantiles = rows.agg(*(F.percentile(F.get("x", F.lit(i)), shares).alias(f"q{i}") for i in range(columns))).first()
    edges = [np.unique(q) for q in quantiles]

    def bin_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=np.float64).reshape(-1, columns)
            binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
            yield pd.DataFrame({"bins": [r.tobytes() for r in binned.astype(np.uint8)], "label": batch["label"]})

    binned = saved(rows.select("x", "label").mapInPandas(bin_rows, "bins binary, label int"), "binned")
    grown = Trees(base, *nothing)  # cuts are numbers of bins here
    for _ in range(trees):
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            g, h = _histograms(binned, grown, feature, cut, level, columns, bins)
            gl, hl = g.cumsum(2), h.cumsum(2)
            gr, hr = gl[:, :, -1:] - gl, hl[:, :, -1:] - hl
            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - gl[:, :, -1:] ** 2 / (hl[:, :, -1:] + l2)
            gain[(hl < least) | (hr < least)] = 0
            sums = np.zeros((2, width, 2))  # of both sides of each node: at the last level, its leaves
            for k in range(width):
                f, b = divmod(int(gain[k].argmax()), bins)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + k], cut[first + k] = f, b
                    sums[:, k] = (gl[k, f, b], gr[k, f, b]), (hl[k, f, b], hr[k, f, b])
                else:
                    sums[:, k, 0] = gl[k, 0, -1], hl[k, 0, -1]
        leaf = (rate * sums[0] / (sums[1] + l2)).ravel()
        parts = zip(grown[1:], (feature, cut, leaf), strict=True)
        grown = Trees(base, *(np.concatenate([old, new[None]]) for old, new in parts))
    split = np.isfinite(grown.cut)
    cuts = np.full(grown.cut.shape, np.inf)
    cuts[split] = [edges[f][int(b)] for f, b in zip(grown.feature[split], grown.cut[split], strict=True)]
    return grown._replace(cut=cuts)


def _histograms(
    binned: DataFrame, grown: Trees, feature: np.ndarray, cut: np.ndarray, level: int, columns: int, bins: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients and weights by node of ``level`` of the tree begun, feature and bin."""
    shape = 2**level, columns, bins

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, int(np.prod(shape))), np.int64)
        for batch in batches:
            x = np.frombuffer(b"".join(batch["bins"]), np.uint8).reshape(-1, columns)
            p = grown.probability(x)
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(level):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            cell = ((node - (2**level - 1))[:, None] * columns + np.arange(columns)) * bins + x
            for own, value in zip(total, (batch["label"].to_numpy() - p, p * (1 - p)), strict=True):
                units = np.repeat(np.rint(value * UNIT), columns)
                own += np.bincount(cell.ravel(), units, len(own)).astype(np.int64)
        cells = np.flatnonzero(total.any(0))
        yield pd.DataFrame({"cell": cells, "g": total[0, cells], "h": total[1, cells]})

    found = binned.mapInPandas(sums, "cell long, g long, h long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    out = np.zeros((2, int(np.prod(shape))))
    for r in found.collect():  # at most a node's features and bins, for each node
        out[:, r.cell] = r.g / UNIT, r.h / UNIT
    return out[0].reshape(shape), out[1].reshape(shape)
