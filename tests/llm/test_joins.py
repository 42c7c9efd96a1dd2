"""Near groups, neighbours, components and language-model scores against plain versions."""

import random

import brute
import numpy as np
import pytest
from llm_helpers import ODD, docs, tables  # noqa: F401
from pyspark.sql import functions as F

from pairlore.llm import components, jaccard, neighbours, ppm


def near_texts(rng):
    """Groups of copies, near copies of one another and chains of them, and unlike texts."""
    out = []
    for _ in range(12):
        words = [f"v{rng.randint(0, 300)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 8)):
            out.append(" ".join(words))
            if words and rng.random() < 0.8:
                words[rng.randrange(len(words))] = rng.choice(["new", "other", f"v{rng.randint(0, 300)}"])
    shared = " ".join(f"line{i}" for i in range(30))
    out += [f"{shared} {' '.join(f'u{k}x{i}' for i in range(rng.randint(1, 60)))}" for k in range(25)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("words, percent, seed", [(4, 85, 1), (5, 80, 2)])
def test_near_groups_equal_comparing_all_pairs(docs, words, percent, seed):
    rng = random.Random(seed)
    rows = [*ODD, *((100 + i, t) for i, t in enumerate(near_texts(rng)))]
    found = jaccard.near_groups(docs(*rows), words, percent).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    want = brute.near_groups(rows, words, percent)
    assert got == sorted(want, key=str)
    assert sum(i != c for i, _, c in want) > 20
    kept = jaccard.one_of_each(docs(*rows), words, percent)
    assert kept.columns == docs(*rows).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    first = sorted({c for _, n, c in want if n}, key=str) + [i for i, n, c in want if not n]
    assert ids == sorted(first, key=str)


def test_large_group_of_near_copies(docs):
    """A star: every text is near the middle one, few are near one another."""
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    rng = random.Random(3)
    for i in range(1, 150):
        words = list(base)
        for _ in range(rng.choice([1, 3, 5])):
            words[rng.randrange(200)] = f"n{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_groups(docs(*rows)).collect())
    assert got == sorted(brute.near_groups(rows))


def test_near_groups_of_nothing(docs):
    assert jaccard.near_groups(docs((1, "x")).where("false")).count() == 0
    assert jaccard.one_of_each(docs((1, "x")).where("false"), 5, 80).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(180)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: find(x) for x in parent if x not in alone}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------------------- neighbours
def plain_neighbours(rows, k=5):
    use = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            use[i] = np.array(v, dtype=np.float32).astype(float)
    out = {}
    for q in (i for i in use if i % 50 == 0):
        best = []
        for c, v in use.items():
            if c != q and len(v) == len(use[q]):
                a = neighbours.dot(use[q][None], v[None]) / (np.sqrt(neighbours.dot(use[q][None], use[q][None])) * np.sqrt(neighbours.dot(v[None], v[None])))
                best.append((-float(a[0]), c))
        for rank, (s, c) in enumerate(sorted(best)[:k], 1):
            out[q, rank] = (c, -s)
    return out


@pytest.mark.parametrize("block", [8192, 37])
def test_neighbours_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", block)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(60)]  # ties
    rows += [(2000 + i, [2 * x for x in rows[i][1]]) for i in range(5)]
    rows += [(3000, None), (3050, []), (3100, [0.0] * 16), (3150, [float("nan")] * 16), (3200, [None, *[1.0] * 15]), (None, [1.0] * 16),
             (3250, [1.0, 2.0, 3.0]), (3251, [1.0, 2.0, 4.0]), (3300, [1.0] * 7), (0, rows[0][1])]
    frame = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, score double, n int")
    found = neighbours.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    want = plain_neighbours(rows)
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found} == want and len(found) == len(want)
    assert neighbours.nearest(frame.where("false"), F.lit(True)).count() == 0


def test_codes_bound_the_product():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    code, scale, length, error = neighbours.codes(x)
    near = (code.astype(np.int64) @ code.T.astype(np.int64)) * scale[:, None] * scale
    assert (np.abs(near - x @ x.T) <= length[:, None] * error + error[:, None] + 1e-9).all()


# ----------------------------------------------------------------------------------- ppm
def test_scores_equal_the_trie(docs):
    rng = random.Random(7)
    rows = [*ODD[:8], (9, ODD[-1][1]), *((10 + i, " ".join(rng.choice(["the", "cat", "Sat", "on", "é", "mat!", "x" * rng.randint(1, 9)]) for _ in range(rng.randint(0, 60)))) for i in range(60))]
    frame = docs(*rows).withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0)
    for block in (ppm.BLOCK_BYTES, 500):
        found = ppm.score(frame, block_bytes=block).collect()
        got = sorted((tuple(r) for r in found), key=lambda r: (str(r[:4]), round(r[5], 6)))
        want = sorted(brute.ppm(rows), key=lambda r: (str(r[:4]), round(r[5], 6)))
        assert [r[:5] for r in got] == [r[:5] for r in want]
        np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], atol=1e-7)


def test_probabilities_of_a_context_sum_to_one():
    trie = brute.Trie(["the cat sat", "the mat", "a cat"])
    for context in (b"\0\0\0\0", b" cat", b"the ", b"zzzz"):
        assert sum(trie.probability(context, b) for b in range(256)) == pytest.approx(1)


def test_scores_without_training(docs):
    frame = docs((1, "ab"), (2, None)).withColumn("held_out", F.lit(True))
    found = {r.doc_id: r for r in ppm.score(frame).collect()}
    assert found[1].score == pytest.approx(-3 * np.log10(256)) and found[2].score == pytest.approx(-np.log10(256))
    assert (found[1].n_known, found[1].train_tokens, found[1].base_score) == (0, 0, pytest.approx(0))
    assert ppm.score(frame.where("false")).count() == 0
