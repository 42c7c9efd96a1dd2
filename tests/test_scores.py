import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairlore import (
    collocations,
    contingency,
    integrity_audit,
    npmi_scores,
    npmi_sums,
    pair_counts,
    passing_scores,
)
from pairlore.functions import measures
from pairlore.operators import scores as S

from conftest import GOLDEN, rows

SCHEMA = "decade bigint, w1 string, w2 string, c12 bigint, c1 bigint, c2 bigint, n bigint"


def table(spark, *counts):
    return spark.createDataFrame(
        [(1990, f"w{i}", f"v{i}", *c) for i, c in enumerate(counts)], SCHEMA
    )


def scored(df):
    return {(r.w1, r.w2): r.npmi for r in df.collect()}


def test_worked_example(ngrams):
    counts = contingency(pair_counts(ngrams(*GOLDEN)))
    found = scored(npmi_scores(counts))
    assert {k: round(v, 6) for k, v in found.items()} == {
        ("rain", "deer"): 0.364070,
        ("rain", "fall"): 0.194283,
        ("snow", "fall"): 0.381124,
    }
    [(decade, total)] = rows(npmi_sums(counts))
    assert decade == 1990
    assert total == pytest.approx(0.939476, abs=1e-6)
    result = collocations(ngrams(*GOLDEN), 0.37, 0.38)
    assert rows(result, "w1", "w2") == [("snow", "fall"), ("rain", "deer")]
    assert result.columns == ["decade", "w1", "w2", "npmi"]


def test_perfect_pairs_only_on_request(ngrams):
    counts = contingency(pair_counts(ngrams(*GOLDEN)))
    assert ("global", "warming") not in scored(npmi_scores(counts))
    assert scored(npmi_scores(counts, include_perfect=True))[("global", "warming")] == 1.0


def test_sum_scope_all_adds_negative_and_perfect_pairs(ngrams):
    counts = contingency(pair_counts(ngrams(*GOLDEN)))
    negative = math.log(1 * 24 / (6 * 5)) / -math.log(1 / 24)
    [(_, total)] = rows(npmi_sums(counts, "all"))
    assert total == pytest.approx(0.939478 + negative + 1.0, abs=1e-5)
    with pytest.raises(ValueError):
        npmi_sums(counts, "some")


def test_decade_with_one_pair(ngrams):
    counts = contingency(pair_counts(ngrams(("rain deer", 7))))
    assert npmi_scores(counts).count() == 0
    assert rows(npmi_sums(counts)) == [(1990, 0.0)]
    assert collocations(ngrams(("rain deer", 7)), -1, -1).count() == 0
    # the sum is 0, and a share of it counts as infinite
    kept = collocations(ngrams(("rain deer", 7)), 2, 0.5, include_perfect=True)
    assert rows(kept) == [(1990, "rain", "deer", 1.0)]


def test_positive_is_exact_for_large_counts(spark):
    big = 5 * 10**9
    cases = table(
        spark,
        (4 * 10**9, big, big, 10**10),
        (2**61 + 1, 2**61 + 1, 2**61, 2**61),  # differ in the last bit of the product
        (2**61, 2**61, 2**61, 2**61),
        (2**61 - 1, 2**61, 2**61 - 1, 2**61),
        (3 * 10**9, 3 * 10**9 + 1, 3 * 10**9 - 1, 3 * 10**9),
    )
    got = [r[0] for r in cases.orderBy("w1").select(measures.is_positive()).collect()]
    want = [c12 * n > c1 * c2 for *_, c12, c1, c2, n in cases.orderBy("w1").collect()]
    assert got == want
    assert got.count(True) == 2


def test_independent_pair_is_not_positive(spark):
    assert npmi_scores(table(spark, (2, 4, 6, 12))).count() == 0
    assert npmi_scores(table(spark, (2, 4, 6, 13))).count() == 1


def test_zero_counts_go_to_the_audit_only(ngrams):
    counts = contingency(pair_counts(ngrams(*GOLDEN, ("brown wolf", 0), ("rain wolf", 0))))
    assert sorted(rows(integrity_audit(counts), "w1", "w2", "reason")) == [
        ("brown", "wolf", "c1 is zero"),
        ("brown", "wolf", "c12 is zero"),
        ("brown", "wolf", "c2 is zero"),
        ("rain", "wolf", "c12 is zero"),
        ("rain", "wolf", "c2 is zero"),
    ]
    assert len(scored(npmi_scores(counts))) == 3
    assert len(rows(npmi_sums(counts))) == 1


def test_order_is_numeric_descending(spark):
    values = spark.createDataFrame(
        [(1990, "cc", "d", 0.5), (1990, "aa", "b", 0.9998), (1980, "xx", "y", 0.1),
         (1990, "cc", "a", 0.5), (1990, "Zz", "a", 0.5)],
        "decade bigint, w1 string, w2 string, npmi double",
    )
    assert rows(S.by_descending_score(values), "decade", "w1", "w2") == [
        (1980, "xx", "y"), (1990, "aa", "b"), (1990, "Zz", "a"), (1990, "cc", "a"),
        (1990, "cc", "d"),
    ]


def test_thresholds_are_inclusive_and_ored(spark):
    values = spark.createDataFrame(
        [(1990, "a", "b", 0.5), (1990, "c", "d", 0.25), (1990, "e", "f", 0.125)],
        "decade bigint, w1 string, w2 string, npmi double",
    )
    sums = spark.createDataFrame([(1990, 1.0)], "decade bigint, sum_npmi double")

    def kept(a, b):
        return sorted(r[1] for r in rows(passing_scores(values, sums, a, b)))

    assert kept(0.5, 2) == ["a"]
    assert kept(2, 0.25) == ["a", "c"]
    assert kept(0.5, 0.125) == ["a", "c", "e"]
    assert kept(2, 2) == []


@pytest.mark.parametrize("bad", ["x", None, float("nan")])
def test_thresholds_are_checked_before_anything_runs(ngrams, bad):
    with pytest.raises((TypeError, ValueError)):
        collocations(ngrams(*GOLDEN), bad, 0.1)
    with pytest.raises((TypeError, ValueError)):
        collocations(ngrams(*GOLDEN), 0.1, bad)


def test_ways_to_join_decades_agree(ngrams):
    table = ngrams(*((n, c, y) for y in (1950, 1960, 1970) for n, c in GOLDEN))
    want = sorted(rows(collocations(table, 0.37, 0.38)))
    assert len(want) == 6
    assert sorted(rows(collocations(table, 0.37, 0.38, decade_join="shuffle"))) == want
    with pytest.raises(ValueError):
        collocations(table, 0.37, 0.38, decade_join="cross")


def test_hot_decade_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    decade = F.when(F.col("id") % 3 > 0, 1990).otherwise(1800 + 10 * (F.col("id") % 17)).cast("bigint")
    table = spark.range(0, 40_000, 1, 8).select(decade.alias("decade"), F.col("id").alias("c1"))
    totals = table.groupBy("decade").agg(F.sum("c1").alias("n"))
    joined = S.attach_per_decade(table, totals, "n", "shuffle")
    assert joined.count() == 40_000
    joined.collect()
    assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()


def test_audit_names_what_is_wrong(spark):
    table = spark.createDataFrame(
        [(1990, "a", "b", -4, 5, 9), (1990, "a", "c", 9, 5, 9), (1990, "d", "e", 1, None, 0)],
        "decade bigint, w1 string, w2 string, c12 bigint, c1 bigint, c2 bigint",
    )
    assert sorted(r[1:] for r in rows(integrity_audit(table))) == [
        ("a", "b", "c12 is negative"), ("d", "e", "c1 is missing"), ("d", "e", "c2 is zero"),
    ]


def test_sum_does_not_depend_on_row_order(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    sums = {
        df.repartition(k, F.rand(seed)).agg(measures.repeatable_sum(F.col("v"))).collect()[0][0]
        for k, seed in ((1, 1), (3, 2), (7, 3), (13, 4))
    }
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(math.fsum(values), abs=1e-8)


def random_ngrams(seed, size=400):
    rng = random.Random(seed)
    names = ["zulu", "yoyo", "kiwi", "Quux", "vodka", "jazz", "gypsy", "nymph"]
    return [
        (f"{rng.choice(names)} {rng.choice(names[:5])}", rng.randint(1, 9),
         rng.choice((1951, 1958, 1960, 1979)))
        for _ in range(size)
    ]


def brute_force(data, low, rel):
    c12, c1, c2, n = Counter(), Counter(), Counter(), Counter()
    for ngram, count, year in data:
        w1, w2 = ngram.split(" ")
        decade = year - year % 10
        c12[decade, w1, w2] += count
        c1[decade, w1] += count
        c2[decade, w2] += count
        n[decade] += count
    score, total = {}, Counter()
    for (d, a, b), k in c12.items():
        if k * n[d] > c1[d, a] * c2[d, b] and not k == c1[d, a] == c2[d, b]:
            score[d, a, b] = math.log(k * n[d] / (c1[d, a] * c2[d, b])) / -math.log(k / n[d])
            total[d] += score[d, a, b]
    return c12, c1, c2, n, {
        key: v for key, v in score.items() if v >= low or v / total[key[0]] >= rel
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(ngrams, seed):
    data = random_ngrams(seed)
    c12, c1, c2, n, want = brute_force(data, 0.05, 0.06)
    table = ngrams(*data)
    counts = contingency(pair_counts(table)).collect()
    assert len(counts) == len(c12)
    for r in counts:
        assert (r.c12, r.c1, r.c2, r.n) == (
            c12[r.decade, r.w1, r.w2], c1[r.decade, r.w1], c2[r.decade, r.w2], n[r.decade]
        )
        assert r.c12 <= min(r.c1, r.c2) <= r.n
    found = {(r.decade, r.w1, r.w2): r.npmi for r in collocations(table, 0.05, 0.06).collect()}
    assert found.keys() == want.keys()
    assert found == pytest.approx(want)
    assert all(0 < v < 1 for v in found.values())


def test_score_is_symmetric_in_the_word_roles(ngrams):
    data = random_ngrams(3)
    swapped = [(" ".join(reversed(n.split())), c, y) for n, c, y in data]
    one = scored(npmi_scores(contingency(pair_counts(ngrams(*data)))).where("decade = 1950"))
    two = scored(npmi_scores(contingency(pair_counts(ngrams(*swapped)))).where("decade = 1950"))
    assert {(b, a): v for (a, b), v in two.items()} == pytest.approx(one)


def test_thresholds_are_monotone(ngrams):
    table = ngrams(*random_ngrams(4))
    sizes = [collocations(table, t, 2).count() for t in (0.0, 0.02, 0.05, 0.1, 0.5)]
    assert sizes == sorted(sizes, reverse=True)


def test_fact_order_matches_a_plain_comparator(spark):
    import functools
    import random

    from pairlore import in_fact_order

    classes = {"N": 0, "Cw1w2": 1, "Cw1": 1, "Cw2": 1, "Npmi": 2, "SumNpmis": 2, "NpmiWithVal": 3}
    tags = list(classes)

    def words(a, b):  # absent words first
        for x, y in ((a[1], b[1]), (a[2], b[2])):
            if x != y:
                return -1 if x is None else 1 if y is None else (-1 if x < y else 1)
        return 0

    def compare(a, b):
        if a[0] != b[0]:
            return -1 if a[0] < b[0] else 1
        ca, cb = classes.get(a[3], 7), classes.get(b[3], 7)
        if ca != cb:
            return -1 if ca < cb else 1
        if ca == 3 and a[4] != b[4]:
            return -1 if a[4] > b[4] else 1
        result = words(a, b)
        if result:
            return result
        ra, rb = tags.index(a[3]) if a[3] in tags else 7, tags.index(b[3]) if b[3] in tags else 7
        if (ra, a[3]) != (rb, b[3]):
            return -1 if (ra, a[3]) < (rb, b[3]) else 1
        return 0 if a[4] == b[4] else (-1 if a[4] > b[4] else 1)

    rng = random.Random(3)
    rows = []
    for _ in range(400):
        tag = rng.choice(tags + ["Other"])
        w1 = None if tag in ("N", "Cw2", "SumNpmis") else rng.choice(["ab", "b", "zz", "é"])
        w2 = None if tag in ("N", "Cw1", "SumNpmis") else rng.choice(["ab", "b", "zz", "é"])
        rows.append((rng.choice([1950, 1960, 2000]), w1, w2, tag, float(rng.randint(-5, 5))))
    facts = spark.createDataFrame(rows, "decade long, w1 string, w2 string, tag string, value double")
    got = [tuple(r) for r in in_fact_order(facts).collect()]
    assert got == sorted(rows, key=functools.cmp_to_key(compare))
