"""What the large queries move: each table once, and nothing that a smaller one can carry."""

import re

import __spark_entry__ as entry
from conftest import GOLDEN, rows
from pyspark.sql import functions as F

from pairlore import (
    collocations, contingency, in_fact_order, integrity_audit, ngrams_from_text, pair_counts, read_ngrams, write_sequence_file,
)
from pairlore.operators.counts import word_keys
from pairlore.operators.scores import contingency_in_place


def exchanges(df):
    """The shuffles of the plan that ran, reused ones once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.split("\n") if re.search(r"[:+]- Exchange ", line)]


def test_a_text_table_shuffles_its_texts_and_its_counts(spark):
    rows_in = [(1, "a b a b"), (1, "b a"), (2, "a b"), (None, "a b"), (None, "a b c"), (3, None), (4, "")]
    texts = spark.createDataFrame(rows_in, "id bigint, body string")
    found = ngrams_from_text(texts, "body", F.lit(1999).cast("bigint"), "id")
    assert sorted(rows(found)) == [(1999, "a b", 5, 2), (1999, "b a", 2, 1), (1999, "b c", 1, 0)]
    moved = exchanges(found)
    assert len(moved) == 2 and not any("document" in e and "ngram" in e for e in moved), moved


def test_collocations_shuffle_pairs_once_per_use(ngrams):
    found = collocations(ngrams(*GOLDEN, ("ring plate", 3), ("ring deer", 1)), 0.1, 0.2)
    moved = exchanges(found)
    ranges = [e for e in moved if "rangepartitioning" in e]
    assert len(ranges) == 1 and "REPARTITION_BY_COL" in ranges[0], moved  # scores lie in result order
    assert not any(re.search(r"hashpartitioning\(decade#\d+L?, \d+\), ENSURE", e) and "w1" in e for e in moved), moved
    assert sum("REPARTITION_BY_COL" in e for e in moved) == 3, moved  # by first word, by second word, by score


def test_in_place_counts_equal_the_split_ones(spark):
    pairs = spark.createDataFrame(
        [(1950, "aa", "bb", 4), (1950, "aa", "cc", 0), (1950, "dd", "bb", -3), (1960, "aa", "bb", None),
         (1960, "ee", "bb", 2), (1950, "aa", "bb", 4), (1950, "xx", "yy", 2**62)],
        "decade bigint, w1 string, w2 string, c12 bigint",
    )
    key = lambda r: tuple((v is None, v) for v in r)
    want = sorted(rows(contingency(pairs)), key=key)
    assert sorted(rows(contingency_in_place(pairs)), key=key) == want and len(want) == 7


def test_the_table_moves_pairs_once_per_word(ngrams):
    """Two shuffles of the pairs beside their count; none of marginals, no sort-merge join."""
    data = (*GOLDEN, ("ring plate", 3), ("ring deer", 1), ("rain 4x", 2), ("x\nb deer", 2), ("snow deer", 7, 1961))
    table = contingency(pair_counts(ngrams(*data)))
    moved = exchanges(table)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert sum("REPARTITION_BY_COL" in e for e in moved) == 2 and len(moved) == 4, moved  # pairs, totals
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") <= 2, plan
    assert sorted(rows(table)) == sorted(rows(contingency(pair_counts(ngrams(*data)), "shuffle")))


def test_the_audit_does_not_work_out_totals(ngrams):
    audited = integrity_audit(contingency(pair_counts(ngrams(*GOLDEN, ("snow rain", 0), ("hail storm", -1)))))
    assert len(exchanges(audited)) == 3 and len(rows(audited)) == 5


def test_sequence_files_are_compressed_blocks(spark, tmp_path):
    lines = spark.createDataFrame([("rain deer\t1994\t4\t1",), ("snow fall\t1995\t5\t1",)], "value string")
    path = tmp_path / "seq"
    write_sequence_file(lines, str(path))
    assert any(b"Lz4Codec" in p.read_bytes() for p in path.glob("part-*"))
    found = read_ngrams(spark, str(path), "sequencefile")
    assert sorted(rows(found)) == [("rain deer", 1994, 4), ("snow fall", 1995, 5)]
    assert len(rows(pair_counts(found))) == 2


def test_ordered_facts_join_once(spark):
    plan = entry.queries()["ordered_facts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    assert "Join" not in plan.toString() and "contingency" in plan.toString()


def test_a_sorted_table_needs_no_sort_of_its_own(ngrams, spark):
    """A sort per word, as without the order; the rows of a partition lie by first word."""
    data = [(f"{a} {b}", 1 + (i * j) % 5, year) for i, a in enumerate(("rain", "snow", "hail", "cold"))
            for j, b in enumerate(("deer", "fall", "storm")) for year in (1994, 1961, 1967)]
    pairs = pair_counts(ngrams(*data))
    table = contingency(pairs, sort=True)
    assert sorted(rows(table)) == sorted(rows(contingency(pairs))) == sorted(rows(contingency(pairs, "shuffle", sort=True)))
    plan = table._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"[:+]- (?:\* )?\*?(?:\(\d+\) )?Sort \[", plan)) == 2, plan
    parts = [[(r.w1, r.decade, r.w2) for r in part] for part in table.rdd.glom().collect()]
    assert all(part == sorted(part) for part in parts) and max(map(len, parts)) > 2


def test_facts_are_sorted_by_columns(spark):
    """Neither the exchange nor the sort looks a tag up; facts of one pair share a range."""
    facts = [(1990, "ab", "cd", t, float(v)) for t in ("Cw2", "Npmi", "Odd", "Cw1", None) for v in (1, 3, 2)]
    facts += [(None, "ab", "cd", "N", None), (40000, None, None, "N", 1.0), (-40000, "", "x", "NpmiWithVal", 0.5)]
    listed = in_fact_order(spark.createDataFrame(facts, "decade bigint, w1 string, w2 string, tag string, value double"))
    moved = exchanges(listed)
    plan = listed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    sorts = [line for line in plan.split("\n") if "Sort [" in line]
    assert len(moved) == 1 and "rangepartitioning" in moved[0] and "value" not in moved[0].split("w1")[1], moved
    assert len(sorts) == 1 and "map(" not in sorts[0] + moved[0], sorts
    assert listed.columns == ["decade", "w1", "w2", "tag", "value"]
    got = [(r.decade, r.tag, r.value) for r in listed.collect()]
    assert got[0] == (-40000, "NpmiWithVal", 0.5) and got[-2:] == [(40000, "N", 1.0), (None, "N", None)]
    assert [g[1:] for g in got[1:-2]] == [
        (t, v) for t in ("Cw1", "Cw2", "Npmi", "Odd", None) for v in (3.0, 2.0, 1.0)
    ]


def test_ngrams_lie_by_first_word_for_the_job(spark):
    """Counts laid out by first word and decade are not shuffled again to count pairs and first words."""
    texts = spark.createDataFrame(
        [(1, 1951, "rain deer rain deer"), (1, 1951, "rain deer"), (2, 1952, "rain deer snow fall"), (2, 1952, None),
         (None, 1951, "rain deer hail"), (None, 1951, "rain deer hail"), (3, 1961, "snow fall x rain  fall"), (4, 1962, "")],
        "id bigint, y bigint, body string",
    )
    plain, laid = (ngrams_from_text(texts, "body", F.col("y"), "id", keys) for keys in ((), word_keys()))
    assert laid.dtypes == plain.dtypes
    assert sorted(rows(laid)) == sorted(rows(plain)) and (1951, "rain deer", 5, 1) in rows(laid)
    found = collocations(laid, 0.1, 0.2, laid_out=True)
    moved = exchanges(found)  # of rows: texts, counts, pairs by second word, scores
    assert not any(re.search(r"hashpartitioning\(decade#\d+L?, w1#\d+, w2", e) for e in moved), moved
    assert sum("REPARTITION_BY_COL" in e for e in moved) == 4, moved
    for other in (collocations(plain, 0.1, 0.2), collocations(plain, 0.1, 0.2, laid_out=True), collocations(laid, 0.1, 0.2)):
        assert rows(found) == rows(other) != []


def test_lazy_collocations_shuffle_pairs_three_times(spark):
    moved = exchanges(entry.queries()["collocations_lazy"](spark, "/root/testdata/sf0.001"))
    wide = [e for e in moved if "REPARTITION_BY_COL" in e]
    assert len(wide) == 4 and "share" in wide[-1] and "substring_index" in wide[-2], wide
    assert not any("ENSURE" in e and "w1" in e for e in moved), moved


def test_counts_in_place_leave_out_pairs_without_a_key(spark):
    pairs = spark.createDataFrame(
        [(1950, "aa", "bb", 4), (1950, None, "bb", 3), (None, "aa", "bb", 2), (1950, "aa", None, 1)],
        "decade bigint, w1 string, w2 string, c12 bigint",
    )
    assert rows(contingency_in_place(pairs, laid_out=True)) == rows(contingency(pairs)) == [(1950, "aa", "bb", 4, 4, 4, 4)]
