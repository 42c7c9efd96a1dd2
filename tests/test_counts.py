import pytest
from pyspark.sql import functions as F

from pairlore import (
    accepted_bigrams,
    by_second_word,
    by_words_nulls_first,
    decade_totals,
    first_word_counts,
    multi_level_counts,
    pair_counts,
    second_word_counts,
)

from conftest import GOLDEN, rows


@pytest.mark.parametrize(
    ("ngram", "kept"),
    [
        ("global warming", True),
        ("global warming ", True),
        ("global warming   ", True),
        ("global\u00a0x warming", True),
        ("global  warming", False),
        (" global warming", False),
        (" warming", False),
        ("global", False),
        ("global ", False),
        ("rain deer fall", False),
        ("", False),
        ("   ", False),
        (None, False),
        ("global x", False),
        ("ring plate", False),
        ("red plate", False),
        ("The plate", True),
        ("the plate", False),
        ("plate the", False),
        ("mp3 player", False),
        ("player mp3", False),
        ("٣٣ player", True),
    ],
)
def test_accepted(ngrams, ngram, kept):
    assert accepted_bigrams(ngrams((ngram, 1))).count() == kept


def test_words_are_split_without_trailing_space(ngrams):
    assert rows(accepted_bigrams(ngrams(("global warming  ", 3)))) == [
        (1990, "global", "warming", 3)
    ]


@pytest.mark.parametrize("ngram", ["ring plate", "red plate"])
def test_exact_mode_keeps_parts_of_entries(ngrams, ngram):
    assert accepted_bigrams(ngrams((ngram, 1)), stopword_mode="exact").count() == 1


def test_split_words_are_taken_as_they_are(spark):
    table = spark.createDataFrame(
        [("rain", "deer", 1994, 2), ("the", "deer", 1994, 2), ("mp3", "deer", 1994, 1)],
        "w1 string, w2 string, year bigint, match_count int",
    )
    assert rows(accepted_bigrams(table)) == [(1990, "rain", "deer", 2)]


def test_decades(ngrams):
    years = (1989, 1990, 1999, 2000, 7, -5, -15)
    found = accepted_bigrams(ngrams(*(("rain deer", i, y) for i, y in enumerate(years))))
    assert [r[0] for r in sorted(rows(found, "match_count", "decade"))] == list(range(7))
    by_count = dict(rows(found, "match_count", "decade"))
    assert [by_count[i] for i in range(7)] == [1980, 1990, 1990, 2000, 0, 0, -10]


def test_counts_of_the_worked_example(ngrams):
    pairs = pair_counts(ngrams(*GOLDEN, ("rain deer", 0, 1999)))
    assert sorted(rows(pairs)) == [
        (1990, "global", "warming", 8),
        (1990, "rain", "deer", 4),
        (1990, "rain", "fall", 6),
        (1990, "snow", "deer", 1),
        (1990, "snow", "fall", 5),
    ]
    assert sorted(rows(first_word_counts(pairs))) == [
        (1990, "global", 8), (1990, "rain", 10), (1990, "snow", 6)
    ]
    assert sorted(rows(second_word_counts(pairs))) == [
        (1990, "deer", 5), (1990, "fall", 11), (1990, "warming", 8)
    ]
    assert rows(decade_totals(pairs)) == [(1990, 24)]


def test_words_keep_case_and_pairs_keep_order(ngrams):
    pairs = pair_counts(ngrams(("Rain deer", 1), ("rain deer", 2), ("deer rain", 4)))
    assert sorted(rows(pairs, "w1", "w2", "c12")) == [
        ("Rain", "deer", 1), ("deer", "rain", 4), ("rain", "deer", 2)
    ]


def test_each_decade_has_its_own_marginals(ngrams):
    pairs = pair_counts(ngrams(("zeta deer", 3, 1985), ("zeta fall", 5, 1995)))
    assert sorted(rows(first_word_counts(pairs))) == [(1980, "zeta", 3), (1990, "zeta", 5)]


def test_sum_overflow_is_an_error(ngrams):
    big = 2**62
    table = ngrams(("rain deer", big), ("rain deer", big))
    with pytest.raises(Exception, match="overflow"):
        pair_counts(table).collect()


def test_multi_level_counts_are_the_four_counts(ngrams):
    table = ngrams(*GOLDEN, ("rain deer", 9, 2004))
    pairs = pair_counts(table)
    expected = (
        [(*r[:3], "Cw1w2", r[3]) for r in rows(pairs)]
        + [(d, w, None, "Cw1", c) for d, w, c in rows(first_word_counts(pairs))]
        + [(d, None, w, "Cw2", c) for d, w, c in rows(second_word_counts(pairs))]
        + [(d, None, None, "N", c) for d, c in rows(decade_totals(pairs))]
    )
    assert sorted(rows(multi_level_counts(table)), key=str) == sorted(expected, key=str)


def test_multi_level_counts_cascade_without_expanding_raw_rows(ngrams):
    table = ngrams(*GOLDEN, ("rain deer", 9, 2004))
    levels = multi_level_counts(table)
    assert "Expand" not in levels._jdf.queryExecution().executedPlan().toString()
    levels.collect()
    final = levels._jdf.queryExecution().executedPlan().toString()
    # the raw rows go through one exchange, into pairs; the other three levels reuse it
    assert final.count("ReusedExchange") == 3, final


def test_listing_orders(ngrams):
    table = ngrams(*GOLDEN, ("rain deer", 9, 2004))
    listed = rows(by_second_word(pair_counts(table)), "decade", "w2", "w1")
    assert listed == sorted(listed)
    counts = rows(by_words_nulls_first(multi_level_counts(table)), "decade", "w1", "w2")
    key = [(d, w1 is not None, w1 or "", w2 is not None, w2 or "") for d, w1, w2 in counts]
    assert key == sorted(key)


def test_volume_count_is_not_read(spark, ngrams, tmp_path):
    path = str(tmp_path / "n")
    ngrams(*GOLDEN).withColumn("volume_count", F.lit(1)).write.parquet(path)
    plan = pair_counts(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "volume_count" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("bound", [10, 200_000])
def test_own_lists_of_any_size_match_the_list_text(ngrams, monkeypatch, bound):
    from pairlore.functions import words as W

    monkeypatch.setattr(W, "FRAGMENTS_IN_PLAN", bound)
    own = ["rainfall", "deer", "zz\nqq", "snow", "é€x"]
    table = ngrams(
        *GOLDEN, ("infal deer", 3), ("ow fall", 2), ("qq zz", 1), ("z\nq tree", 4), ("€x tree", 5),
        ("fall tree", 6), ("xx yy", 7),
    )
    text = "\n".join(own)

    def covered(w):
        return len(w) < 2 or any(c.isdigit() for c in w) or w in text

    want = {}
    for r in table.collect():
        parts = r.ngram.rstrip(" ").split(" ")
        if len(parts) == 2 and not covered(parts[0]) and not covered(parts[1]):
            key = (r.year - r.year % 10, parts[0], parts[1])
            want[key] = want.get(key, 0) + r.match_count
    got = {(r.decade, r.w1, r.w2): r.c12 for r in pair_counts(table, own).collect()}
    assert W.needs_join(own, "substring") == (bound == 10)
    assert got == want
