import hashlib
import time
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairlore import accepted_bigrams, is_stop_word, two_word_ngrams, without_listed_words
from pairlore.functions import words as W

from conftest import rows


def words_df(spark, words):
    return spark.createDataFrame([(w,) for w in words], "w string")


def rejected(spark, words, **options):
    df = words_df(spark, words).where(is_stop_word("w", **options))
    return {r.w for r in df.collect()}


def test_list_sizes():
    assert len(W.ENGLISH) == 319
    assert (len(W.HEBREW), len(set(W.HEBREW))) == (150, 149)
    assert len(W.SYMBOLS) == 13
    assert len(set(W.default_stop_words())) == 480
    assert len(W.stop_text()) == 2493


def test_list_text():
    digest = hashlib.sha256(W.stop_text().encode()).hexdigest()
    assert digest == "113c681327b7cf4ce5d56a5d7f8bed93a82b3bc270d5a1d093890f7bdf3d993b"
    kept = Path(__file__).with_name("stop_words.txt").read_text(encoding="utf-8")
    assert kept == W.stop_text() + "\n"


def test_large_own_list_is_planned_quickly(spark):
    own = [f"w{i}ord" for i in range(100_000)]
    rejected(spark, ["plate"], stop_words=["warm", "up"])
    started = time.monotonic()
    plan = words_df(spark, ["x"]).where(W.is_listed("w", own))
    plan._jdf.queryExecution().executedPlan()
    assert time.monotonic() - started < 2
    assert {r.w for r in words_df(spark, ["w7o", "plate"]).where(W.is_listed("w", own)).collect()} == {"w7o"}


def test_substring_mode_drops_parts_of_entries(spark):
    tested = ["ring", "red", "east", "art", "the", "The", "plate", "a", "", "?", "של", "שלום"]
    assert rejected(spark, tested) == {"ring", "red", "east", "art", "the", "a", "", "?", "של"}


def test_exact_mode_drops_entries_only(spark):
    tested = ["ring", "red", "the", "The", "plate", "של"]
    assert rejected(spark, tested, mode="exact") == {"the", "של"}


def test_digits_are_ascii_only(spark):
    assert rejected(spark, ["mp3", "٣٣", "x2y", "plate"]) == {"mp3", "x2y"}


def test_short_counts_utf16_units(spark):
    # one supplementary character is two units, one Hebrew letter is one
    assert rejected(spark, ["🦆", "é", "ק", "zz"]) == {"é", "ק"}


def test_word_with_newline_may_span_entries(spark):
    assert rejected(spark, ["the\ntheir", "the\nplate"]) == {"the\ntheir"}


def test_own_list_with_quotes_and_backslashes(spark):
    own = ["it's", "a\\b", 'say"so', "ducks🦆"]
    tested = ["it's", "'s", "\\b", 'y"s', "ks🦆", "🦆", "its", "plate"]
    assert rejected(spark, tested, stop_words=own) == {"it's", "'s", "\\b", 'y"s', "ks🦆", "🦆"}
    assert rejected(spark, tested, stop_words=own, mode="exact") == {"it's"}


def test_empty_list(spark):
    assert rejected(spark, ["the", "x"], stop_words=[]) == {"x"}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        is_stop_word("w", mode="prefix")


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.text(alphabet="abcdehinrstw\n'", min_size=0, max_size=6),
            st.sampled_from(W.default_stop_words()),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_substring_mode_equals_searching_the_text(spark, words):
    text = W.stop_text()
    df = words_df(spark, words).select("w", W.is_listed("w").alias("hit"))
    for word, hit in rows(df):
        assert hit == (word in text), word


def test_anti_join_equals_exact_mode(spark, ngrams):
    table = ngrams(("the plate", 1), ("ring plate", 2), ("plate ring", 3), ("plate of", 4))
    listed = spark.createDataFrame(
        [(w,) for w in W.default_stop_words()] + [(None,)], "word string"
    )
    joined = without_listed_words(two_word_ngrams(table), listed)
    expected = accepted_bigrams(table, stopword_mode="exact")
    assert sorted(rows(joined, "w1", "w2")) == sorted(rows(expected, "w1", "w2"))
    assert expected.count() == 2


def test_substring_table_equals_substring_mode(spark, ngrams):
    table = ngrams(("the plate", 1), ("ring plate", 2), ("plate ring", 3), ("plate of", 4), ("plate zz", 5))
    listed = spark.createDataFrame([(w,) for w in (*W.default_stop_words(), "", None)], "word string")
    joined = without_listed_words(two_word_ngrams(table), listed, "substring")
    assert rows(joined, "w1", "w2") == [("plate", "zz")]
    with pytest.raises(ValueError):
        without_listed_words(table, listed, "prefix")


def test_hot_word_of_an_anti_join_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    word = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id").cast("string")))
    bigrams = spark.range(0, 40_000, 1, 8).select(word.alias("w1"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("w2"))
    listed = spark.createDataFrame([("w1",), ("w3",), ("v8",)], "word string")
    kept = without_listed_words(bigrams, listed)
    assert kept.count() == 39_997
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_membership_test_is_one_hash_lookup(spark):
    plan = (
        words_df(spark, ["x"]).where(~F.col("w").isNull()).where(W.is_listed("w"))
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan


def test_bigram_rejections_are_the_word_test_on_both_words(spark):
    tested = ["the\ntheir", "the\nplate", "x\n9", "mp3", "ring", "plate", "🦆", "é", "zz", "of"]
    ngrams = [f"{a} {b}" for a in tested for b in tested]
    table = spark.createDataFrame([(n, 1994, 1) for n in ngrams], "ngram string, year int, match_count int")
    for mode in W.STOP_WORD_MODES:
        bad = rejected(spark, tested, mode=mode)
        want = {n for n in ngrams if not bad & set(n.split(" "))}
        split = two_word_ngrams(table).select("w1", "w2", F.lit(1994).alias("year"), "match_count")
        for form in (table, split):
            kept = accepted_bigrams(form, stopword_mode=mode).collect()
            assert {f"{r.w1} {r.w2}" for r in kept} == want
