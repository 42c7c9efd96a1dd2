"""Filtering and counting: bigrams, pair counts, marginals and decade totals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairlore.functions.measures import decade_of
from pairlore.functions.words import bigram_rejections, needs_join, without_listed_words

PAIR_KEYS = ["decade", "w1", "w2"]


def _outer_words(ngram: str) -> tuple[Column, Column, Column]:
    """The text without trailing spaces, and what lies before its first and after its last space."""
    text = F.rtrim(ngram)
    return text, F.substring_index(text, " ", 1), F.substring_index(text, " ", -1)


def word_keys(ngram: str = "ngram", year: str = "year") -> tuple[Column, Column]:
    """First word and decade, as ``two_word_ngrams`` takes them from an n-gram and its year.

    Its filter leaves no NULL; saying so spares a null test that splits the text again.
    """
    return F.coalesce(_outer_words(ngram)[1], F.lit("")), decade_of(year)


def two_word_ngrams(ngrams: DataFrame) -> DataFrame:
    """``(ngram, year, match_count)`` to ``(ngram, decade, w1, w2, match_count)``.

    Keeps n-grams of exactly two tokens split on one space.  Trailing spaces do not count;
    a leading or doubled space makes an empty token.  Two tokens are present exactly when
    the text before the first space, that space and the text after the last space make up
    the whole text, which needs neither a regex nor an array.
    """
    text, first, last = _outer_words("ngram")
    w1, decade = word_keys()
    return ngrams.where(
        F.octet_length(first) + F.octet_length(last) + 1 == F.octet_length(text)
    ).select(
        "ngram",
        decade.alias("decade"),
        w1.alias("w1"),
        F.coalesce(last, F.lit("")).alias("w2"),
        F.col("match_count").cast("bigint").alias("match_count"),
    )


def accepted_bigrams(
    ngrams: DataFrame,
    stop_words: Sequence[str] | None = None,
    stopword_mode: str = "substring",
) -> DataFrame:
    """Bigrams whose two words both pass the word test, one row per input row.

    Takes an n-gram table ``(ngram, year, match_count)``, or the same with the words already
    apart: ``(w1, w2, year, match_count)``.  An own stop list too large for a set of its
    substrings in the plan is joined as a table of them.
    """
    if "ngram" in ngrams.columns:
        bigrams = two_word_ngrams(ngrams)
        texts = ["ngram"]
    else:
        bigrams = ngrams.select(
            decade_of("year").alias("decade"),
            "w1",
            "w2",
            F.col("match_count").cast("bigint").alias("match_count"),
        )
        texts = ["w1", "w2"]
    for test in bigram_rejections(texts, stop_words, stopword_mode):
        bigrams = bigrams.where(~test)
    if needs_join(stop_words, stopword_mode):
        spark = ngrams.sparkSession
        listed = spark.createDataFrame([(w,) for w in dict.fromkeys(stop_words)], "word string")
        bigrams = without_listed_words(bigrams, listed, "substring")
    # Without these null tests Spark derives them from each later join and puts them into
    # some copies of this subtree only, which then cannot share their shuffle.
    for key in PAIR_KEYS:
        bigrams = bigrams.where(F.col(key).isNotNull())
    return bigrams.select(*PAIR_KEYS, "match_count")


def pair_counts(
    ngrams: DataFrame,
    stop_words: Sequence[str] | None = None,
    stopword_mode: str = "substring",
) -> DataFrame:
    """``c12``: occurrences of the ordered pair in the decade."""
    return count_pairs(accepted_bigrams(ngrams, stop_words, stopword_mode))


def count_pairs(bigrams: DataFrame) -> DataFrame:
    return bigrams.groupBy(*PAIR_KEYS).agg(F.sum("match_count").alias("c12"))


def first_word_counts(pairs: DataFrame) -> DataFrame:
    """``c1``: occurrences of the word in first position."""
    return pairs.groupBy("decade", "w1").agg(F.sum("c12").alias("c1"))


def second_word_counts(pairs: DataFrame) -> DataFrame:
    """``c2``: occurrences of the word in second position."""
    return pairs.groupBy("decade", "w2").agg(F.sum("c12").alias("c2"))


def decade_totals(pairs: DataFrame) -> DataFrame:
    """``n``: occurrences of all accepted pairs of the decade."""
    return pairs.groupBy("decade").agg(F.sum("c12").alias("n"))


def multi_level_counts(
    ngrams: DataFrame,
    stop_words: Sequence[str] | None = None,
    stopword_mode: str = "substring",
) -> DataFrame:
    """All four counts as one tagged stream, cascaded from the pair counts.

    ``tag`` is ``Cw1w2``, ``Cw1``, ``Cw2`` or ``N``; words a level does not have are NULL.
    Raw rows are aggregated once, to pairs; the word counts are aggregated from the pairs and
    the decade totals from the first-word counts, so no raw row is copied per level.  The
    pairs' exchange is the same in every branch and is reused.
    """
    pairs = pair_counts(ngrams, stop_words, stopword_mode)
    c1 = first_word_counts(pairs)
    word = F.lit(None).cast("string")
    levels = (
        pairs.select(*PAIR_KEYS, F.lit("Cw1w2").alias("tag"), F.col("c12").alias("value")),
        c1.select("decade", "w1", word.alias("w2"), F.lit("Cw1").alias("tag"), F.col("c1").alias("value")),
        second_word_counts(pairs).select(
            "decade", word.alias("w1"), "w2", F.lit("Cw2").alias("tag"), F.col("c2").alias("value")
        ),
        c1.groupBy("decade").agg(F.sum("c1").alias("value")).select(
            "decade", word.alias("w1"), word.alias("w2"), F.lit("N").alias("tag"), "value"
        ),
    )
    return reduce(DataFrame.unionByName, levels)
