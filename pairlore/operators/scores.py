"""Contingency table, NPMI scores, decade sums, thresholds and the integrity audit."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairlore.functions.measures import (
    has_all_components,
    is_perfect,
    is_positive,
    npmi,
    repeatable_sum,
)
from pairlore.operators.counts import (
    PAIR_KEYS,
    first_word_counts,
    second_word_counts,
)

SUM_SCOPES = ("positive", "all")
DECADE_JOINS = ("auto", "shuffle")


def attach_per_decade(
    rows: DataFrame, per_decade: DataFrame, column: str, how: str = "auto"
) -> DataFrame:
    """Add ``column`` of a one-row-per-decade table to every row of the decade.

    The small side is broadcast unless the session switches broadcasts off: left to adaptive
    execution, Spark moves all rows to their decade before it knows how small the other side
    is.  Otherwise both sides are shuffled, and the small one ends in an exchange of its own,
    without which adaptive execution could not split the decade that holds most of the rows.
    ``how="shuffle"`` asks for that form; the result is the same.
    """
    if how not in DECADE_JOINS:
        raise ValueError(f"decade_join must be one of {DECADE_JOINS}, not {how!r}")
    per_decade = per_decade.select("decade", column)
    if how == "auto" and _broadcasts(rows.sparkSession):
        return rows.join(F.broadcast(per_decade), "decade")
    per_decade = per_decade.repartition(F.xxhash64("decade"))
    if how == "shuffle":
        per_decade = per_decade.hint("merge")
    return rows.join(per_decade, "decade")


def _broadcasts(spark: SparkSession) -> bool:
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


def contingency(pairs: DataFrame, decade_join: str = "auto", sort: bool = False) -> DataFrame:
    """``(decade, w1, w2, c12)`` plus the marginals ``c1``, ``c2`` and the total ``n``.

    Pairs are moved to their first words and then to their second words, and each count is a
    total beside the rows it was added up from (``_counted_beside``).  A word's pairs of a
    decade are one task's, but distinct: as many as the word has partners, however often they
    occur, in a sort that spills.

    Without broadcasts, and for ``decade_join="shuffle"``, the marginals come from their own
    partial aggregation and are joined back: adaptive execution splits a join partition that
    one word dominates, for half as much shuffle again.  It does so only
    when both join inputs end in an exchange.  An aggregate already sits on the join keys
    and gets none, so ``_movable`` gives it one; that moves one row per word and decade.
    The total rides on the first-word counts, so pairs are never joined on the decade alone.

    ``sort`` asks for rows that lie by (w1, decade, w2) within a partition, which a listing by
    words then merges instead of sorting them; totals beside the rows come so for a key more in
    their sort, joined ones come in any order.
    """
    if decade_join == "auto" and _broadcasts(pairs.sparkSession):
        return _counted_beside(pairs, sort)
    c1 = first_word_counts(pairs)
    c2 = second_word_counts(pairs)
    # Every pair is counted once under its first word, so the totals need no pass of their
    # own over the pairs.
    n = totals_of_words(c1)
    c1 = attach_per_decade(c1, n, "n", decade_join)
    return attach_counts(pairs, _movable(c1, "w1"), _movable(c2, "w2"))


def _movable(marginals: DataFrame, word: str) -> DataFrame:
    return marginals.repartition(F.xxhash64("decade", word))


def _counted_beside(pairs: DataFrame, sort: bool = False) -> DataFrame:
    """``contingency`` by totals over the pairs of a word, which need one sort per word and
    neither a second pass over the shuffled pairs nor a join."""
    for key in PAIR_KEYS:  # as in a join, a pair without a key has no counts
        pairs = pairs.where(F.col(key).isNotNull())
    early, late = ("w2", "w1") if sort else ("w1", "w2")
    count = {"w1": "c1", "w2": "c2"}
    moved = pairs.repartition(early, "decade")
    n = _counted(moved, "n", "decade")
    total = {w: F.sum("c12").over(Window.partitionBy(w, "decade")) for w in count}
    table = moved.withColumn(count[early], total[early]).repartition(late, "decade")
    if sort:  # the one sort that the total needs, with a key more
        table = table.sortWithinPartitions(late, "decade", early)
    table = table.withColumn(count[late], total[late])
    # every decade has its total; said as an outer join, it is not worked out where nobody asks for n
    return table.join(F.broadcast(n), "decade", "left").select(*PAIR_KEYS, "c12", "c1", "c2", "n")


def contingency_in_place(pairs: DataFrame, laid_out: bool = False) -> DataFrame:
    """The rows of ``contingency`` with each pair shuffled once per word and nothing beside it.

    Pairs are brought together by first word, counted and joined there, then likewise by second
    word.  A word's pairs (each once, however often it occurs) are in one task, in a sort that
    spills; ``contingency`` splits the joins of a word that dominates, for twice the shuffle.

    ``laid_out`` says that pairs lie by first word and decade already, so that they are counted
    without a shuffle between: a join would count them twice, so ``c1`` is a total beside them.
    """
    if laid_out:
        for key in PAIR_KEYS:  # as in a join, a pair without a key has no counts
            pairs = pairs.where(F.col(key).isNotNull())
        first = Window.partitionBy("w1", "decade")
        with_c1 = pairs.repartition("w1", "decade").withColumn("c1", F.sum("c12").over(first))
        by_second = with_c1.repartition("w2", "decade")
        n = _counted(by_second, "n", "decade")
    else:
        by_first = pairs.repartition("w1", "decade")
        n = _counted(by_first, "n", "decade")
        by_second = _with_count(by_first, "w1", "c1").repartition("w2", "decade")
    table = attach_per_decade(_with_count(by_second, "w2", "c2"), n, "n")
    # Tests of c12 and c1 must not move into some uses of the shuffles below, which would then
    # not be shared: each value names c2, which is known above them only.
    late = (F.when(F.col("c2").isNotNull(), F.col(c)).alias(c) for c in ("c12", "c1"))
    return table.select(*PAIR_KEYS, *late, "c2", "n")


def _counted(rows: DataFrame, name: str, *keys: str) -> DataFrame:
    """Sum of ``c12`` by ``keys``.  It names all columns, as a use of fewer of them would have
    a shuffle of its own; the test of them always holds."""
    whole = F.max(F.xxhash64(*rows.columns)).isNotNull()
    return rows.groupBy(*keys).agg(F.when(whole, F.sum("c12")).alias(name))


def _with_count(rows: DataFrame, word: str, name: str) -> DataFrame:
    return rows.join(_counted(rows, name, word, "decade"), [word, "decade"])


def totals_of_words(c1: DataFrame) -> DataFrame:
    """Decade totals from first-word counts."""
    return c1.groupBy("decade").agg(F.sum("c1").alias("n"))


def attach_counts(pairs: DataFrame, c1: DataFrame, c2: DataFrame) -> DataFrame:
    """Pairs with their marginals; ``c1`` also carries the decade total ``n``."""
    joined = pairs.join(c1, ["w1", "decade"]).join(c2, ["w2", "decade"])
    return joined.select(*PAIR_KEYS, "c12", "c1", "c2", "n")


def _scored() -> Column:
    return has_all_components() & is_positive() & ~is_perfect()


def npmi_scores(contingency: DataFrame, include_perfect: bool = False) -> DataFrame:
    """Pairs that occur together more often than chance, with ``0 < npmi < 1``.

    ``include_perfect`` also returns pairs whose words only occur together (NPMI 1).
    """
    keep = _scored()
    if include_perfect:
        keep = keep | (has_all_components() & is_perfect())
    return contingency.where(keep).withColumn("npmi", npmi())


def npmi_sums(contingency: DataFrame, sum_scope: str = "positive") -> DataFrame:
    """NPMI sum of each decade, over all of its pairs and before any threshold.

    ``positive`` sums the scores strictly between 0 and 1; ``all`` sums every pair's score,
    negative and perfect ones included.  A decade without such a pair gets 0.0.
    """
    if sum_scope not in SUM_SCOPES:
        raise ValueError(f"sum_scope must be one of {SUM_SCOPES}, not {sum_scope!r}")
    counted = _scored() if sum_scope == "positive" else has_all_components()
    return contingency.groupBy("decade").agg(
        repeatable_sum(F.when(counted, npmi())).alias("sum_npmi")
    )


def check_threshold(name: str, value: float) -> float:
    value = float(value)
    if math.isnan(value):
        raise ValueError(f"{name} must be a number")
    return value


def passing_scores(
    scores: DataFrame,
    sums: DataFrame,
    min_npmi: float,
    rel_min_npmi: float,
    decade_join: str = "auto",
) -> DataFrame:
    """Scores with ``npmi >= min_npmi`` or ``npmi / sum_npmi >= rel_min_npmi``.

    Where a decade's sum is zero, a positive score passes any relative threshold.  Where it
    is negative, which only a sum over all pairs can be, shares change their sign and no
    positive score passes a positive relative threshold.
    """
    min_npmi = check_threshold("min_npmi", min_npmi)
    rel_min_npmi = check_threshold("rel_min_npmi", rel_min_npmi)
    share = F.when(F.col("sum_npmi") != 0, F.col("npmi") / F.col("sum_npmi")).otherwise(
        F.when(F.col("npmi") > 0, F.lit(math.inf))
    )
    return (
        attach_per_decade(scores, sums, "sum_npmi", decade_join)
        .where((F.col("npmi") >= min_npmi) | (share >= rel_min_npmi))
        .select(*PAIR_KEYS, "npmi")
    )


def by_descending_score(collocations: DataFrame) -> DataFrame:
    """Decade ascending, NPMI descending, ties by words in byte order."""
    return collocations.orderBy("decade", F.desc("npmi"), "w1", "w2")


def by_second_word(pairs: DataFrame) -> DataFrame:
    """The listing grouped by second word."""
    return pairs.orderBy("decade", "w2", "w1")


def by_words_nulls_first(counts: DataFrame) -> DataFrame:
    """Decade totals before word totals before pairs (absent words are NULL)."""
    return counts.orderBy("decade", F.asc_nulls_first("w1"), F.asc_nulls_first("w2"))


def integrity_audit(contingency: DataFrame) -> DataFrame:
    """One row per component that is not positive: ``(decade, w1, w2, reason)``.

    These are the rows that ``has_all_components`` keeps out of the scores: components that
    are zero (an absent fact becomes zero), missing or negative.
    """

    def problem(c: str) -> Column:
        value = F.col(c)
        return (
            F.when(value.isNull(), F.lit(f"{c} is missing"))
            .when(value < 0, F.lit(f"{c} is negative"))
            .when(value == 0, F.lit(f"{c} is zero"))
        )

    problems = F.array_compact(F.array(*map(problem, ("c12", "c1", "c2"))))
    return contingency.select(*PAIR_KEYS, F.explode(problems).alias("reason"))


# Fixed order of fact tags: totals first, then the pair counts, then scores and sums, then
# scores listed by their value.
FACT_CLASSES = {"N": 0, "Cw1w2": 1, "Cw1": 1, "Cw2": 1, "Npmi": 2, "SumNpmis": 2, "NpmiWithVal": 3}
FACT_TAGS = ("N", "Cw1w2", "Cw1", "Cw2", "Npmi", "SumNpmis", "NpmiWithVal")


_PLACE = "_place of the tag"


def in_fact_order(facts: DataFrame) -> DataFrame:
    """Mixed facts ``(decade, w1, w2, tag, value)`` in one total order.

    Decade ascending; within it the total ``N`` first, then the counts ``Cw1w2``, ``Cw1`` and
    ``Cw2`` together by (w1, w2) with absent words first, then ``Npmi`` and ``SumNpmis``
    together by (w1, w2) likewise, then ``NpmiWithVal`` by value descending.  Ties go by tag
    in the order above, then by value descending; unknown tags come last.  The key is made
    of columns only, so the sort is one range-partitioned exchange.

    A known tag travels as its place (class and rank in one whole number), worked out once: the
    sort would work out an expression again for each comparison.  Facts that differ in tag or
    value only share a class and lie in one range, so the ranges need neither.
    """
    places = {t: FACT_CLASSES[t] << 3 | i for i, t in enumerate(FACT_TAGS)}
    place = F.create_map(*[F.lit(x) for known in places.items() for x in known])[F.col("tag")]
    tag = F.create_map(*[F.lit(x) for t, at in places.items() for x in (at, t)])[F.col(_PLACE)]
    placed = facts.withColumns({
        _PLACE: F.coalesce(place, F.lit(len(FACT_TAGS) << 3)), "tag": F.when(place.isNull(), F.col("tag"))
    })
    group = F.shiftright(_PLACE, 3)
    by_value = F.when(group == FACT_CLASSES["NpmiWithVal"], F.col("value"))
    key = [
        F.asc_nulls_last("decade"), group, F.desc_nulls_last(by_value),
        F.asc_nulls_first("w1"), F.asc_nulls_first("w2"),
    ]
    ties = F.col(_PLACE), F.asc_nulls_last("tag"), F.desc_nulls_last("value")
    listed = placed.repartitionByRange(*key).orderBy(*key, *ties)
    return listed.withColumn("tag", F.coalesce(tag, F.col("tag"))).select(*facts.columns)
