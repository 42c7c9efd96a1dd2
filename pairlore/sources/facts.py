"""Tagged facts: the row-oriented text form ``decade TAB w1 TAB w2 TAB tag TAB value``.

Counts carry the tags ``N``, ``Cw1w2``, ``Cw1``, ``Cw2`` with whole values, scores the tags
``Npmi`` and ``SumNpmis`` with floating values.  A word that does not apply is one space in
the text and NULL in a DataFrame.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.operators.counts import PAIR_KEYS

COUNT_TAGS = ("N", "Cw1w2", "Cw1", "Cw2")
SCORE_TAGS = ("Npmi", "SumNpmis")
_NO_WORD = " "


def read_tagged_facts(
    spark: SparkSession, paths: str | list[str], on_error: str = "fail"
) -> tuple[DataFrame, DataFrame]:
    """Counts and scores found in one or more directories, read as one bag of lines."""
    lines = spark.read.text(paths)
    return parse_count_facts(lines, on_error), parse_score_facts(lines, on_error)


def read_count_facts(
    spark: SparkSession, paths: str | list[str], on_error: str = "fail"
) -> DataFrame:
    return parse_count_facts(spark.read.text(paths), on_error)


def read_score_facts(
    spark: SparkSession, paths: str | list[str], on_error: str = "fail"
) -> DataFrame:
    return parse_score_facts(spark.read.text(paths), on_error)


def _field(position: int) -> Column:
    return F.get(F.split("value", "\t"), F.lit(position))


def _well_formed(value_type: str) -> Column:
    """Known tag, and decade and value that parse; NULL-free."""
    known = F.coalesce(_field(3).isin(*COUNT_TAGS, *SCORE_TAGS), F.lit(False))
    return (
        known
        & _field(0).try_cast("bigint").isNotNull()
        & _field(4).try_cast(value_type).isNotNull()
    )


def _parse(
    lines: DataFrame, tags: tuple[str, ...], value_type: str, on_error: str
) -> DataFrame:
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    other = F.coalesce(
        _field(3).isin(*(t for t in COUNT_TAGS + SCORE_TAGS if t not in tags)), F.lit(False)
    )
    keep = _well_formed(value_type)
    if on_error == "fail":
        stop = F.raise_error(F.concat(F.lit("not a tagged fact: "), F.col("value")))
        keep = F.when(keep | other, keep).otherwise(stop.cast("boolean"))
    return lines.where(keep & ~other).select(
        _field(0).try_cast("bigint").alias("decade"),
        F.nullif(_field(1), F.lit(_NO_WORD)).alias("w1"),
        F.nullif(_field(2), F.lit(_NO_WORD)).alias("w2"),
        _field(3).alias("tag"),
        _field(4).try_cast(value_type).alias("value"),
    )


def parse_count_facts(lines: DataFrame, on_error: str = "fail") -> DataFrame:
    return _parse(lines, COUNT_TAGS, "bigint", on_error)


def parse_score_facts(lines: DataFrame, on_error: str = "fail") -> DataFrame:
    return _parse(lines, SCORE_TAGS, "double", on_error)


def rejected_facts(lines: DataFrame) -> DataFrame:
    """Lines that are neither a count fact nor a score fact."""
    counts = F.coalesce(_field(3).isin(*COUNT_TAGS), F.lit(False))
    return lines.where(
        ~F.when(counts, _well_formed("bigint")).otherwise(_well_formed("double"))
    ).select("value")


def as_facts(table: DataFrame, tag: str, value: str) -> DataFrame:
    """A wide column as tagged facts; key columns the table lacks become NULL."""
    keys = [
        F.col(k) if k in table.columns else F.lit(None).cast("string").alias(k)
        for k in PAIR_KEYS
    ]
    return table.select(*keys, F.lit(tag).alias("tag"), F.col(value).alias("value"))


def count_facts(contingency: DataFrame) -> DataFrame:
    """Pair-level count facts of a contingency table: three per pair, in one pass."""
    tags = {"Cw1w2": "c12", "Cw1": "c1", "Cw2": "c2"}
    entries = F.array(
        *(F.struct(F.lit(t).alias("tag"), F.col(c).alias("value")) for t, c in tags.items())
    )
    return contingency.select(*PAIR_KEYS, F.inline(entries).alias("tag", "value"))


def pivot_counts(facts: DataFrame) -> DataFrame:
    """Fold ``Cw1w2``, ``Cw1``, ``Cw2`` facts of one pair into columns; absent ones are 0.

    Facts without both words (totals) do not belong to a pair and are left out.
    """
    columns = {"c12": "Cw1w2", "c1": "Cw1", "c2": "Cw2"}
    return (
        facts.where(F.col("w1").isNotNull() & F.col("w2").isNotNull())
        .groupBy(*PAIR_KEYS)
        .agg(
            *(
                F.coalesce(F.max(F.when(F.col("tag") == tag, F.col("value"))), F.lit(0))
                .cast("bigint")
                .alias(name)
                for name, tag in columns.items()
            )
        )
    )


def union_facts(*facts: DataFrame) -> DataFrame:
    """Bag union of fact tables."""
    return reduce(DataFrame.unionByName, facts)


def write_facts(facts: DataFrame, path: str) -> None:
    """Text lines in the order the DataFrame has; fails when the directory exists.

    Every line can be read back: a row whose line could not (a NULL decade, tag or value, or
    a word with a TAB or a line break, or of one space, which stands for no word) stops the
    job with an error that shows the row.
    """
    words = [F.col(w) for w in ("w1", "w2")]
    broken = [F.coalesce(w.rlike("[\\t\\n\\r]") | (w == _NO_WORD), F.lit(False)) for w in words]
    missing = [F.col(c).isNull() for c in ("decade", "tag", "value")]
    fits = ~reduce(or_, broken + missing)
    row = F.to_json(F.struct("decade", "w1", "w2", "tag", "value"))
    line = F.concat_ws(
        "\t",
        F.col("decade").cast("string"),
        *(F.coalesce(w, F.lit(_NO_WORD)) for w in words),
        "tag",
        F.col("value").cast("string"),
    )
    stop = F.raise_error(F.concat(F.lit("no line can hold this fact: "), row)).cast("string")
    facts.select(F.when(fits, line).otherwise(stop).alias("value")).write.text(path)
