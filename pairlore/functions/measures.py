"""Decade bucket and association measures, as native column expressions.

All measures read the columns of a contingency row: ``c12`` (pair count), ``c1`` and ``c2``
(counts of the first and second word in their positions) and ``n`` (decade total).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decade_of(year: str = "year") -> Column:
    """First year of the decade; the remainder truncates, so year -5 is in decade 0."""
    return F.col(year) - F.col(year) % 10


def has_all_components() -> Column:
    return (F.col("c12") > 0) & (F.col("c1") > 0) & (F.col("c2") > 0)


def is_perfect() -> Column:
    """The two words only ever occur together: NPMI is exactly 1, decided on integers."""
    return (F.col("c12") == F.col("c1")) & (F.col("c12") == F.col("c2"))


def is_positive() -> Column:
    """``c12 * n > c1 * c2``, exactly.

    Doubles decide whenever the two products differ by more than their rounding error can
    explain; the rare near-tie is decided in DECIMAL, which cannot overflow.
    """

    def product(a: str, b: str, type_name: str) -> Column:
        return F.col(a).cast(type_name) * F.col(b).cast(type_name)

    left, right = product("c12", "n", "double"), product("c1", "c2", "double")
    whole = "decimal(19,0)"
    gap = (F.abs(left) + F.abs(right)) * 1e-12
    return F.when(F.abs(left - right) > gap, left > right).otherwise(
        product("c12", "n", whole) > product("c1", "c2", whole)
    )


def pmi() -> Column:
    return F.ln("c12") + F.ln("n") - (F.ln("c1") + F.ln("c2"))


def npmi() -> Column:
    """PMI over ``-ln(c12 / n)``; 1.0 for a perfect pair, which also covers ``c12 = n``."""
    share = F.col("c12").cast("double") / F.col("n")
    return F.when(is_perfect(), F.lit(1.0)).when(
        F.col("c12") < F.col("n"), pmi() / -F.ln(share)
    )


def repeatable_sum(score: Column) -> Column:
    """Sum of scores in [-1, 1] to 12 decimals, the same whatever the row order.

    Adding doubles in task order gives a slightly different total on every run, and a
    threshold on ``npmi / sum`` would flip with it.  Here each score becomes an integer
    number of 1e-12 units, split in two so that neither BIGINT sum can overflow.
    """
    units = F.rint(score * 1e12).cast("bigint")
    high = F.sum((units / 1_000_000).cast("bigint"))
    low = F.sum(units % 1_000_000)
    return F.coalesce(high * F.lit(1e-6) + low * F.lit(1e-12), F.lit(0.0))
