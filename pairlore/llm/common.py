"""What the operators share: tables, folds, word rules and labelled samples."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[\x20\x09-\x0D]+"
TOKEN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; ``np.unique`` hashes integers, which takes three times as long."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column used inside a higher-order function is otherwise worked out again per element,
    because projections are merged into the place of use.
    """
    return F.transform(F.array(value), body)[0]


def n_tokens(text: Column) -> Column:
    """Number of runs of characters other than space and \\x09-\\x0D; null: 0."""
    pieces = F.split(F.coalesce(text, F.lit("")), BLANKS)
    return F.size(F.array_remove(pieces, "")).cast("long")


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, limit: int
) -> list[tuple[int, str, int]]:
    """At most ``limit`` rows (doc_id, text, label) to fit a classifier on.

    Rows of the held-out fold and rows without a 0/1 label are left out. The choice is by a
    hash of the id, so it is the same in every run; ids with clashing labels take the larger.
    """
    known = (
        labels.select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & (fold(F.col("label_id"), folds) != held_out))
        .groupBy("label_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(limit)
    )
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))  # at most limit rows
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(limit)
        .select("doc_id", "text", "label")
    )
    return [(r.doc_id, r.text or "", r.label) for r in rows.toLocalIterator()]
