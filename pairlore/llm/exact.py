"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after every run of ``[\\x20\\x09-\\x0D]`` became one
space (null counts as empty). Of equal texts the row with the smallest doc_id stays.

The method: every row is reduced to (doc_id, SHA-256 of the normalised text) once and written
to shared storage. Each partition then summarises its digests with Misra-Gries (``COUNTERS``
counters, exact counts cut down by the (k+1)-th largest), the summaries are merged by a
grouped sum, and every digest whose merged estimate exceeds n / (k+1) becomes a candidate
(at most k of them, because the estimates sum to at most n). Any digest that occurs more than
2n / (k+1) times is certain to be one. Candidates are verified with exact counts and smallest
ids through a broadcast semi-join aggregated map-side; these verified winners (at most k rows:
the proven bound of the broadcast) are broadcast back and settle the rows of hot digests
without a shuffle. All other digests are resolved by an ordinary shuffle on the digest, where
no group holds more than 2n / (k+1) rows.

Defined results for odd input:
- null or empty text: the normalised text is empty; all such rows are one group.
- null doc_id: such a row is never chosen while its group has a row with an id; a group whose
  rows all lack an id keeps all of them (keep_id null, kept true), since no id decides.
- repeated rows (same doc_id, equal texts): all rows of the smallest id are kept, as they are
  one document; group_size counts every row.
- empty table: empty result. Extra input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.llm.common import BLANKS, table
from pairlore.sources.scratch import Scratch, saved

COUNTERS = 1024  # Misra-Gries counters per partition summary: candidates <= COUNTERS


def normalised(text: Column) -> Column:
    """Each run of blanks (space, \\x09-\\x0D) as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digests(documents: DataFrame) -> DataFrame:
    """(doc_id, text_sha256): SHA-256 of the normalised text in UTF-8, lowercase hex."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(normalised(F.col("text")), 256).alias("text_sha256"),
    )


def _summaries(counters: int):
    """Misra-Gries summary of one partition: at most ``counters`` (digest, count) rows."""

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: pd.Series | None = None
        for batch in batches:
            part = batch["text_sha256"].value_counts()
            counts = part if counts is None else counts.add(part, fill_value=0)
        out = pd.DataFrame({"text_sha256": pd.Series([], dtype=object), "n": pd.Series([], dtype="int64")})
        if counts is not None and len(counts):
            counts = counts.astype("int64").sort_values(ascending=False, kind="stable")
            if len(counts) > counters:
                cut = int(counts.iloc[counters])  # the (k+1)-th largest count
                counts = counts.iloc[:counters] - cut
                counts = counts[counts > 0]
            out = pd.DataFrame({"text_sha256": counts.index.astype(object), "n": counts.to_numpy()})
        yield out

    return summarise


def heavy_hitters(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified frequent digests: (text_sha256, heavy_keep long, heavy_size long), at most k rows.

    Candidates come from merged Misra-Gries summaries; their exact counts and smallest ids are
    then computed over all rows. Every digest of more than 2n / (k+1) rows is among them.
    """
    spark = rows.sparkSession
    merged = (
        rows.select("text_sha256")
        .mapInPandas(_summaries(counters), "text_sha256 string, n long")
        .groupBy("text_sha256")
        .agg(F.sum("n").alias("n"))
    )
    total = rows.count()
    candidates = (
        merged.where(F.col("n") * (counters + 1) > total)
        .select("text_sha256")
        .collect()
    )
    assert len(candidates) <= counters, "Misra-Gries bound broken"
    keys = spark.createDataFrame([(r.text_sha256,) for r in candidates], "text_sha256 string")
    verified = (
        rows.join(F.broadcast(keys), "text_sha256")  # at most `counters` keys
        .groupBy("text_sha256")
        .agg(F.min("doc_id").alias("heavy_keep"), F.count(F.lit(1)).alias("heavy_size"))
        .collect()
    )
    return spark.createDataFrame(
        [(r.text_sha256, r.heavy_keep, r.heavy_size) for r in verified],
        "text_sha256 string, heavy_keep long, heavy_size long",
    )


def copies(documents: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, hot.

    ``hot`` tells whether the group was settled map-side as a verified heavy hitter.
    """
    rows = saved(digests(documents), "exact-digests")
    heavy = heavy_hitters(rows, counters)
    hot = (
        rows.join(F.broadcast(heavy), "text_sha256")  # proven bound: at most `counters` rows
        .select(
            "doc_id", F.col("heavy_keep").alias("keep_id"), F.col("heavy_size").alias("group_size"),
            "text_sha256", F.lit(True).alias("hot"),
        )
    )
    light = rows.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    groups = light.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    cold = light.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", "text_sha256", F.lit(False).alias("hot")
    )
    both = hot.unionByName(cold)
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return both.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "hot")


def deduplicated(documents: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns."""
    marks = copies(documents, counters).where("kept").select(
        F.col("doc_id").alias("_exact_id"), F.col("text_sha256").alias("_exact_sha")
    ).distinct()
    cols = documents.columns
    key = F.sha2(normalised(F.col("text")), 256)
    joined = documents.join(
        marks, (F.col("doc_id").eqNullSafe(F.col("_exact_id"))) & (key == F.col("_exact_sha"))
    )
    return joined.select(*cols)


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: which row of its equal texts stays."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark) as scope:  # the digests go when the result is written
        return scope.result(copies(documents).drop("hot"), "exact")


ORACLE_SQL = r"""
WITH d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       coalesce(d.doc_id = g.keep_id, g.keep_id IS NULL) AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
