"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size. A share of all sizes is dealt by weight; a source whose
part exceeds ``max_epochs`` times its size is clamped there and the excess goes to the others
by weight, until none is above. Documents then fill their source's target: whole repetitions
of everything first, then one more repetition in a seeded order until the words run out; the
document at the border is taken in part.

Nulls: a null source is a source of its own, ordered last; a null size counts as 0. A source
of size 0 has target 0. An empty table gives an empty result. Rows that agree in every column
are separate documents. Columns of the input named like an added column are replaced; all
others are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairlore.llm.common import n_tokens, table
from pairlore.sources.scratch import saved

SHARE = 1.5
MAX_EPOCHS = 2.0
WEIGHTS = (5, 2, 1)
SEED = 17
BUCKETS = 4096  # of the seeded order, for each source; a power of 16


def source_ranks(sources: DataFrame) -> DataFrame:
    """``sources`` (source, ...) with its 0-based ``rank`` by code point, null last.

    The order is dealt over range partitions; only one count per partition meets in one task.
    """
    slices = saved(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn(
            "slice", F.spark_partition_id()
        ),
        "sources",
    )
    before = slices.groupBy("slice").agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select(
        "slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("slice").orderBy(F.col("source").asc_nulls_last())
    return (
        slices.withColumn("within", F.row_number().over(within))
        .join(before, "slice")
        .withColumn("rank", F.col("before") + F.col("within") - 1)
        .drop("slice", "before", "within")
    )


def water_level(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> float | None:
    """The level L at which every source of (weight, source_size) takes min(L * weight, cap).

    Clamping only raises the level, so the clamped sources are those whose cap lies below the
    last level: each round is one aggregate with one row. None: every source takes its cap.
    """
    level, clamped = 0.0, -1
    while True:
        above = F.col("source_size") * max_epochs < F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(above, F.col("source_size"))).alias("clamped_size"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"),
            F.count(F.when(above, 1)).alias("clamped"),
        ).first()
        if not row.free:
            return None
        if row.clamped == clamped:
            return level
        clamped = row.clamped
        level = (share * row.total - max_epochs * (row.clamped_size or 0)) / row.free


def seeded_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def cyclic_weight(rank: Column) -> Column:
    """Weights 5, 2, 1, 5, 2, 1, ... by the rank of the source."""
    return F.element_at(F.lit(list(map(float, WEIGHTS))), (rank % len(WEIGHTS) + 1).cast("int"))


def mix(
    documents: DataFrame,
    size: Column,
    weight: Callable[[Column], Column] = cyclic_weight,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``documents`` (doc_id, source, ...) with size, source_size, target and taken.

    ``weight`` gives a source's weight from the column of its rank. ``taken`` is the number
    of words (or whatever ``size`` counts) that the mix takes of the document: the sum over a
    source is its target, rounded to a whole number.
    """
    documents = documents.drop("source_size", "target", "taken", "_order", "_bucket").withColumn(
        "size", F.coalesce(size, F.lit(0)).cast("long")
    )
    digits = len(f"{BUCKETS:x}") - 1
    documents = documents.withColumn("_order", seeded_key(F.col("doc_id"), seed)).withColumn(
        "_bucket", F.substring("_order", 1, digits)
    )
    # A hot source is spread over its buckets; this table has no more rows than those.
    buckets = saved(
        documents.groupBy("source", "_bucket").agg(F.sum("size").alias("bucket_size")), "buckets"
    )
    sources = saved(
        source_ranks(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
        .withColumn("weight", weight(F.col("rank"))),
        "sources",
    )
    level = water_level(sources, share, max_epochs)
    cap = F.col("source_size") * F.lit(max_epochs)
    target = cap if level is None else F.least(F.col("weight") * F.lit(level), cap)
    words = F.floor(F.col("target") + 0.5).cast("long")
    some = F.col("source_size") > 0
    whole = F.when(some, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    sources = (
        sources.select("source", "source_size", target.cast("double").alias("target"))
        .withColumn("_whole", whole)
        .withColumn("_rest", words - F.col("_whole") * F.col("source_size"))
    )
    earlier = (
        Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    buckets = buckets.withColumn(
        "_before", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))
    )
    borders = buckets.alias("b").join(
        sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))
    ).select(
        F.col("b.source").alias("_source"), F.col("b._bucket").alias("_in"),
        "_before", "source_size", "target", "_whole", "_rest",
    )
    placed = documents.join(
        borders,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_in")),
    )
    order = Window.partitionBy("_source", "_in").orderBy("_order", "doc_id", "size")
    inside = F.coalesce(
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    left = F.col("_rest") - F.col("_before") - inside
    once_more = F.least(F.greatest(left, F.lit(0)), F.col("size"))
    taken = (F.col("_whole") * F.col("size") + once_more).cast("long")
    return placed.withColumn("taken", taken).drop(
        "_source", "_in", "_before", "_whole", "_rest", "_order", "_bucket"
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all documents takes from each document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = saved(documents.select("doc_id", "source", n_tokens(F.col("text")).alias("size")), "sizes")
    mixed = mix(sized, F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def mixing_sql(documents: str = "documents") -> str:
    """The same in closed form: sources in the order of cap / weight, clamped from the front."""
    return f"""
sized AS (
  SELECT doc_id, source, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS u,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                              lambda x: x <> '')) AS BIGINT) AS size
  FROM {documents}),
source_sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5.0, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)]
            ::DOUBLE AS weight
  FROM source_sizes),
cumulated AS (
  SELECT *, row_number() OVER o AS k,
         sum(source_size) OVER (o ROWS UNBOUNDED PRECEDING)::DOUBLE - source_size AS clamped,
         sum(weight) OVER () - sum(weight) OVER (o ROWS UNBOUNDED PRECEDING) + weight AS free,
         sum(source_size) OVER ()::DOUBLE AS total
  FROM weighted WINDOW o AS (ORDER BY source_size / weight, source)),
levels AS (
  SELECT min_by((1.5 * total - 2.0 * clamped) / free, k) AS level FROM cumulated
  WHERE (1.5 * total - 2.0 * clamped) / free * weight <= 2.0 * source_size),
targets AS (
  SELECT source, source_size, least(weight * level, 2.0 * source_size) AS target
  FROM weighted, levels),
ordered AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS words,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY u, doc_id
              ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size = 0 THEN 0 ELSE
           (words // source_size) * size + least(greatest(words % source_size - before, 0), size)
         END AS taken
  FROM ordered)"""


ORACLE_SQL = f"WITH {mixing_sql()}\nSELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken FROM mixed"
