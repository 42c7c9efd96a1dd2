"""Nearest neighbours of a query set by a block matrix join.

Queries and candidates are dealt into blocks; each pair of blocks meets once. Inside, vectors
of unit length are rounded to int8 codes and whole tiles of products are taken at once. The
rounding error of a vector is known, so every product bounds the true cosine from both sides;
only pairs whose upper bound reaches the k-th best lower bound are recomputed in double
precision from the original vectors and kept in one heap per query. Nothing is lost by the
codes: the result is exact.

Nulls: rows with a null id, a null, empty or zero vector, or a null or non-finite component
take no part. Vectors of another dimension than the query's are no candidates. Rows that agree
in id and vector count once; the query's own id is no candidate. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairlore.llm.common import table

NEAREST = 5
QUERY_BLOCK = 8192  # rows; a candidate is sent once per query block
CANDIDATE_BLOCK = 8192
TILE = 1024  # rows of a block that are multiplied at once
EXACT_IN_FLOAT = 2**24 // 127**2  # dimensions up to which sums of code products are exact

FOUND = "query_key long, query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, each once."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
        .distinct()
    )


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, length of the coded vector and length of the rounding error."""
    scale = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = code * scale[:, None]
    return code, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(unit - coded, axis=1)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise product in double precision, summed in the order of the components."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def search_block(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """For each query a heap of its best (cosine, -id) among the candidates."""
    q_norm, c_norm = np.sqrt(dot(queries, queries)), np.sqrt(dot(candidates, candidates))
    qc, qs, ql, qe = codes(queries / q_norm[:, None])
    cc, cs, _, ce = codes(candidates / c_norm[:, None])
    kind = np.float32 if queries.shape[1] <= EXACT_IN_FLOAT else np.float64
    heaps: list[list[tuple[float, int]]] = [[] for _ in queries]
    for c0 in range(0, len(candidates), TILE):
        c = slice(c0, c0 + TILE)
        right = cc[c].astype(kind).T  # small integers: the sums below are exact
        for q0 in range(0, len(queries), TILE):
            q = slice(q0, q0 + TILE)
            near = (qc[q].astype(kind) @ right).astype(np.float64) * (qs[q][:, None] * cs[c])
            error = ql[q][:, None] * ce[c] + qe[q][:, None] + 1e-9
            own = query_ids[q][:, None] == ids[c]
            near[own] = -np.inf
            lower = near - error
            full = lower.shape[1] >= k
            bar = np.partition(lower, -k, axis=1)[:, -k] if full else np.full(len(lower), -np.inf)
            held = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[q]])
            left, column = np.nonzero((near + error >= np.maximum(bar, held)[:, None]) & ~own)
            rows, columns = left + q0, column + c0
            score = dot(queries[rows], candidates[columns]) / (q_norm[rows] * c_norm[columns])
            for row, value, vec in zip(rows.tolist(), score.tolist(), ids[columns].tolist(), strict=True):
                heap = heaps[row]
                if len(heap) < k:
                    heapq.heappush(heap, (value, -vec))
                elif (value, -vec) > heap[0]:
                    heapq.heapreplace(heap, (value, -vec))
    return heaps


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST) -> DataFrame:
    """query_id, rank from 1, vec_id, score of the ``k`` largest cosines, ties to smaller ids.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id.
    """
    rows = usable(vectors).withColumn("n", F.size("vector")).withColumn("key", F.xxhash64("vec_id", "vector"))
    queries = rows.where(is_query)
    count = rows.agg(F.count("*").alias("all"), F.count(F.when(is_query, 1)).alias("queries")).first()
    query_blocks = -(-count["queries"] // QUERY_BLOCK) or 1
    blocks = -(-count["all"] // CANDIDATE_BLOCK) or 1

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        df = df.withColumn(own, F.pmod("key", F.lit(n)).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in ("query_key", "query_id", "vec_id", "score")})
        heaps = search_block(
            np.stack(left["vector"].to_numpy()), left["vec_id"].to_numpy(),
            np.stack(right["vector"].to_numpy()), right["vec_id"].to_numpy(), k,
        )
        found = [
            (key, query, -vec, score)
            for key, query, heap in zip(left["key"], left["vec_id"], heaps, strict=True)
            for score, vec in heap
        ]
        return pd.DataFrame(found, columns=["query_key", "query_id", "vec_id", "score"])

    keys = ("q_block", "c_block", "n")
    found = (
        dealt(queries, "q_block", query_blocks, "c_block", blocks).groupBy(*keys)
        .cogroup(dealt(rows, "c_block", blocks, "q_block", query_blocks).groupBy(*keys))
        .applyInPandas(search, FOUND)
    )
    best = Window.partitionBy("query_key", "query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_dot_product(q.v, c.v)
           / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
