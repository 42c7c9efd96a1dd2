"""Connected components of a link table by star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairlore.sources.scratch import Scratch, saved


def _pointed(pairs: DataFrame, by: str) -> DataFrame:
    """``pairs`` with the least neighbour of ``by``; both sides of the join are tables.

    A hub's rows then sit behind an exchange that adaptive execution can split.
    """
    least = saved(pairs.groupBy(by).agg(F.min("low" if by == "high" else "to").alias("least")), "least")
    return pairs.join(least, by)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the least node reached.

    Every round writes its edges, so lineage stays short, and deletes its other tables; rounds
    are logarithmic in the longest path, and the edges never outgrow the links.
    """
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    )
    edges, before = saved(edges.distinct(), "edges"), None
    while True:
        both = edges.select(F.col("high").alias("from"), F.col("low").alias("to")).unionByName(
            edges.select(F.col("low").alias("from"), F.col("high").alias("to"))
        )
        with Scratch(links.sparkSession) as scope:
            large = (
                _pointed(both, "from")
                .where(F.col("to") > F.col("from"))
                .select(F.col("to").alias("high"), F.least("least", "from").alias("low"))
                .where("high != low")
            )
            small = _pointed(saved(large.distinct(), "large"), "high")
            edges = scope.result(
                small.select("high", F.col("least").alias("low"))
                .unionByName(small.where("low != least").select(F.col("low").alias("high"), F.col("least").alias("low")))
                .distinct(),
                "edges",
            )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("low").alias("node")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
