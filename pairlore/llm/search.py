"""Ranked lexical search by a dual-tree traversal: every document against each benchmark item.

Terms are the maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]`` (ASCII letters and
every non-ASCII character) of the whole text, only A-Z lower-cased; null has none. With N
documents holding a term, L their terms with repeats, n a document's terms, df the documents
holding a term and tf its occurrences in one:

    w(t)      = floor(1000 * ln((2N + 2) / (2 df + 1)))           (in doubles)
    m(d)      = 10 + (90 * n * N) div L                          (64-bit integers from here)
    c(d, t)   = (10^9 * tf) div (1000 * tf + 8 * m)
    score     = sum over the item's distinct terms of w(t) * c(d, t)

and each item gets its ``TOP`` highest-scoring documents with score above 0, equal scores by
ascending doc_id (null ids last).

The method. Documents form a tree: leaves of ``BLOCK`` documents of similar length (m drives
c, so a leaf's documents weigh terms alike: within each input partition documents are ordered
by length and numbered), under nodes of ``FANOUT`` leaves. Items form a
tree of nodes of about ``ITEM_BLOCK`` items. Every node holds coordinate maxima: a document node
the largest c of each term below it, an item node the weight of each term of its items. For a pair
of nodes, sum(w * max c) over shared terms bounds every score between their members. Each item
first gets a threshold from exact scores of a seed set (the best ``TOP`` documents of each of its
terms): the weakest kth seed score, or 1. The traversal then
descends from (item node, upper node) to (item node, leaf) to (item, leaf) pairs, dropping every
pair whose bound is below the weakest threshold of the items it holds. At the bottom each leaf
that survives for some items is one block: its postings meet the terms of those items, at most
``PART`` items at a time, all scores are summed exactly, and the best ``TOP`` documents of each
item leave the block. A document with a score at or above the item's true kth score is
never dropped, as bounds only exceed scores and thresholds only trail them, so the result is exact.

Defined results for odd input: documents without terms (null, empty, digits and punctuation only)
are not counted and never ranked. Rows with equal doc_id are separate documents. Items with equal
item_id are one item holding the terms of all of them; an item without terms gets no rows. Empty
tables give an empty result. Extra input columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairlore.llm.common import ascii_lower, let, table
from pairlore.sources.scratch import Scratch, saved

TOP = 10
BLOCK = 256  # documents per leaf of the document tree
FANOUT = 64  # leaves per upper node
ITEM_BLOCK = 32  # items per node of the item tree
PART = 64  # item nodes that a leaf is scored against at a time
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # between terms


def terms(text: Column) -> Column:
    """All terms of a text, in order, with repeats; null: none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _counted(terms: Column) -> Column:
    """Distinct terms of an array with their numbers: (term, tf), from runs of the sorted terms."""

    def of_sorted(s: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(s) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("term"),
            (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("long").alias("tf"),
        )))

    return let(F.sort_array(terms), of_sorted)


def _item_terms(benchmark: DataFrame, weights: DataFrame) -> DataFrame:
    """(item_id, ikey, inode, term, w): distinct terms of each item that occur in some document.

    ``ikey`` is the item's join key: a null item_id is an item of its own.
    """
    ikey = F.concat(F.when(F.col("item_id").isNull(), "n").otherwise("v"), F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    items = benchmark.select("item_id", ikey.alias("ikey"), F.explode(terms(F.col("text"))).alias("term")).distinct()
    n_items = max(items.select("ikey").distinct().count(), 1)
    nodes = max(math.ceil(n_items / ITEM_BLOCK), 1)
    inode = F.pmod(F.xxhash64("ikey"), F.lit(nodes))
    return items.join(weights, "term").withColumn("inode", inode)


def _top(df: DataFrame, by: list[str], k: int, order: list[Column]) -> DataFrame:
    return (
        df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        .where(F.col("_r") <= k)
        .drop("_r")
    )


def ranked(documents: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank int, doc_id, score long): each item's best documents, exact."""
    spark = documents.sparkSession
    vocabulary = benchmark.select(F.explode(terms(F.col("text"))).alias("term")).distinct()
    # one pass over the texts: a row per document (term null) and its postings of the
    # query vocabulary, counted inside the row; the row number within the partition, after
    # ordering by length, places each document in a leaf of similar lengths
    tokens = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), terms(F.col("text")).alias("terms"))
        .withColumn("n", F.size("terms").cast("long"))
        .where(F.col("n") > 0)
        .sortWithinPartitions("n")
        .withColumn("rid", F.monotonically_increasing_id())
    )
    whole = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("tf")))
    found = tokens.select("rid", "doc_id", "n", F.inline(F.concat(whole, _counted(F.col("terms")))))
    raw = saved(
        found.join(F.broadcast(vocabulary.withColumn("known", F.lit(True))), "term", "left")
        .where(F.col("known") | F.col("term").isNull())
        .select("rid", "doc_id", "n", "term", "tf"),
        "search-postings",
    )
    stats = raw.where(F.col("term").isNull()).agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    if not stats.N:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    big_n, big_l = int(stats.N), int(stats.L)
    m = f"(10 + (90 * n * {big_n}L) div {big_l}L)"
    postings = raw.where(F.col("term").isNotNull()).select(
        "rid", "doc_id", "term", F.expr(f"(1000000000 * tf) div (1000 * tf + 8 * {m})").alias("c")
    )
    leaf, upper = F.floor(F.col("rid") / BLOCK).cast("long"), F.floor(F.col("rid") / (BLOCK * FANOUT)).cast("long")
    # df and the largest c of each term, in one aggregate
    term_stats = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("c").alias("top_c"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * big_n + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    items = saved(  # item_id, ikey, inode, term, w, top_c
        _item_terms(benchmark, term_stats.select("term", weight.alias("w"), "top_c")), "search-items"
    )
    leaf_max = saved(
        postings.groupBy(leaf.alias("leaf"), upper.alias("upper"), "term").agg(F.max("c").alias("maxc")),
        "search-leaves",
    )
    upper_max = leaf_max.groupBy("upper", "term").agg(F.max("maxc").alias("maxc"))

    def exact(pairs: DataFrame, docs_of: DataFrame, on: list[str]) -> DataFrame:
        """Exact scores of (item, document) for the item's terms the documents hold."""
        return (
            pairs.join(items.select("ikey", "item_id", "term", "w"), "ikey")
            .join(docs_of, on)
            .groupBy("ikey", "item_id", "rid")
            .agg(F.sum(F.col("w") * F.col("c")).alias("score"))
            .where(F.col("score") > 0)
        )

    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("rid")]
    by_c = [F.col("c").desc(), F.col("rid")]  # any real scores give a threshold

    # thresholds: exact scores of each term's best documents
    seeds = _top(postings, ["term"], top, by_c)  # limited per term map-side, then per term
    seed_pairs = items.select("ikey", "term").join(seeds.select("term", "rid"), "term").select("ikey", "rid").distinct()
    seeded = exact(seed_pairs, postings, ["rid", "term"])
    kth = _top(seeded, ["ikey"], top, [F.col("score").desc(), F.col("rid")]).groupBy("ikey").agg(
        F.min("score").alias("kth"), F.count(F.lit(1)).alias("found")
    )
    tau = saved(
        items.select("ikey", "inode").distinct()
        .join(kth, "ikey", "left")
        .select("ikey", "inode", F.when(F.col("found") >= top, F.col("kth")).otherwise(F.lit(1)).cast("long").alias("tau")),
        "search-thresholds",
    )
    node_tau = tau.groupBy("inode").agg(F.min("tau").alias("tau"))
    node_terms = items.select("inode", "term", "w").distinct()

    # (item node, upper node) -> (item node, leaf) -> (item, leaf), pruned by bounds
    top_pairs = (
        node_terms.join(upper_max, "term")
        .groupBy("inode", "upper").agg(F.sum(F.col("w") * F.col("maxc")).alias("bound"))
        .join(node_tau, "inode").where(F.col("bound") >= F.col("tau"))
        .select("inode", "upper")
    )
    leaf_pairs = (
        top_pairs.join(node_terms, "inode")
        .join(leaf_max, ["upper", "term"])
        .groupBy("inode", "leaf").agg(F.sum(F.col("w") * F.col("maxc")).alias("bound"))
        .join(node_tau, "inode").where(F.col("bound") >= F.col("tau"))
        .select("inode", "leaf")
    )
    part = F.floor(F.col("inode") / PART).cast("long").alias("part")
    item_leaves = saved(
        leaf_pairs.join(tau, "inode")
        .join(items.select("ikey", "term", "w"), "ikey")
        .join(leaf_max.select("leaf", "term", "maxc"), ["leaf", "term"])
        .groupBy("ikey", "inode", "leaf", "tau").agg(F.sum(F.col("w") * F.col("maxc")).alias("bound"))
        .where(F.col("bound") >= F.col("tau"))
        .select("ikey", "leaf", "tau", part),
        "search-pairs",
    )
    # the surviving leaves' documents are scored block by block
    wanted = item_leaves.join(items.select("ikey", "term", "w"), "ikey")
    held = postings.select(
        leaf.alias("leaf"), "rid", F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"), "term", "c",
    ).join(item_leaves.select("leaf", F.col("part").alias("block")).distinct(), "leaf")

    def block(documents_of: pd.DataFrame, items_of: pd.DataFrame) -> pd.DataFrame:
        return best_of_block(documents_of, items_of, top)

    scored = (
        held.groupBy(F.col("leaf").alias("at"), "block").cogroup(wanted.groupBy("leaf", "part"))
        .applyInPandas(block, "ikey string, rid long, doc_id long, no_id boolean, score long")
        .withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id")))
    )
    best = _top(scored, ["ikey"], top, order).join(items.select("ikey", "item_id").distinct(), "ikey")
    return best.select(
        "item_id",
        F.row_number().over(Window.partitionBy("ikey").orderBy(*order)).alias("rank"),
        "doc_id",
        F.col("score").cast("long").alias("score"),
    )


def best_of_block(documents: pd.DataFrame, items: pd.DataFrame, top: int) -> pd.DataFrame:
    """The ``top`` best documents of one leaf for each item, among those that reach its threshold.

    ``documents`` are postings (rid, doc_id, no_id, term, c), ``items`` their terms (ikey, tau, term, w).
    """
    term_of, vocabulary = pd.factorize(documents["term"])
    doc_of, rids = pd.factorize(documents["rid"])
    item_of, ikeys = pd.factorize(items["ikey"])
    ids = documents.drop_duplicates("rid")  # in the order of rids
    taus = items.drop_duplicates("ikey")["tau"].to_numpy()
    scores = np.zeros((len(ikeys), len(rids)), dtype=np.int64)
    # rows of one term lie together on both sides
    by_term, wanted = np.argsort(term_of, kind="stable"), pd.Index(vocabulary).get_indexer(items["term"])
    known = np.flatnonzero(wanted >= 0)
    known = known[np.argsort(wanted[known], kind="stable")]
    starts = np.searchsorted(term_of[by_term], np.arange(len(vocabulary) + 1))
    c, w = documents["c"].to_numpy(), items["w"].to_numpy()
    for rows in np.split(known, np.flatnonzero(np.diff(wanted[known])) + 1) if len(known) else ():
        term = wanted[rows[0]]
        places = by_term[starts[term] : starts[term + 1]]
        scores[np.ix_(item_of[rows], doc_of[places])] += w[rows, None] * c[places]
    item, doc = np.nonzero(scores >= np.maximum(taus, 1)[:, None])
    score = scores[item, doc]
    doc_id, no_id, rid = (ids[x].to_numpy()[doc] for x in ("doc_id", "no_id", "rid"))
    order = np.lexsort((rid, doc_id, no_id, -score, item))
    nth = np.arange(len(order)) - np.searchsorted(item[order], item[order])
    kept = order[nth < top]
    return pd.DataFrame({
        "ikey": np.asarray(ikeys, dtype=object)[item[kept]], "rid": rid[kept], "doc_id": doc_id[kept],
        "no_id": no_id[kept], "score": score[kept],
    })


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's 10 best documents of the whole table."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    with Scratch(spark) as scope:  # postings and thresholds go when the result is written
        return scope.result(ranked(documents, benchmark), "search")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
docs AS (SELECT rid, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
stats AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
post AS (
  SELECT rid, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * big_n + 2) / (2.0 * df + 1))) AS BIGINT) AS w FROM dfs, stats),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT i.item_id, p.rid, p.doc_id,
         sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * s.big_n) // s.big_l))))  AS score
  FROM items i JOIN post p USING (term) JOIN w USING (term), stats s
  GROUP BY ALL),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, rid) AS INTEGER) AS rank,
         doc_id, CAST(score AS BIGINT) AS score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
