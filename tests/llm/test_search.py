"""op13: dual-tree ranked search against a plain scorer."""

import math
import re

import pandas as pd
import pytest
from llm_helpers import ODD, docs, tables  # noqa: F401
from pyspark.sql import functions as F

from pairlore.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return TERM.findall(low)


def brute(rows, items, top=10):
    docs = [(i, words(t)) for i, t in rows if words(t)]
    big_n, big_l = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, ts in docs:
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    terms_of = {}
    for item, text in items:
        terms_of.setdefault(item, set()).update(words(text))
    out = []
    for item, its in terms_of.items():
        scored = []
        for doc_id, ts in docs:
            m = 10 + (90 * len(ts) * big_n) // big_l
            s = 0
            for t in its:
                tf = ts.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    s += w * ((10**9 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scored.append((-s, (doc_id is None, doc_id or 0), doc_id, s))
        scored.sort(key=lambda r: r[:2])
        out += [(item, k + 1, d, s) for k, (_, _, d, s) in enumerate(scored[:top])]
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()], key=repr)


ROWS = ODD + [
    (10, "The cat sat on the mat. The cat!"), (11, "a dog and a cat"), (12, "dogs 123 CATS"), (13, "mat mat mat mat"),
    (14, "the the the"), (15, "cat"), (15, "cat"), (16, "über café naïve cat"), (17, "x1y2z3 cat-dog"),
] + [(100 + i, f"cat dog {'mat ' * (i % 7)} word{i % 5} w{i}") for i in range(60)]
ITEMS = [(1, "the cat"), (2, "MAT and dog"), (3, "café über"), (3, "mat"), (4, "1234 ..."), (5, None), (None, "word3 cat")]


@pytest.mark.parametrize("block,fanout,item_block", [(256, 64, 32), (2, 2, 1), (5, 3, 2)])
def test_matches_brute_force(spark, docs, monkeypatch, block, fanout, item_block):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "FANOUT", fanout)
    monkeypatch.setattr(search, "ITEM_BLOCK", item_block)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(search.ranked(docs(*ROWS), bench)) == brute([(r[0], r[1]) for r in ROWS], ITEMS)


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = docs(*ROWS).where("false")
    assert search.ranked(none, bench).count() == 0
    assert search.ranked(docs(*ROWS), bench.where("false")).count() == 0


def test_query_matches_sql(spark, docs, tables):
    import duckdb
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    folder = tables(documents=docs(*ROWS), benchmark=bench)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    want = sorted(con.execute(search.ORACLE_SQL).fetchall(), key=repr)
    assert got(search.op13_search(spark, folder)) == want == brute([(r[0], r[1]) for r in ROWS], ITEMS)


def test_terms_are_counted_inside_the_row(spark):
    rows = spark.createDataFrame([(["b", "a", "b", "é"],), ([],)], "terms array<string>").select(search._counted(F.col("terms")).alias("c"))
    assert [tuple(c) for c in rows.first().c] == [("a", 1), ("b", 2), ("é", 1)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_block_hands_on_the_best_of_each_item():
    held = [(r, 100 - r, r == 3, t, c) for r, t, c in ((1, "a", 5), (2, "a", 5), (3, "a", 5), (4, "b", 9), (5, "a", 1))]
    items = [("x", 1, "a", 2), ("y", 20, "a", 2), ("y", 20, "b", 3), ("z", 1, "c", 7)]
    found = search.best_of_block(
        pd.DataFrame(held, columns=["rid", "doc_id", "no_id", "term", "c"]),
        pd.DataFrame(items, columns=["ikey", "tau", "term", "w"]), 3,
    )
    assert found[["ikey", "rid", "score"]].values.tolist() == [["x", 2, 10], ["x", 1, 10], ["x", 3, 10], ["y", 4, 27]]
