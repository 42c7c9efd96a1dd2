"""op11: exact deduplication by normalised text, hot digests settled map-side."""

import hashlib
import re

import pytest

from pairlore.llm import exact
from llm_helpers import ODD, docs, tables  # noqa: F401


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups.setdefault(norm, []).append(doc_id)
    out = []
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        ids = [i for i in groups[norm] if i is not None]
        keep = min(ids) if ids else None
        kept = True if keep is None else doc_id == keep
        out.append((doc_id, keep, len(groups[norm]), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(
        [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()], key=repr
    )


@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_odd_rows_match_brute_force(docs, counters):
    rows = ODD + [(20, "one  two"), (21, "one\ttwo"), (None, "one two"), (30, None), (31, "")]
    got = result(exact.copies(docs(*rows), counters))
    assert got == brute(rows)


def test_hot_group_is_settled_map_side(docs):
    rows = [(i, "the same text") for i in range(300)] + [(1000 + i, f"text {i}") for i in range(50)]
    marks = exact.copies(docs(*rows), counters=4)
    hot = {r.text_sha256 for r in marks.where("hot").collect()}
    assert hot == {hashlib.sha256(b"the same text").hexdigest()}
    assert result(marks) == brute(rows)
    assert marks.where("kept").count() == 51


def test_empty_table(docs, spark):
    empty = docs(*[(1, "x")]).where("false")
    assert exact.copies(empty).count() == 0


def test_deduplicated_keeps_columns(docs):
    rows = [(1, "a b"), (2, "a  b"), (3, "c"), (None, "d"), (None, "d")]
    kept = exact.deduplicated(docs(*rows))
    assert kept.columns == docs(*rows).columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["1", "3", "None", "None"]


def test_query_matches_sql_on_small_table(spark, tables, docs):
    import duckdb
    rows = ODD + [(40, "x y"), (41, "x  y")]
    folder = tables(documents=docs(*rows))
    got = result(exact.op11_exact(spark, folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = sorted(con.execute(exact.ORACLE_SQL).fetchall(), key=repr)
    assert got == want
