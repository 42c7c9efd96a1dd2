"""The registered queries and the pipeline on the smallest tables."""

from pathlib import Path

import brute
import corpus_pipeline
import pytest
from llm_helpers import ODD, docs, tables  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from pairlore.llm import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


def test_all_are_registered():
    names = entry_points.queries().keys()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = registry.queries()[name](spark, DATA)
    cursor = connection.execute(registry.oracle_sql()[name])
    order = [[d[0] for d in cursor.description].index(c) for c in found.columns]
    want = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    assert want and sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_secrets(spark, documents):
    found = registry.queries()["op8_secrets"](spark, DATA).drop("spans")
    assert sorted(map(tuple, found.collect())) == sorted((i, *brute.secrets(t)) for i, t in documents)


def test_pii(spark, documents):
    found = registry.queries()["op6_pii"](spark, DATA).drop("spans")
    assert sorted(map(tuple, found.collect())) == sorted((i, *brute.pii(t)) for i, t in documents)


def test_jaccard(spark, documents):
    found = registry.queries()["op3_jaccard"](spark, DATA)
    assert sorted(map(tuple, found.collect())) == sorted(brute.near_groups(documents))


def test_winnowing(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    found = registry.queries()["op9_winnowing"](spark, DATA)
    assert sorted(map(tuple, found.collect())) == sorted(brute.contamination(documents, items))


def test_pipeline_stages(spark):
    """Every stage does its work on what the one before it kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    bench = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = corpus_pipeline.saved(stage(spark, docs, DATA), name)
        after = [(r.doc_id, r.text) for r in docs.collect()]
        if name != "mixing":
            assert docs.columns == columns
        if name == "near_duplicates":
            groups = brute.near_groups(before, 5, 80)
            assert sorted(i for i, _ in after) == sorted(i for i, n, c in groups if not n or i == c)
        elif name == "decontamination":
            assert sorted(i for i, _ in after) == sorted(r[0] for r in brute.contamination(before, bench) if not r[5])
        elif name == "pii":
            assert len(after) == len(before) and not any(sum(brute.pii(t)[:4]) for _, t in after)
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "toxicity":
            assert set(after) <= set(before) and len(after) >= 0.8 * len(before)
    assert {"size", "source_size", "target", "taken"} <= set(docs.columns) and len(after) == len(before)


def test_pipeline_takes_odd_rows(spark, docs, tables):
    frame = docs(*ODD).withColumn("n_chars", F.length("text"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, None), (2, "one two")], "item_id long, text string")
    folder = tables(documents=frame, labels=labels, benchmark=bench)
    kept = sorted((str(r.doc_id) for r in corpus_pipeline.run(spark, folder).collect()))
    assert kept == ["1", "2", "3", "6", "9", "None", "None"]
    nothing = tables(documents=frame.where("false"), labels=labels, benchmark=bench.where("false"))
    assert corpus_pipeline.run(spark, nothing).count() == 0
