"""Every registered query against DuckDB on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points

DATA = "/root/testdata/sf0.001"
TRAINING_DATA = entry_points._training_data()[0].keys()  # has tests of its own
QUERIES = {k: v for k, v in entry_points.queries().items() if k not in TRAINING_DATA}
ORACLE = {k: v for k, v in entry_points.oracle_sql().items() if k not in TRAINING_DATA}

pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def normal(rows):
    return sorted(
        tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in row) for row in rows
    )


def test_catalogues_agree():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    cursor = duck.execute(ORACLE[name])
    order = [[d[0] for d in cursor.description].index(c) for c in columns]
    assert len(order) == len(cursor.description)
    want = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    got = [tuple(r) for r in found.select(columns).collect()]
    assert want
    assert normal(got) == normal(want)


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["decade", "w1", "w2", "npmi"]
    assert result.count() > 0
