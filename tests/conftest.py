import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("pairlore-tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_all(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="session")
def ngrams(spark):
    """N-gram table from (ngram, match_count[, year]) tuples; the year defaults to 1994."""

    def make(*rows):
        return spark.createDataFrame(
            [(r[0], r[2] if len(r) > 2 else 1994, r[1]) for r in rows],
            "ngram string, year bigint, match_count bigint",
        )

    return make


GOLDEN = (
    ("rain deer", 4),
    ("rain fall", 6),
    ("snow fall", 5),
    ("global warming", 8),
    ("snow deer", 1),
)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
