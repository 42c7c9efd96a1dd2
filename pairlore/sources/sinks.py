"""Result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pairlore.operators.scores import by_descending_score
from pairlore.sources.facts import as_facts, write_facts


def write_by_decade(collocations: DataFrame, path: str, format: str = "parquet") -> None:
    """One directory per decade; its files, taken by name, list the pairs in order.

    The rows are range-partitioned on the whole sort key, so a decade that holds most of
    the result is spread over many tasks and files instead of passing through one.
    """
    by_descending_score(collocations).write.partitionBy("decade").format(format).save(path)


def write_text(collocations: DataFrame, path: str) -> None:
    """Lines ``decade TAB w1 TAB w2 TAB Npmi TAB value`` in result order."""
    write_facts(as_facts(by_descending_score(collocations), "Npmi", "npmi"), path)
