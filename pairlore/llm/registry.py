"""The registered queries of this folder and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairlore.llm import mixing, neighbours
from pairlore.llm import conversations, exact, search
from pairlore.llm.jaccard import op3_jaccard
from pairlore.llm.pii import op6_pii
from pairlore.llm.ppm import op10_ppm
from pairlore.llm.quality import op7_quality
from pairlore.llm.secrets import op8_secrets
from pairlore.llm.toxicity import op1_toxicity
from pairlore.llm.urls import op2_urls
from pairlore.llm.winnowing import op9_winnowing


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_toxicity, op2_urls, op3_jaccard, mixing.op4_mixing, neighbours.op5_neighbours, op6_pii, op7_quality, op8_secrets,
        op9_winnowing, op10_ppm, exact.op11_exact, conversations.op12_repair, search.op13_search,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": mixing.ORACLE_SQL, "op11_exact": exact.ORACLE_SQL, "op13_search": search.ORACLE_SQL, "op5_neighbours": neighbours.ORACLE_SQL}
