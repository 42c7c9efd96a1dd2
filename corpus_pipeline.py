"""The training-data pipeline: five stages from ``documents`` to a mix.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written to shared storage
and read again as the next one's input. All but the last return the columns of ``documents``:

* toxicity: documents that the classifier rejects go; its labels are read from ``labels``;
* near_duplicates: of each group of near copies (5-word shingles, similarity 0.8 or more) the
  document with the smallest id stays; documents without words stay;
* decontamination: documents that the contamination rule marks go, against ``benchmark``;
* pii: personal data in the text is replaced by its kind in brackets, ``n_chars`` follows;
* mixing: every document with its size, its source's size and target, and the words taken.

Null and empty texts are clean: they pass every stage. An empty table passes as an empty one,
extra columns pass unchanged, and repeated rows count as copies in near_duplicates.
No SQL can express the classifier or the redaction, so there is no SQL for the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.llm import jaccard, mixing, pii, toxicity, winnowing
from pairlore.llm.common import n_tokens, table
from pairlore.sources.scratch import saved

NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, "_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(docs, table(spark, sf_dir, "benchmark"))
    return winnowing.without(docs, found.where("contaminated"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, n_tokens(F.col("text")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("mixing", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
