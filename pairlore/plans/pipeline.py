"""The whole job: n-grams in, collocations per decade out."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from pairlore.functions.measures import has_all_components, is_perfect, is_positive, npmi, repeatable_sum
from pairlore.functions.words import stop_text
from pairlore.operators.counts import (
    PAIR_KEYS,
    first_word_counts,
    pair_counts,
    second_word_counts,
)
from pairlore.operators.scores import (
    SUM_SCOPES,
    attach_counts,
    attach_per_decade,
    by_descending_score,
    check_threshold,
    contingency,
    contingency_in_place,
    npmi_scores,
    npmi_sums,
    passing_scores,
    totals_of_words,
)

STAGES = (
    "pair_counts", "first_word_counts", "second_word_counts", "decade_totals", "contingency",
    "npmi_sums",
)


def collocations(
    ngrams: DataFrame,
    min_npmi: float,
    rel_min_npmi: float,
    *,
    stop_words: Sequence[str] | None = None,
    stopword_mode: str = "substring",
    sum_scope: str = "positive",
    include_perfect: bool = False,
    decade_join: str = "auto",
    laid_out: bool = False,
) -> DataFrame:
    """Ordered word pairs that pass either threshold, best first within each decade.

    One lazy plan; nothing runs before an action.  The scores are used twice, for the result
    and for their sum, and both uses read one exchange, so the word joins run once.  By
    default that exchange holds the positive pairs only, in result order; with another sum scope or
    with perfect pairs it holds every scored pair with flags that each use filters on.  For a large
    corpus prefer ``collocations_from(write_stages(...), ...)``, which keeps every step.
    ``decade_join="shuffle"`` takes the joins that split a hot word or decade (``contingency``).
    ``laid_out`` suits n-grams whose rows lie by ``word_keys`` (``contingency_in_place``); the
    result is the same for any.
    """
    check_threshold("min_npmi", min_npmi)
    check_threshold("rel_min_npmi", rel_min_npmi)
    # Zero components score nothing; filtering them before the table forks keeps the two
    # branches alike, so that they share the shuffles below the joins.
    pairs = pair_counts(ngrams, stop_words, stopword_mode)
    table = contingency_in_place(pairs, laid_out) if decade_join == "auto" else contingency(pairs, decade_join)
    table = table.where(has_all_components())
    if sum_scope == "positive" and not include_perfect:
        scores = npmi_scores(table).select(*PAIR_KEYS, "npmi")
        # dealt out in result order, which the listing then needs no other exchange for
        scores = scores.repartitionByRange("decade", F.desc("npmi"), "w1", "w2")
        # An exchange is shared only if both uses need the same columns: the test of the
        # words, which always holds, keeps them in the sum.
        has_words = F.max(F.xxhash64("w1", "w2")).isNotNull()
        sums = scores.groupBy("decade").agg(
            F.when(has_words, repeatable_sum(F.col("npmi"))).alias("sum_npmi")
        )
    else:
        scores, sums = _scores_and_sums(table, include_perfect, sum_scope)
    passing = passing_scores(scores, sums, min_npmi, rel_min_npmi, decade_join)
    return by_descending_score(passing)


def _scores_and_sums(table: DataFrame, include_perfect: bool, sum_scope: str) -> tuple[DataFrame, DataFrame]:
    """Scores and decade sums of other scopes from one exchange of every scored pair.

    Each pair carries its kind (0 negative, 1 positive, 2 perfect).  Both uses read the same
    columns of one exchange, so Spark plans it once and reuses it; pairs a use does not take
    get a null score instead of a filter, which Spark would push below the exchange into one
    use only.  A null score passes no threshold.
    """
    if sum_scope not in SUM_SCOPES:
        raise ValueError(f"sum_scope must be one of {SUM_SCOPES}, not {sum_scope!r}")
    kind = F.when(is_perfect(), 2).when(is_positive(), 1).otherwise(0)
    flagged = table.select(*PAIR_KEYS, npmi().alias("npmi"), kind.alias("kind")).repartition(
        F.xxhash64(*PAIR_KEYS)
    )
    kept = (1, 2) if include_perfect else (1,)
    scores = flagged.select(*PAIR_KEYS, F.when(F.col("kind").isin(*kept), F.col("npmi")).alias("npmi"))
    counted = (1,) if sum_scope == "positive" else (0, 1, 2)
    has_words = F.max(F.xxhash64("w1", "w2")).isNotNull()  # same columns as the scores' use
    sums = flagged.groupBy("decade").agg(
        F.when(has_words, repeatable_sum(F.when(F.col("kind").isin(*counted), F.col("npmi")))).alias("sum_npmi")
    )
    return scores, sums


def write_stages(
    ngrams: DataFrame,
    folder: str,
    *,
    stop_words: Sequence[str] | None = None,
    stopword_mode: str = "substring",
    sum_scope: str = "positive",
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Run the counting stages once each and keep every result as a table in ``folder``.

    ``folder`` must be on storage that all executors share.  Each stage reads the tables of
    the stages before it, so a lost executor costs at most the tasks of the current stage,
    the corpus is scanned once, and the marginals have a known size when the join is
    planned.

    The run can be resumed.  A stage is finished when its manifest (``_done/<stage>``: the
    options and a fingerprint of the input) follows its table; a second call with the same
    input and options reads finished tables and computes only the rest, so a job lost after
    stage 3 does not scan the corpus again.  A table without manifest is an unfinished one and
    is replaced.  A finished stage of other options or another input stops the call.

    With ``buckets``, pairs and first-word counts are stored bucketed on (decade, w1) and
    second-word counts on (decade, w2), in that many buckets, and registered as tables of the
    session: the join of pairs and first-word counts then reads both without an exchange, and
    the second-word counts need none either.  A hot decade is spread over all buckets, as the
    words are part of the key.
    """
    spark = ngrams.sparkSession
    chosen = _options(stop_words, stopword_mode, sum_scope)
    mark = {**chosen, "input": _fingerprint(ngrams), "buckets": str(buckets)}

    def kept(name: str, make, keys: tuple[str, ...] = ()) -> DataFrame:
        path = f"{folder}/{name}"
        layout = _Bucketed(spark, folder, name, keys, buckets) if buckets and keys else None
        done = _manifest(spark, f"{folder}/_done/{name}")
        if done is not None:
            other = sorted(k for k in mark if done.get(k) != mark[k])
            if other:
                raise ValueError(f"stage {name} in {folder} was written with another {', '.join(other)}")
            return layout.read() if layout else spark.read.parquet(path)
        if layout:
            layout.write(make())
        else:
            make().write.mode("overwrite").parquet(path)
        rows = sorted({**mark, "stage": name}.items())
        spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").json(
            f"{folder}/_done/{name}"
        )
        return layout.read() if layout else spark.read.parquet(path)

    first, second = ("decade", "w1"), ("decade", "w2")
    pairs = kept("pair_counts", lambda: pair_counts(ngrams, stop_words, stopword_mode), first)
    c1 = kept("first_word_counts", lambda: first_word_counts(pairs), first)
    c2 = kept("second_word_counts", lambda: second_word_counts(pairs), second)
    n = kept("decade_totals", lambda: totals_of_words(c1))
    if buckets:  # pairs meet their first-word counts in place, the totals come after

        def joined() -> DataFrame:
            with_c1 = attach_per_decade(pairs.join(c1, ["decade", "w1"]), n, "n")
            return with_c1.join(c2, ["decade", "w2"]).select(*PAIR_KEYS, "c12", "c1", "c2", "n")

        table = kept("contingency", joined)
    else:
        table = kept("contingency", lambda: attach_counts(pairs, attach_per_decade(c1, n, "n"), c2))
    sums = kept("npmi_sums", lambda: npmi_sums(table, sum_scope))
    kept("options", lambda: spark.createDataFrame(sorted(chosen.items()), "name string, value string"))
    return dict(zip(STAGES, (pairs, c1, c2, n, table, sums), strict=True))


class _Bucketed:
    """A stage table stored bucketed in ``folder`` and registered in the session's catalog."""

    def __init__(self, spark: SparkSession, folder: str, name: str, keys: tuple[str, ...], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, f"{folder}/{name}", keys, buckets
        digest = hashlib.sha256(folder.encode()).hexdigest()[:16]
        self.table = f"pairlore_{digest}_{name}"

    def write(self, df: DataFrame) -> None:
        (
            df.write.mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
            .option("path", self.path).saveAsTable(self.table)
        )

    def read(self) -> DataFrame:
        if not self.spark.catalog.tableExists(self.table):  # written by another session
            schema = self.spark.read.parquet(self.path).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {self.table} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
        return self.spark.table(self.table)


def _fingerprint(ngrams: DataFrame) -> str:
    """The input as a plan and the files it reads: equal for the same corpus and steps."""
    files = "\n".join(sorted(ngrams.inputFiles()))
    return hashlib.sha256(f"{ngrams.semanticHash()}\n{files}".encode()).hexdigest()


def _manifest(spark: SparkSession, path: str) -> dict[str, str] | None:
    """The manifest at ``path``, or None where the stage has not finished."""
    try:
        found = {r.name: r.value for r in spark.read.schema("name string, value string").json(path).collect()}
    except AnalysisException:
        return None
    return found if "stage" in found else None  # a manifest cut short marks nothing


def _options(stop_words: Sequence[str] | None, mode: str, scope: str) -> dict[str, str]:
    digest = hashlib.sha256(stop_text(stop_words).encode()).hexdigest()
    return {"stop_words": digest, "stopword_mode": mode, "sum_scope": scope}


def read_stages(
    spark: SparkSession,
    folder: str,
    *,
    stop_words: Sequence[str] | None = None,
    stopword_mode: str = "substring",
    sum_scope: str = "positive",
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """The tables an earlier ``write_stages`` with the same options left in ``folder``."""
    found = {r.name: r.value for r in spark.read.parquet(f"{folder}/options").collect()}
    wanted = _options(stop_words, stopword_mode, sum_scope)
    other = sorted(k for k in wanted if found.get(k) != wanted[k])
    if other:
        raise ValueError(f"the stages in {folder} were written with another {', '.join(other)}")
    keys = {"pair_counts": ("decade", "w1"), "first_word_counts": ("decade", "w1"), "second_word_counts": ("decade", "w2")}
    return {
        name: _Bucketed(spark, folder, name, keys[name], buckets).read()
        if buckets and name in keys else spark.read.parquet(f"{folder}/{name}")
        for name in STAGES
    }


def collocations_from(
    stages: dict[str, DataFrame],
    min_npmi: float,
    rel_min_npmi: float,
    *,
    include_perfect: bool = False,
) -> DataFrame:
    """Collocations from stage tables; other thresholds need no recount."""
    sums = stages["npmi_sums"]
    passing = passing_scores(
        npmi_scores(stages["contingency"], include_perfect),
        sums,
        min_npmi,
        rel_min_npmi,
    )
    return by_descending_score(passing)
