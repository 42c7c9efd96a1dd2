"""

Two n-gram fixtures are derived from the driver's tables, by the same rule in Spark and in
SQL: ``doc_ngrams`` (adjacent words of ``documents``, year 1950 + doc_id % 60) and
``part_ngrams`` (part names weighted by the quantity ordered in a year).
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore import (
    accepted_bigrams,
    bigrams_of_text,
    by_second_word,
    by_words_nulls_first,
    collocations,
    collocations_from,
    contingency,
    count_facts,
    decade_totals,
    default_stop_words,
    first_word_counts,
    in_fact_order,
    integrity_audit,
    multi_level_counts,
    ngrams_from_text,
    npmi_scores,
    npmi_sums,
    pair_counts,
    passing_scores,
    pivot_counts,
    read_count_facts,
    read_lines,
    read_ngrams,
    read_score_facts,
    rejected_ngram_lines,
    second_word_counts,
    two_word_ngrams,
    union_facts,
    without_listed_words,
    write_by_decade,
    write_facts,
    write_sequence_file,
    write_stages,
    write_text,
)
from pairlore.functions.words import has_digit, is_short
from pairlore.operators.counts import PAIR_KEYS, word_keys
from pairlore.sources.facts import as_facts
from pairlore.sources.scratch import saved, shared_folder

# At 2.5e-5 of a decade's sum, either threshold lets pairs through that the other stops.
DOC_THRESHOLDS = (0.5, 2.5e-5)
PART_THRESHOLDS = (0.05, 0.1)
NEVER = 2.0  # above every score and every share: switches one of the two thresholds off


# ----------------------------------------------------------------------------- fixtures
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def doc_ngrams(spark: SparkSession, sf_dir: str, *together: Column) -> DataFrame:
    year = 1950 + F.col("doc_id") % 60
    return ngrams_from_text(_documents(spark, sf_dir), "text", year, "doc_id", together)


def doc_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bigrams uncounted; every count over them is the same."""
    year = 1950 + F.col("doc_id") % 60
    return bigrams_of_text(_documents(spark, sf_dir), "text", year)


def part_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.col("p_name").alias("ngram"),
            F.year("o_orderdate").cast("bigint").alias("year"),
        )
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("match_count"),
            F.count_distinct("o_orderkey").alias("volume_count"),
        )
    )


def english_only_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All document bigrams, counting English texts only: the others have count 0."""
    documents = _documents(spark, sf_dir, "lang")
    year = 1950 + F.col("doc_id") % 60
    bigrams = bigrams_of_text(documents, "text", year, "lang")
    english = F.when(F.col("lang") == "en", F.col("match_count")).otherwise(F.lit(0))
    return bigrams.select("w1", "w2", "year", english.alias("match_count"))


def _rounded(table: DataFrame, *columns: str) -> DataFrame:
    return table.withColumns({c: F.round(c, 6) for c in columns})


# ------------------------------------------------------------------------------ queries
def q_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on documents as one lazy plan; it needs no scratch folder."""
    return _rounded(collocations(doc_bigrams(spark, sf_dir), *DOC_THRESHOLDS), "npmi")


def q_collocations_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through stage tables on shared storage."""
    stages = write_stages(doc_bigrams(spark, sf_dir), shared_folder(spark))
    return _rounded(collocations_from(stages, *DOC_THRESHOLDS), "npmi")


def q_collocations_lazy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on counted n-grams, which lie by first word and decade, as it counts them first."""
    ngrams = doc_ngrams(spark, sf_dir, *word_keys())
    return _rounded(collocations(ngrams, *DOC_THRESHOLDS, laid_out=True), "npmi")


def q_collocations_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(collocations(part_ngrams(spark, sf_dir), *PART_THRESHOLDS), "npmi")


def q_collocations_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(part_ngrams(spark, sf_dir), PART_THRESHOLDS[0], NEVER)
    return _rounded(found, "npmi")


def q_collocations_rel(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(part_ngrams(spark, sf_dir), NEVER, PART_THRESHOLDS[1])
    return _rounded(found, "npmi")


def q_collocations_exact_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    ngrams = doc_bigrams(spark, sf_dir)
    return _rounded(collocations(ngrams, *DOC_THRESHOLDS, stopword_mode="exact"), "npmi")


def q_collocations_doc_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(collocations(doc_bigrams(spark, sf_dir), DOC_THRESHOLDS[0], NEVER), "npmi")


def q_collocations_doc_rel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(collocations(doc_bigrams(spark, sf_dir), NEVER, DOC_THRESHOLDS[1]), "npmi")


def q_collocations_sum_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perfect pairs raise the sum, so fewer pairs pass the relative threshold."""
    ngrams = doc_bigrams(spark, sf_dir)
    return _rounded(collocations(ngrams, NEVER, DOC_THRESHOLDS[1], sum_scope="all"), "npmi")


def q_collocations_with_perfect(spark: SparkSession, sf_dir: str) -> DataFrame:
    ngrams = doc_bigrams(spark, sf_dir)
    return _rounded(collocations(ngrams, *DOC_THRESHOLDS, include_perfect=True), "npmi")


def q_collocations_shuffle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ngrams = part_ngrams(spark, sf_dir)
    return _rounded(collocations(ngrams, *PART_THRESHOLDS, decade_join="shuffle"), "npmi")


def q_doc_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_ngrams(spark, sf_dir)


def q_accepted_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_bigrams(part_ngrams(spark, sf_dir))


def q_accepted_bigrams_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_bigrams(doc_ngrams(spark, sf_dir))


def q_stopword_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_bigrams(doc_ngrams(spark, sf_dir), stopword_mode="exact")


def q_stopword_exact_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(w,) for w in default_stop_words()], "word string")
    bigrams = two_word_ngrams(part_ngrams(spark, sf_dir)).where(
        ~is_short("w1") & ~is_short("w2") & ~has_digit("ngram")
    )
    return without_listed_words(bigrams, listed).select(*PAIR_KEYS, "match_count")


def q_stopword_substring_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default mode against a table of stop words."""
    listed = spark.createDataFrame([(w,) for w in default_stop_words()], "word string")
    bigrams = two_word_ngrams(doc_ngrams(spark, sf_dir)).where(
        ~is_short("w1") & ~is_short("w2") & ~has_digit("ngram")
    )
    kept = without_listed_words(bigrams, listed, "substring")
    return kept.select(*PAIR_KEYS, "match_count")


def q_stopword_substring_own_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substring mode with an own list: the default entries and every word of the benchmark."""
    found = _table(spark, sf_dir, "benchmark").select(
        F.explode(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+")).alias("word")
    )
    listed = {r.word for r in found.where("word != ''").distinct().collect()}  # the query set's words
    words = sorted(listed | set(default_stop_words()))
    return pair_counts(doc_ngrams(spark, sf_dir), words)


def q_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_counts(doc_bigrams(spark, sf_dir))


def q_pair_counts_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_counts(part_ngrams(spark, sf_dir))


def q_first_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_word_counts(pair_counts(doc_bigrams(spark, sf_dir)))


def q_second_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return second_word_counts(pair_counts(doc_bigrams(spark, sf_dir)))


def q_decade_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decade_totals(pair_counts(doc_bigrams(spark, sf_dir)))


def q_decade_totals_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decade_totals(pair_counts(part_ngrams(spark, sf_dir)))


def q_multi_level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_level_counts(doc_bigrams(spark, sf_dir))


def q_multi_level_counts_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_words_nulls_first(multi_level_counts(part_ngrams(spark, sf_dir)))


def q_pairs_by_second_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_second_word(pair_counts(part_ngrams(spark, sf_dir)))


def q_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contingency(pair_counts(doc_bigrams(spark, sf_dir)))


def q_window_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marginals next to each pair, as window totals would give them."""
    table = contingency(pair_counts(part_ngrams(spark, sf_dir)))
    return table.select(*PAIR_KEYS, "c12", "c1", "c2")


def q_tagged_facts_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fact tables read as one bag and folded back into columns."""
    table = contingency(pair_counts(part_ngrams(spark, sf_dir)))
    facts = (as_facts(table, t, c) for t, c in (("Cw1w2", "c12"), ("Cw1", "c1"), ("Cw2", "c2")))
    return pivot_counts(union_facts(*facts))


def q_count_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_facts(contingency(pair_counts(doc_bigrams(spark, sf_dir))))


def q_ordered_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, counts, scores and sums of the documents as one listing in fact order."""
    # joined once: four facts are taken from it, and the listing's ranges need a pass of their own
    table = saved(contingency(pair_counts(doc_bigrams(spark, sf_dir)), sort=True), "contingency")
    facts = union_facts(
        as_facts(decade_totals(table), "N", "n"),
        count_facts(table),
        as_facts(_rounded(npmi_scores(table), "npmi"), "Npmi", "npmi"),
        as_facts(_rounded(npmi_sums(table), "sum_npmi"), "SumNpmis", "sum_npmi"),
    )
    return in_fact_order(facts.withColumn("value", F.col("value").cast("double")))


def q_npmi_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = npmi_scores(contingency(pair_counts(doc_bigrams(spark, sf_dir))))
    return _rounded(scores.select(*PAIR_KEYS, "npmi"), "npmi")


def q_npmi_scores_perfect(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = contingency(pair_counts(doc_bigrams(spark, sf_dir)))
    scores = npmi_scores(table, include_perfect=True)
    return _rounded(scores.select(*PAIR_KEYS, "npmi"), "npmi")


def q_npmi_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = contingency(pair_counts(doc_bigrams(spark, sf_dir)))
    return _rounded(npmi_sums(table), "sum_npmi")


def q_npmi_sums_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = contingency(pair_counts(doc_bigrams(spark, sf_dir)))
    return _rounded(npmi_sums(table, "all"), "sum_npmi")


def q_integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity_audit(contingency(pair_counts(english_only_bigrams(spark, sf_dir))))


def q_integrity_audit_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts folded back without the second-word facts of every pair with an even count."""
    facts = count_facts(contingency(pair_counts(part_ngrams(spark, sf_dir), stopword_mode="exact")))
    lost = (F.col("tag") == "Cw2") & (F.col("value") % 2 == 0)
    return integrity_audit(pivot_counts(facts.where(~lost)))


def q_integrity_audit_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """French texts counted as corrections: their pairs have negative counts."""
    documents = _documents(spark, sf_dir, "lang")
    bigrams = bigrams_of_text(documents, "text", 1950 + F.col("doc_id") % 60, "lang")
    signed = F.when(F.col("lang") == "fr", -F.col("match_count")).otherwise(F.col("match_count"))
    counted = pair_counts(bigrams.select("w1", "w2", "year", signed.alias("match_count")))
    return integrity_audit(contingency(counted)).where("reason like '%negative'")


def q_passing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = contingency(pair_counts(part_ngrams(spark, sf_dir), stopword_mode="exact"))
    kept = passing_scores(npmi_scores(table), npmi_sums(table), *PART_THRESHOLDS)
    return _rounded(kept, "npmi")


def _as_lines(ngrams: DataFrame) -> DataFrame:
    fields = (F.col(c).cast("string") for c in ("ngram", "year", "match_count", "volume_count"))
    return ngrams.select(F.concat_ws("\t", *fields).alias("value"))


def q_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    _as_lines(doc_ngrams(spark, sf_dir)).write.text(folder, compression="lz4")
    return pair_counts(read_ngrams(spark, folder, "text"))


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    _as_lines(doc_ngrams(spark, sf_dir)).write.text(folder, compression="lz4")
    return pair_counts(read_ngrams(spark, folder, "csv"))


def q_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of three to five fields and bad ones: accepted rows and rejects, both readers."""
    lines = doc_ngrams(spark, sf_dir).select(
        F.concat_ws(
            "\t", "ngram", F.when(F.col("match_count") == 7, F.lit("year")).otherwise(F.col("year").cast("string")),
            F.col("match_count").cast("string"),
            F.when(F.col("volume_count") > 1, F.col("volume_count").cast("string")),
            F.when(F.col("volume_count") > 2, F.lit("more")),
        ).alias("value")
    )
    folder = shared_folder(spark)
    lines.write.text(folder, compression="lz4")
    found = [
        read_ngrams(spark, folder, form, on_error="quarantine")
        .agg(F.count("*").alias("lines"), F.sum("match_count").alias("match_count"))
        .select(F.lit(form).alias("format"), F.lit(None).cast("string").alias("rejected"), "lines", "match_count")
        for form in ("csv", "text")
    ]
    rejected = rejected_ngram_lines(read_lines(spark, folder, "csv")).select(
        F.lit("csv").alias("format"), F.col("value").alias("rejected"),
        F.lit(1).cast("bigint").alias("lines"), F.lit(None).cast("bigint").alias("match_count"),
    )
    return found[0].unionByName(found[1]).unionByName(rejected)


def q_sequencefile_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write_sequence_file(_as_lines(doc_ngrams(spark, sf_dir)), folder)
    return pair_counts(read_ngrams(spark, folder, "sequencefile"))


def q_count_facts_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts and totals to tagged text and back."""
    folder = shared_folder(spark)
    pairs = saved(pair_counts(doc_bigrams(spark, sf_dir)), "pairs")  # counted once for both
    write_facts(as_facts(pairs, "Cw1w2", "c12"), f"{folder}/pairs")
    write_facts(as_facts(decade_totals(pairs), "N", "n"), f"{folder}/totals")
    return read_count_facts(spark, [f"{folder}/pairs", f"{folder}/totals"])


def q_result_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write_text(collocations(doc_bigrams(spark, sf_dir), *DOC_THRESHOLDS), folder)
    return _rounded(read_score_facts(spark, folder), "value")


def q_by_decade_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write_by_decade(collocations(doc_bigrams(spark, sf_dir), *DOC_THRESHOLDS), folder)
    found = spark.read.parquet(folder)
    return _rounded(found.withColumn("decade", F.col("decade").cast("bigint")), "npmi")


# ---------------------------------------------------------------------------- SQL oracle
_PART_NGRAMS = """
ngrams AS (
  SELECT p_name AS ngram, CAST(year(o_orderdate) AS BIGINT) AS year,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS match_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY ALL)"""

# Written with chr() so that no escape rule of either engine is involved.
_SEPARATORS = "'[' || chr(32) || chr(10) || chr(9) || chr(13) || ']+'"

_DOC_PAIRS = f"""
tokens AS (
  SELECT doc_id, lang, 1950 + doc_id % 60 AS year,
         list_filter(regexp_split_to_array(text, {_SEPARATORS}), lambda x: x <> '') AS w
  FROM documents),
positions AS (
  SELECT doc_id, lang, year, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM tokens),
adjacent AS (
  SELECT doc_id, lang, year, a, lead(a) OVER (PARTITION BY doc_id ORDER BY i) AS b
  FROM positions)"""

_DOC_NGRAMS = _DOC_PAIRS + """,
ngrams AS (
  SELECT year, a || ' ' || b AS ngram, CAST(count(*) AS BIGINT) AS match_count,
         CAST(count(DISTINCT doc_id) AS BIGINT) AS volume_count
  FROM adjacent WHERE b IS NOT NULL GROUP BY ALL)"""

_SIGNED_NGRAMS = _DOC_PAIRS + """,
ngrams AS (
  SELECT year, a || ' ' || b AS ngram,
         CAST(sum(CASE WHEN lang = 'fr' THEN -1 ELSE 1 END) AS BIGINT) AS match_count
  FROM adjacent WHERE b IS NOT NULL GROUP BY ALL)"""

_ENGLISH_NGRAMS = _DOC_PAIRS + """,
ngrams AS (
  SELECT year, a || ' ' || b AS ngram,
         CAST(count(*) FILTER (WHERE lang = 'en') AS BIGINT) AS match_count
  FROM adjacent WHERE b IS NOT NULL GROUP BY ALL)"""


# The list as the tests keep it, so that a wrong entry in the engine shows.
_STOP_WORDS = Path(__file__).with_name("tests") / "stop_words.txt"


def _stop_text() -> str:
    return _STOP_WORDS.read_text(encoding="utf-8").removesuffix("\n")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _accepted(mode: str = "substring", listed: str | None = None) -> str:
    """Word test as the definition has it: search the list text, or look up the entry.

    ``listed`` is SQL for a table of entries (column ``word``) that replaces the default list.
    """
    if mode == "substring":
        listed_test = "contains((SELECT t FROM stop_text), {w})"
        if listed is None:
            lists = f"stop_text AS (SELECT {_quoted(_stop_text())} AS t)"
        else:
            lists = f"stop_text AS (SELECT string_agg(word, chr(10) ORDER BY word) AS t FROM ({listed}))"
    else:
        listed_test = "{w} IN (SELECT word FROM stop_list)"
        lists = (
            "stop_list AS (SELECT DISTINCT unnest(string_split("
            f"{_quoted(_stop_text())}, chr(10))) AS word)"
        )
    listed = listed_test
    reject = "(length({w}) < 2 AND strlen({w}) < 4) OR " + listed
    reject += " OR regexp_matches({w}, '[0-9]')"
    return f""",
{lists},
split AS (
  SELECT year - year % 10 AS decade, string_split(rtrim(ngram, ' '), ' ') AS w, match_count
  FROM ngrams),
two AS (SELECT decade, w[1] AS w1, w[2] AS w2, match_count FROM split WHERE len(w) = 2),
accepted AS (
  SELECT * FROM two
  WHERE NOT ({reject.format(w="w1")}) AND NOT ({reject.format(w="w2")}))"""


_OWN_LIST = (
    "SELECT word FROM (SELECT unnest(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+')) AS word"
    " FROM benchmark UNION SELECT unnest(string_split(" + _quoted(_stop_text()) + ", chr(10)))) WHERE word <> ''"
)

_PAIRS = """,
pairs AS (
  SELECT decade, w1, w2, CAST(sum(match_count) AS BIGINT) AS c12
  FROM accepted GROUP BY ALL)"""

_CONTINGENCY = """,
contingency AS (
  SELECT decade, w1, w2, c12,
         CAST(sum(c12) OVER (PARTITION BY decade, w1) AS BIGINT) AS c1,
         CAST(sum(c12) OVER (PARTITION BY decade, w2) AS BIGINT) AS c2,
         CAST(sum(c12) OVER (PARTITION BY decade) AS BIGINT) AS n
  FROM pairs)"""

_SCORED = """,
measured AS (
  SELECT *, c12 = c1 AND c12 = c2 AS perfect,
         CAST(c12 AS HUGEINT) * n > CAST(c1 AS HUGEINT) * c2 AS positive,
         CASE WHEN c12 = c1 AND c12 = c2 THEN 1.0
              WHEN c12 < n THEN (ln(c12) + ln(n) - (ln(c1) + ln(c2))) / -ln(c12 / n)
         END AS npmi
  FROM contingency WHERE c12 > 0 AND c1 > 0 AND c2 > 0),
sums AS (
  SELECT *, coalesce(CAST(sum(CAST(npmi AS DECIMAL(18,12)))
                     FILTER (WHERE {scope}) OVER (PARTITION BY decade) AS DOUBLE), 0.0)
            AS sum_npmi
  FROM measured),
scores AS (SELECT * FROM sums WHERE {kept})"""

_POSITIVE = "positive AND NOT perfect"


def _scored(scope: str = _POSITIVE, kept: str = _POSITIVE) -> str:
    return _PAIRS + _CONTINGENCY + _SCORED.format(scope=scope, kept=kept)


def _kept(min_npmi: float, rel_min_npmi: float) -> str:
    return f"""
SELECT decade, w1, w2, round(npmi, 6) AS npmi FROM scores
WHERE npmi >= {min_npmi} OR npmi / sum_npmi >= {rel_min_npmi}"""


_FACTS = """
SELECT decade, w1, w2, 'Cw1w2' AS tag, c12 AS value FROM contingency
UNION ALL SELECT decade, w1, w2, 'Cw1', c1 FROM contingency
UNION ALL SELECT decade, w1, w2, 'Cw2', c2 FROM contingency"""

_ORDERED_FACTS = """
SELECT decade, NULL AS w1, NULL AS w2, 'N' AS tag, CAST(sum(c12) AS DOUBLE) AS value FROM pairs GROUP BY decade
UNION ALL SELECT decade, w1, w2, 'Cw1w2', CAST(c12 AS DOUBLE) FROM contingency
UNION ALL SELECT decade, w1, w2, 'Cw1', CAST(c1 AS DOUBLE) FROM contingency
UNION ALL SELECT decade, w1, w2, 'Cw2', CAST(c2 AS DOUBLE) FROM contingency
UNION ALL SELECT decade, w1, w2, 'Npmi', round(npmi, 6) FROM scores
UNION ALL SELECT * FROM (SELECT DISTINCT decade, NULL, NULL, 'SumNpmis', round(sum_npmi, 6) FROM sums)"""

_LEVELS = """
SELECT decade, w1, w2,
       CASE grouping(w1, w2) WHEN 0 THEN 'Cw1w2' WHEN 1 THEN 'Cw1'
                             WHEN 2 THEN 'Cw2' ELSE 'N' END AS tag,
       CAST(sum(match_count) AS BIGINT) AS value
FROM accepted
GROUP BY GROUPING SETS ((decade, w1, w2), (decade, w1), (decade, w2), (decade))"""

def _audit(table: str, test: str, reason: str) -> str:
    return " UNION ALL ".join(
        f"SELECT decade, w1, w2, '{c} is {reason}' AS reason FROM {table} WHERE {c} {test}"
        for c in ("c12", "c1", "c2")
    )


_AUDIT = _audit("contingency", "= 0", "zero") + " UNION ALL " + _audit("contingency", "< 0", "negative")

_LOSSY = """,
lossy AS (
  SELECT decade, w1, w2, c12, c1, CASE WHEN c2 % 2 = 0 THEN 0 ELSE c2 END AS c2 FROM contingency)
"""

_QUARANTINE = """,
lines AS (SELECT *, match_count = 7 AS bad FROM ngrams),
good AS (SELECT count(*) AS lines, CAST(sum(match_count) AS BIGINT) AS match_count FROM lines WHERE NOT bad)
SELECT format, CAST(NULL AS VARCHAR) AS rejected, lines, match_count
FROM good, (VALUES ('csv'), ('text')) f(format)
UNION ALL
SELECT 'csv', concat_ws(chr(9), ngram, 'year', match_count,
                        CASE WHEN volume_count > 1 THEN CAST(volume_count AS VARCHAR) END,
                        CASE WHEN volume_count > 2 THEN 'more' END), 1, NULL
FROM lines WHERE bad"""


def _sql(ngrams: str, *steps: str) -> str:
    return "WITH " + ngrams + "".join(steps)


# ----------------------------------------------------------------------------- contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: collocations of the documents table at sf0.001."""
    return q_collocations(spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, if that folder is there."""
    try:
        import corpus_pipeline
        from pairlore.llm import registry
    except ModuleNotFoundError as missing:
        # only the absence of the folder itself; a module it needs that is missing is an error
        if missing.name not in ("corpus_pipeline", "pairlore.llm", "pairlore.llm.registry"):
            raise
        return {}, {}
    queries, sql = registry.queries(), registry.oracle_sql()
    queries["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        name.removeprefix("q_"): function
        for name, function in globals().items()
        if name.startswith("q_")
    }
    return own | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    docs, parts = _DOC_NGRAMS, _PART_NGRAMS
    words, exact = _accepted(), _accepted("exact")
    accepted = "\nSELECT decade, w1, w2, match_count FROM accepted"
    pairs = "\nSELECT decade, w1, w2, c12 FROM pairs"
    totals = "\nSELECT decade, CAST(sum(c12) AS BIGINT) AS n FROM pairs GROUP BY decade"
    scores = "\nSELECT decade, w1, w2, round(npmi, 6) AS npmi FROM scores"
    doc_result = _sql(docs, words, _scored(), _kept(*DOC_THRESHOLDS))
    part_result = _sql(parts, words, _scored(), _kept(*PART_THRESHOLDS))
    doc_pairs = _sql(docs, words, _PAIRS, pairs)
    part_pairs = _sql(parts, words, _PAIRS, pairs)
    perfect = f"({_POSITIVE}) OR perfect"
    sums = "\nSELECT DISTINCT decade, round(sum_npmi, 6) AS sum_npmi FROM sums"
    return _training_data()[1] | {
        "collocations": doc_result,
        "collocations_staged": doc_result,
        "collocations_lazy": doc_result,
        "collocations_doc_abs": _sql(docs, words, _scored(), _kept(DOC_THRESHOLDS[0], NEVER)),
        "collocations_doc_rel": _sql(docs, words, _scored(), _kept(NEVER, DOC_THRESHOLDS[1])),
        "by_decade_round_trip": doc_result,
        "result_text_round_trip": _sql(
            docs, words, _scored(),
            "\nSELECT decade, w1, w2, 'Npmi' AS tag, npmi AS value FROM (",
            _kept(*DOC_THRESHOLDS), ")",
        ),
        "collocations_parts": part_result,
        "collocations_shuffle_join": part_result,
        "collocations_abs": _sql(parts, words, _scored(), _kept(PART_THRESHOLDS[0], NEVER)),
        "collocations_rel": _sql(parts, words, _scored(), _kept(NEVER, PART_THRESHOLDS[1])),
        "collocations_exact_words": _sql(docs, exact, _scored(), _kept(*DOC_THRESHOLDS)),
        "collocations_sum_all": _sql(
            docs, words, _scored(scope="true"), _kept(NEVER, DOC_THRESHOLDS[1])
        ),
        "collocations_with_perfect": _sql(
            docs, words, _scored(kept=perfect), _kept(*DOC_THRESHOLDS)
        ),
        "passing_scores": _sql(parts, exact, _scored(), _kept(*PART_THRESHOLDS)),
        "doc_ngrams": _sql(
            docs, "\nSELECT year, ngram, match_count, volume_count FROM ngrams"
        ),
        "accepted_bigrams": _sql(parts, words, accepted),
        "accepted_bigrams_docs": _sql(docs, words, accepted),
        "stopword_exact": _sql(docs, exact, accepted),
        "stopword_exact_antijoin": _sql(parts, exact, accepted),
        "pair_counts": doc_pairs,
        "text_round_trip": doc_pairs,
        "csv_round_trip": doc_pairs,
        "sequencefile_round_trip": doc_pairs,
        "csv_quarantine": _sql(docs, _QUARANTINE),
        "stopword_substring_table": _sql(docs, words, accepted),
        "stopword_substring_own_list": _sql(docs, _accepted(listed=_OWN_LIST), _PAIRS, pairs),
        "integrity_audit_missing": _sql(
            parts, exact, _PAIRS, _CONTINGENCY, _LOSSY, _audit("lossy", "= 0", "zero")
        ),
        "integrity_audit_negative": _sql(
            _SIGNED_NGRAMS, words, _PAIRS, _CONTINGENCY, "\n" + _audit("contingency", "< 0", "negative")
        ),
        "pair_counts_parts": part_pairs,
        "pairs_by_second_word": part_pairs,
        "first_word_counts": _sql(
            docs, words, _PAIRS,
            "\nSELECT decade, w1, CAST(sum(c12) AS BIGINT) AS c1 FROM pairs GROUP BY ALL",
        ),
        "second_word_counts": _sql(
            docs, words, _PAIRS,
            "\nSELECT decade, w2, CAST(sum(c12) AS BIGINT) AS c2 FROM pairs GROUP BY ALL",
        ),
        "decade_totals": _sql(docs, words, _PAIRS, totals),
        "decade_totals_parts": _sql(parts, words, _PAIRS, totals),
        "multi_level_counts": _sql(docs, words, _LEVELS),
        "multi_level_counts_parts": _sql(parts, words, _LEVELS),
        "contingency": _sql(
            docs, words, _PAIRS, _CONTINGENCY,
            "\nSELECT decade, w1, w2, c12, c1, c2, n FROM contingency",
        ),
        "window_marginals": _sql(
            parts, words, _PAIRS, _CONTINGENCY,
            "\nSELECT decade, w1, w2, c12, c1, c2 FROM contingency",
        ),
        "tagged_facts_pivot": _sql(
            parts, words, _PAIRS, _CONTINGENCY,
            "\nSELECT decade, w1, w2, c12, c1, c2 FROM contingency",
        ),
        "count_facts": _sql(docs, words, _PAIRS, _CONTINGENCY, _FACTS),
        "ordered_facts": _sql(docs, words, _scored(), _ORDERED_FACTS),
        "count_facts_round_trip": _sql(
            docs, words, _PAIRS,
            "\nSELECT decade, w1, w2, 'Cw1w2' AS tag, c12 AS value FROM pairs"
            "\nUNION ALL SELECT decade, NULL, NULL, 'N', CAST(sum(c12) AS BIGINT)"
            " FROM pairs GROUP BY decade",
        ),
        "npmi_scores": _sql(docs, words, _scored(), scores),
        "npmi_scores_perfect": _sql(docs, words, _scored(kept=perfect), scores),
        "npmi_sums": _sql(docs, words, _scored(), sums),
        "npmi_sums_all": _sql(docs, words, _scored(scope="true"), sums),
        "integrity_audit": _sql(
            _ENGLISH_NGRAMS, words, _PAIRS, _CONTINGENCY, "\n" + _AUDIT
        ),
    }
