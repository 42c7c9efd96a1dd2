"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger keeps which
(blob, rule, rule version) were scanned and what was found; a run scans only the pairs that it
lacks, once per blob however many paths share it, appends to the ledger and joins the findings
back to all paths. Only native column expressions touch the texts.

Nulls: a null text counts as empty and has no findings; a null path is a path like another.
An empty table gives an empty result. Repeated rows give repeated rows. Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pairlore.llm.common import table
from pairlore.sources.scratch import saved, shared_folder


class Rule(NamedTuple):
    """A pattern; a match counts if its ``group`` has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


KEYWORDS = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"

# Runs are maximal, so a least length inside the pattern keeps the same hex and access spans.
BASE_RULES = (
    Rule("assign", 1, f"({KEYWORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, "[0-9a-f]{16,}"),
)
# What the method adds: credentials whose form alone gives them away.
MORE_RULES = (
    Rule("private_key", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("vendor_token", 1, "(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
    Rule("web_token", 1, "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
    Rule("url_password", 1, "[a-z]{2,10}://[^\\s:/@]{1,64}:[^\\s:/@]{1,64}@"),
)
RULES = BASE_RULES + MORE_RULES
SALTS = 16

SCANNED = "blob string, kind string, version int"
FINDINGS = "blob string, kind string, version int, start long, end long"


def _address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _lengths(rule: Rule, text: Column, wanted: Column) -> Column:
    """Struct of the rule and, for each of its matches, the lengths that place it.

    Splitting on the pattern and extracting it walk the same matches: the text is piece,
    match, piece, match, ..., piece.
    """
    length = lambda x: F.length(x).cast("long")
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), length).alias("match"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), length).alias("kept"),
    )
    has = F.array_contains(wanted, rule.kind) & text.rlike(rule.pattern)
    return F.when(
        has,
        F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            F.lit(rule.least).alias("least"),
            found.alias("found"),
        ),
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings in ``blobs`` (blob, text, wanted: array of kinds); ends are exclusive."""
    text = F.coalesce(F.col("text"), F.lit(""))
    each = F.array_compact(F.array(*(_lengths(r, text, F.col("wanted")) for r in rules)))
    matches = (
        blobs.select("blob", F.explode(each).alias("r"))
        .select("blob", "r.kind", "r.version", "r.least", F.posexplode("r.found").alias("i", "m"))
        .where(F.col("m.match").isNotNull())
        .select("blob", "kind", "version", "least", "i", "m.gap", "m.match", "m.kept")
        .distinct()  # a path and text that occur twice are one blob
    )
    order = Window.partitionBy("blob", "kind").orderBy("i")
    matches = matches.withColumn(
        "end", F.sum(F.col("gap") + F.col("match")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return matches.where(F.col("kept") >= F.col("least")).select(
        "blob", "kind", "version", (F.col("end") - F.col("match")).alias("start"), "end"
    )


def _read(spark: SparkSession, folder: str, schema: str, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of the rules in force; before the first run there are none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    if not there:
        return spark.createDataFrame([], schema)
    in_force = [F.struct(F.lit(r.kind), F.lit(r.version)) for r in rules]
    return spark.read.schema(schema).parquet(folder).where(F.struct("kind", "version").isin(*in_force))


def scan_versions(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings for every row of ``versions`` (path, text): path, blob, spans.

    ``ledger`` is a folder on shared storage; it is extended by what this run scans. Findings
    are written before the pairs are marked as scanned: a run that dies in between is repeated
    by the next one and its doubled findings count once. ``spans`` is an array of
    (kind, start, end) by start, then by the order of the rules.
    """
    spark = versions.sparkSession
    versions = versions.select("path", "text")
    paths = saved(
        versions.select("path", _address(F.col("text")).alias("blob")), "paths"
    )
    key = F.coalesce(F.col("path").cast("string"), F.lit(""))
    pairs = (
        paths.groupBy("blob")
        .agg(F.min(key).alias("first_path"))
        .withColumn("rule", F.explode(F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))))
        .select("blob", "first_path", "rule.kind", "rule.version")
    )
    scanned = _read(spark, f"{ledger}/scanned", SCANNED, rules)
    unseen = saved(
        pairs.join(scanned, ["blob", "kind", "version"], "left_anti")
        .groupBy("blob", "first_path")
        .agg(F.collect_set("kind").alias("wanted")),
        "unseen",
    )
    # Each unseen blob's text is read at one of its paths, so copies do not meet in one task.
    texts = (
        versions.withColumn("blob", _address(F.col("text")))
        .withColumn("first_path", key)
        .join(unseen.hint("shuffle_hash"), ["blob", "first_path"])
        .select("blob", "text", "wanted")
    )
    scan_blobs(texts, rules).write.mode("append").parquet(f"{ledger}/findings")
    versions_of = F.create_map(*(F.lit(x) for r in rules for x in (r.kind, r.version)))
    unseen.select("blob", F.explode("wanted").alias("kind")).select(
        "blob", "kind", versions_of[F.col("kind")].cast("int").alias("version")
    ).write.mode("append").parquet(f"{ledger}/scanned")

    kinds = F.array(*(F.lit(r.kind) for r in rules))
    rank = F.array_position(kinds, F.col("kind"))
    spans = (
        _read(spark, f"{ledger}/findings", FINDINGS, rules)
        .distinct()
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("found"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    # One blob may have a third of all paths: they are salted over as many tasks.
    salted = paths.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    in_order = F.transform("found", lambda x: F.struct(x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end")))
    return salted.join(spans, ["blob", "salt"], "left").select(
        "path", "blob", F.coalesce(in_order, empty).alias("spans")
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)))


def digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """doc_id, n_<kind> for the base kinds, base_sha256 and spans from (path, spans)."""
    of_base = F.filter("spans", lambda x: x.kind.isin(*base))

    def number_of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("path").alias("doc_id"), *map(number_of, base),
        F.sha2(spans_text(of_base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, scanned with a ledger that starts empty."""
    documents = table(spark, sf_dir, "documents")
    versions = documents.select(F.col("doc_id").alias("path"), "text")
    found = scan_versions(versions, shared_folder(spark, "ledger"))
    return digest(found, tuple(r.kind for r in BASE_RULES))
