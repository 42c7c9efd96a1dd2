"""URL filter: a short rule list, and boosted trees where no rule fits.

The trees see lexical features of the URL (length, depth, digit ratio, entropy, parameter
counts and the like) and statistics of its suffixes, how often URLs with this suffix were
blocked among all labelled ones. They are trained from labelled URLs.

Nulls: a null URL, like one without ``://``, has an empty host and path; the trees judge it
like any other. Without labelled URLs everything that no rule fits is allowed. An empty table
gives an empty result; repeated rows give repeated rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.llm.boosting import Trees, fit
from pairlore.llm.common import ascii_lower, table
from pairlore.sources.scratch import saved

BLOCK, ALLOW = "block", "allow"
RULES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW))
SAMPLE = 20_000  # distinct labelled URLs that the trees are fitted on
SMOOTHING = 4.0
THRESHOLD = 0.5

_HOST = re.compile(r"^.*?://([^/?#]*)([^?#]*)(.*)$", re.S)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.

    A rule is host/path: it fits the host and its subdomains if the path starts with its own.
    The list is a short configuration; it becomes one CASE expression.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def suffixes(host: Column) -> tuple[Column, Column]:
    """The last label of the host and the last two."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def lexical(url: str | None) -> list[float]:
    """Features of one URL; all are defined for the empty one."""
    url = url or ""
    found = _HOST.match(url)
    host, path, rest = found.groups() if found else ("", "", "")
    query = rest.partition("#")[0]
    letters = sum(c.isalpha() for c in url)
    digits = sum("0" <= c <= "9" for c in url)
    parts = [p for p in path.split("/") if p]
    return [
        len(url), len(host), len(path), len(query), host.count("."), len(parts),
        digits / max(1, len(url)), letters / max(1, len(url)), _entropy(url), _entropy(host),
        float(query.count("=")), float(query.count("&")), float("#" in rest), float(host.count("-")),
        max(map(len, parts), default=0), sum("0" <= c <= "9" for c in host), float(url.startswith("https:")),
        len(parts[0]) if parts else 0, float(path.endswith("/")), float("%" in url),
    ]


class UrlModel(NamedTuple):
    trees: Trees
    counted: DataFrame  # labels, suffix, n, blocked: labelled URLs by each suffix of one or two labels
    prior: float  # share of blocked URLs among all labelled ones


def features(urls: pd.Series, last: pd.Series, last_two: pd.Series) -> np.ndarray:
    """Lexical features and the blocked rates of both suffixes."""
    own = np.array([lexical(u) for u in urls], dtype=np.float64).reshape(len(urls), -1)
    return np.column_stack([own, last.to_numpy(np.float64), last_two.to_numpy(np.float64)])


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(labels, suffix, n, blocked) of ``labelled`` (url, blocked): a row per suffix, of one label and of two apart."""
    last, last_two = suffixes(host_of(F.col("url")))
    both = F.array(
        F.struct(F.lit(1).alias("labels"), last.alias("suffix")), F.struct(F.lit(2).alias("labels"), last_two.alias("suffix"))
    )
    return (
        labelled.select(F.inline(both), "blocked")
        .groupBy("labels", "suffix")
        .agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked"))
    )


def with_rates(urls: DataFrame, counted: DataFrame, prior: float, own: tuple[str, str] | None = None) -> DataFrame:
    """``urls`` (with host) and the smoothed rates of blocked URLs with their suffixes, last_rate and last_two_rate.

    A suffix without labelled URLs has the rate of all. The counts are joined to the distinct
    suffixes first; these get an exchange of their own, so that a hot suffix's URLs are split.
    ``own`` names columns of ``urls`` with each URL's own labelled rows and blocked ones: for
    training, these are taken out of its suffixes' counts (leave one out), so that a suffix
    held by one URL does not hand the trees that URL's label.
    """

    def counts(labels: int, name: str) -> DataFrame:
        return counted.where(F.col("labels") == labels).select(
            F.col("suffix").alias(name), F.col("n").alias(f"{name}_n"), F.col("blocked").alias(f"{name}_b")
        )

    last, last_two = suffixes(F.col("host"))
    known = (
        urls.select(last_two.alias("last_two")).distinct()
        .join(counts(2, "last_two"), "last_two", "left")
        .withColumn("last", F.substring_index("last_two", ".", -1))
        .join(counts(1, "last"), "last", "left")
        .select("last_two", "last_n", "last_b", "last_two_n", "last_two_b")
        .repartition(F.xxhash64("last_two"))
    )

    def rate(name: str) -> Column:
        n = F.coalesce(F.col(f"{name}_n"), F.lit(0)).cast("double")
        blocked = F.coalesce(F.col(f"{name}_b"), F.lit(0)).cast("double")
        if own is not None:
            n, blocked = n - F.col(own[0]), blocked - F.col(own[1])
        return (blocked + SMOOTHING * prior) / (n + SMOOTHING)

    joined = urls.withColumn("_last_two", last_two).join(
        known.withColumnRenamed("last_two", "_last_two"), "_last_two", "left"
    )
    return joined.select(*urls.columns, rate("last").alias("last_rate"), rate("last_two").alias("last_two_rate"))


def train(labelled: DataFrame, limit: int = SAMPLE) -> UrlModel:
    """A model from ``labelled`` (url, blocked 0/1).

    Suffix statistics count every labelled URL, in a table with a row per suffix; the trees are
    fitted on ``limit`` distinct ones, chosen by a hash of the URL, with their counts as weights,
    each seeing its suffixes' rates without its own labels.
    """
    rows = labelled.select("url", "blocked")
    counted = saved(suffix_counts(rows), "url_suffixes")
    total = counted.where("labels = 1").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).first()
    prior = total.blocked / total.n if total.n else 0.0
    distinct = rows.groupBy("url").agg(F.count("*").alias("n"), F.avg("blocked").alias("blocked"))
    chosen = (
        distinct.orderBy(F.xxhash64("url"), "url").limit(limit)
        .withColumn("host", host_of(F.col("url")))
        .withColumn("own_blocked", F.col("blocked") * F.col("n"))
    )
    columns = ["url", "n", "blocked", "last_rate", "last_two_rate"]
    rated = with_rates(chosen, counted, prior, own=("n", "own_blocked"))
    sample = pd.DataFrame(
        [tuple(r) for r in rated.select(*columns).collect()], columns=columns
    ).sort_values("url", ignore_index=True)
    if sample.empty:
        return UrlModel(fit(np.zeros((0, 1)), np.zeros(0))._replace(base=-35.0), counted, prior)
    x = features(sample["url"], sample["last_rate"], sample["last_two_rate"])
    y, n = sample["blocked"].to_numpy(np.float64), sample["n"].to_numpy(np.float64)
    return UrlModel(fit(x, y, weights=n), counted, prior)


def judge(
    pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, labelled: DataFrame | None = None
) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule, verdict and the model's score.

    Without ``labelled`` (url, blocked) the URLs that a rule decides are the labelled ones.
    """
    urls = pages.select("page_id", "url")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    fitted = matching_rule(host, path, rules)
    if labelled is None:
        labelled = urls.select("url", fitted.alias("r")).where("r is not null").select(
            "url", (F.col("r.verdict") == BLOCK).cast("int").alias("blocked")
        )
    model = train(labelled)
    trees = model.trees

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for url, last, last_two in batches:
            yield pd.Series(trees.probability(features(url, last, last_two)))

    rated = with_rates(urls.withColumn("host", host), model.counted, model.prior)
    scored = rated.select(
        "page_id", "host", path.alias("path"), fitted.alias("r"), score("url", "last_rate", "last_two_rate").alias("score")
    )
    by_model = F.when(F.col("score") >= THRESHOLD, BLOCK).otherwise(ALLOW)
    return scored.select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), by_model).alias("verdict"), "score",
    )


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for the URL of every page."""
    return judge(table(spark, sf_dir, "pages"))
