"""Benchmark decontamination by winnowing.

Words are hashed in k-grams; of every window of consecutive k-gram hashes the smallest is kept
as a fingerprint. With k = 5 and windows of 9 hashes, every shared span of 13 words has a
shared fingerprint, so joining the fingerprints of documents and benchmark items loses none.
Each hit is then extended word by word along its diagonal, and only exact windows count. An
item shorter than a window is one window: it is looked up by the hash of all its words.

Nulls: a null text has no words and a null id is an id of its own (a null item id is not
listed among the items). Items without words match nothing. Empty tables give an empty result
or clean documents. Repeated documents give repeated rows, repeated items count once. Other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.llm.common import ascii_lower, let, table
from pairlore.sources.scratch import Scratch, saved

WINDOW = 13
GRAM = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing, so A-Z are words


def words_of(text: Column) -> Column:
    pieces = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(pieces, "")


def n_words_of(text: Column) -> Column:
    pieces = F.split(F.coalesce(text, F.lit("")), SEPARATORS)
    return F.size(F.array_remove(pieces, "")).cast("long")


def gram_hashes(words: Column, k: int) -> Column:
    """Hashes of all k-grams in order; null where there are fewer than k words."""
    return let(words, lambda w: F.when(
        F.size(w) >= k,
        F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.xxhash64(F.slice(w, i, k))),
    ))


def fingerprints(hashes: Column, width: int) -> Column:
    """The smallest hash of every window of ``width`` hashes, each value once."""
    return let(hashes, lambda h: F.when(
        F.size(h) >= width,
        F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(h) - width + 1), lambda i: F.array_min(F.slice(h, i, width))
        )),
    ))


def _item_table(benchmark: DataFrame) -> DataFrame:
    """Distinct items: item_id, words, n, and a key that also tells null ids apart."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("item_words"))
    items = items.withColumn("n_item", F.size("item_words")).where("n_item > 0").distinct()
    return items.withColumn("item_key", F.xxhash64("item_id", "item_words"))


def _item_grams(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(hash, item_key, item_at) of the k-grams that can be an item's fingerprint."""
    hashes = gram_hashes(F.col("item_words"), gram)
    long = (
        items.where(F.col("n_item") >= window)
        .withColumn("hashes", hashes)
        .withColumn("kept", fingerprints(F.col("hashes"), window - gram + 1))
        .select("item_key", "kept", F.posexplode("hashes").alias("item_at", "hash"))
        .where(F.array_contains("kept", F.col("hash")))
        .select("hash", "item_key", "item_at")
    )
    short = items.where(F.col("n_item") < window).select(
        F.xxhash64(F.col("item_words")).alias("hash"), "item_key", F.lit(0).alias("item_at")
    )
    return long.unionByName(short)


def document_hits(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, digest, at, item_id): word positions inside an occurrence of an item's window.

    ``documents`` has doc_id and text, ``digest`` is a hash of the text.
    """
    items = saved(_item_table(benchmark), "items")
    grams = saved(_item_grams(items, window, gram), "grams")
    # At most window - 1 values, whatever the size of the benchmark.
    short = [r.n_item for r in items.where(F.col("n_item") < window).select("n_item").distinct().collect()]

    documents = documents.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    words = documents.select("doc_id", "digest", words_of(F.col("text")).alias("words"))
    empty = F.array().cast("array<bigint>")
    or_none = lambda c: F.coalesce(c, empty)
    keys = let(F.col("words"), lambda w: F.concat(
        or_none(fingerprints(gram_hashes(w, gram), window - gram + 1)),
        *(or_none(gram_hashes(w, n)) for n in sorted(short)),
    ))
    listed = saved(grams.select("hash").distinct(), "hashes")
    candidates = saved(
        words.select("doc_id", "digest", F.explode(keys).alias("hash"))
        .join(listed, "hash", "left_semi")
        .select("doc_id", "digest")
        .distinct(),
        "candidates",
    )
    both = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.digest").eqNullSafe(F.col("c.digest"))
    found = saved(
        documents.alias("d")
        .join(candidates.alias("c").hint("shuffle_hash"), both, "left_semi")
        .select("d.doc_id", "d.digest", words_of(F.col("text")).alias("words")),
        "found",
    )
    placed = lambda h, i: F.struct(h.alias("hash"), i.alias("at"))
    all_grams = F.concat(
        *(F.transform(or_none(gram_hashes(F.col("words"), n)), placed) for n in (gram, *sorted(set(short) - {gram})))
    )
    diagonals = (
        found.select("doc_id", "digest", F.explode(all_grams).alias("g"))
        .select("doc_id", "digest", "g.hash", "g.at")
        .join(grams, "hash")
        .select("doc_id", "digest", F.struct("item_key", (F.col("at") - F.col("item_at")).alias("shift")).alias("line"))
        .groupBy("doc_id", "digest")
        .agg(F.collect_set("line").alias("lines"))  # bounded by the hits in one text
    )
    both = F.col("f.doc_id").eqNullSafe(F.col("l.doc_id")) & F.col("f.digest").eqNullSafe(F.col("l.digest"))
    lined = (
        found.distinct().alias("f")
        .join(diagonals.alias("l"), both)
        .select("f.doc_id", "f.digest", "words", F.explode("lines").alias("line"))
        .join(items, F.col("line.item_key") == F.col("item_key"))
    )
    shift = F.col("line.shift")
    first = F.greatest(F.lit(0), -shift)
    length = F.least(F.col("n_item"), F.size("words") - shift) - first
    return _hit_positions(
        lined.select(
            "doc_id", "digest", "item_id",
            F.least("n_item", F.lit(window)).alias("need"),
            (first + shift).alias("from"),
            F.zip_with(
                F.slice("words", first + shift + 1, length),
                F.slice("item_words", first + 1, length),
                lambda a, b: F.when(a == b, "1").otherwise("0"),
            ).alias("same"),
        ),
        window,
    )


def _hit_positions(lined: DataFrame, window: int) -> DataFrame:
    """Positions inside runs of equal words that are as long as a window.

    In a text of one character per word, a run's possible window starts become 2 and what
    lies within a window behind a 2 becomes 3.
    """
    flags = F.array_join("same", "")
    starts = F.regexp_replace(flags, f"1(?=1{{{window - 1}}})", "2")
    inside = F.regexp_replace(starts, f"[12](?<=2.{{0,{window - 1}}})", "3")
    short = F.when(~flags.contains("0") & (F.length(flags) == F.col("need")), F.regexp_replace(flags, "1", "3"))
    marks = F.when(F.col("need") == window, inside).otherwise(short)
    return (
        lined.select("doc_id", "digest", "item_id", "from", F.split(marks, "").alias("marks"))
        .select("doc_id", "digest", "item_id", "from", F.posexplode("marks").alias("i", "mark"))
        .where(F.col("mark") == "3")
        .select("doc_id", "digest", "item_id", (F.col("from") + F.col("i")).alias("at"))
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """For each of ``documents`` (doc_id, text): words, hit words and items with windows in it."""
    documents = documents.select("doc_id", "text")
    with Scratch(documents.sparkSession) as scope:
        hits = document_hits(documents, benchmark, window, gram)
        places = hits.select("doc_id", "digest", "at").distinct().groupBy("doc_id", "digest").agg(F.count("*").alias("n_hit"))
        listed = (
            hits.select("doc_id", "digest", F.col("item_id").cast("string").alias("item"))
            .distinct()
            .groupBy("doc_id", "digest")
            .agg(F.array_sort(F.collect_list("item")).alias("items"))  # one document's items
        )
        hit = places.alias("p").join(
            listed.alias("i"),
            F.col("p.doc_id").eqNullSafe(F.col("i.doc_id")) & F.col("p.digest").eqNullSafe(F.col("i.digest")),
        ).select(F.col("p.doc_id").alias("hit_id"), F.col("p.digest").alias("hit_digest"), "n_hit", "items")
        hit = scope.result(hit, "hits")
    counted = documents.select("doc_id", F.xxhash64("text").alias("digest"), n_words_of(F.col("text")).alias("n_words"))
    joined = counted.join(
        hit,
        F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("digest").eqNullSafe(F.col("hit_digest")),
        "left",
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "digest", "n_words", n_hit.alias("n_hit"), items.alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without(documents: DataFrame, marked: DataFrame) -> DataFrame:
    """``documents`` less those in ``marked`` (doc_id, digest)."""
    listed = saved(marked.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct(), "marked")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.xxhash64("text").eqNullSafe(F.col("_digest"))
    return documents.join(listed.hint("shuffle_hash"), same, "left_anti")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
