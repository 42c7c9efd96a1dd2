"""Jaccard self-join of documents on word n-grams, with the groups that the links form.

Equal shingle sets are one class. A class sends only its prefix, its rarest shingles, to the
join: two sets that are similar enough share one of them. Rarity comes from a counting sketch
of all documents; any one order of shingles loses no link, a good one keeps common passages
out of the prefixes. Candidates are filtered by length, by the positions of their first shared
shingle and by what they can share in each range of hashes (the suffix filter); what is left
is verified on the whole sets, once per pair.

Groups of near copies are linked without comparing all their pairs: in every bucket of a
prefix shingle each class is first compared with the one that has the fewest rarer shingles.
Afterwards only pairs whose classes are still apart are compared, all of them.

Nulls: a null or empty text, or one without words, has no shingles and no links; its component
is its own id. A null id is an id like another, but never a component's smallest. An empty
table gives an empty result. Repeated rows give repeated rows. Other columns are ignored
(``near_groups``) or kept (``one_of_each``).

Each step deletes its scratch tables when its own result is written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairlore.llm.common import distinct, table
from pairlore.llm.components import components
from pairlore.sources.scratch import Scratch, saved

WORDS = 4
PERCENT = 85
COUNTERS = 1 << 21  # of the rarity sketch; 16 MB wherever it goes, whatever the corpus
CHUNK = 1 << 14
FAN_IN = 256  # partial sketches that one task adds up
RANGES = 64  # of hashes, for the suffix filter
BITS = 1 << 25  # of the filter for documents whose sets are needed; 4 MB

_FIRST = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xBF58476D1CE4E5B9)
PROFILE = "doc_id long, digest long, n int, key long, sig binary, ranges binary, part int, chunk int, counts binary"


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text, A-Z lower-cased.

    ``bytes.split`` parts words at the blanks \\x20 and \\x09-\\x0D. With fewer words than
    ``words`` the whole sequence is the only shingle.
    """
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
    size = min(words, len(tokens))
    h = np.full(len(tokens) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        h = h * _FIRST + each[k : k + len(h)]
    h = (h ^ (h >> np.uint64(31))) * _SECOND
    return distinct(h ^ (h >> np.uint64(29)))


def signature(grams: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(grams.tobytes())


def range_counts(grams: np.ndarray) -> bytes | None:
    """How many shingles lie in each range of hashes; None where a count needs over a byte."""
    counts = np.bincount((grams >> np.uint64(58)).astype(np.int64), minlength=RANGES)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def _key(sig: bytes) -> int:
    """The part of a signature that the candidate join carries."""
    return int.from_bytes(sig[:8], "little", signed=True)


def _digest(text: Column) -> Column:
    return F.xxhash64(text)


def _packed(counts: np.ndarray) -> bytes:
    """Counters of the sketch as they are written: most are small, many of a small part are 0."""
    return zlib.compress(counts.tobytes(), 1)


def _profiles(documents: DataFrame, words: int) -> DataFrame:
    """A row per document, and each task's part of the rarity sketch, in one pass."""

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(COUNTERS, dtype=np.int32)  # of one task
        for batch in batches:
            rows = []
            for doc_id, text, digest in zip(batch["doc_id"], batch["text"], batch["digest"], strict=True):
                grams = shingles(text, words)
                np.add.at(counts, (grams & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
                if len(grams):
                    sig = signature(grams)
                    rows.append((doc_id, digest, len(grams), _key(sig), sig, range_counts(grams), None, None, None))
                else:
                    rows.append((doc_id, digest, 0, *[None] * 6))
            yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)
        part = TaskContext.get().partitionId()
        partial = [
            (None, None, None, None, None, None, part, c, _packed(counts[c * CHUNK : (c + 1) * CHUNK]))
            for c in range(COUNTERS // CHUNK)
        ]
        yield pd.DataFrame(partial, columns=COLUMNS, dtype=object)

    return saved(documents.select("doc_id", "text", "digest").mapInPandas(profile, PROFILE), "profiles")


COLUMNS = [c.split()[0] for c in PROFILE.split(", ")]


def _rarity(profiles: DataFrame) -> np.ndarray:
    """Counters of the whole sketch, added up in groups of at most FAN_IN partial ones."""
    level = profiles.where("chunk is not null").select("part", "chunk", "counts")

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, dtype=np.int64)
        for packed in group["counts"]:
            counts = zlib.decompress(packed)
            total += np.frombuffer(counts, dtype=np.int32 if len(counts) == 4 * CHUNK else np.int64)
        return pd.DataFrame([(group["part"].iloc[0], group["chunk"].iloc[0], _packed(total))], columns=["part", "chunk", "counts"])

    top = level.agg(F.max("part")).first()[0] or 0
    out = np.zeros(COUNTERS, dtype=np.int64)
    with Scratch(profiles.sparkSession):
        while True:
            level = saved(
                level.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
                .groupBy("part", "chunk").applyInPandas(add, "part int, chunk int, counts binary"),
                "rarity",
            )
            top //= FAN_IN
            if not top:
                break
        for row in level.collect():  # COUNTERS numbers
            counts = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int64)
            out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = counts
    return out


def _prefixes(documents: DataFrame, rarity, words: int, percent: int) -> DataFrame:
    """(shingle, key, n, pos): each set's rarest shingles with their place in the order.

    Copies of a text may give their rows several times.
    """
    schema = pa.schema([("shingle", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = rarity.value
        for batch in batches:
            rows: list[list[np.ndarray]] = [[], [], [], []]
            for text in dict.fromkeys(batch.column("text").to_pylist()):  # copies have the same rows
                grams = shingles(text, words)
                n = len(grams)
                if n:
                    order = np.argsort(counters[(grams & np.uint64(COUNTERS - 1)).astype(np.int64)], kind="stable")
                    size = n - (percent * n + 99) // 100 + 1
                    rows[0].append(grams[order[:size]].view(np.int64))
                    rows[1].append(np.full(size, _key(signature(grams))))
                    rows[2].append(np.full(size, n, dtype=np.int32))
                    rows[3].append(np.arange(size, dtype=np.int32))
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(r)) for r in rows], schema=schema)

    return documents.select("text").mapInArrow(prefix, "shingle long, key long, n int, pos int")


def _shared_prefixes(documents: DataFrame, rarity, words: int, percent: int) -> DataFrame:
    """Prefix rows whose shingle stands in the prefixes of two sets or more, each once.

    All prefix rows are moved once, to their shingles; copies and lone shingles go there.
    """
    rows = _prefixes(documents, rarity, words, percent).repartition("shingle").distinct()
    bucket = Window.partitionBy("shingle")
    shared = rows.withColumn("shared", F.min("key").over(bucket) != F.max("key").over(bucket)).where("shared")
    return saved(shared.drop("shared"), "prefixes")


def _bits(keys: DataFrame) -> np.ndarray:
    """A fixed number of bits in which every row's ``place`` (a hash) is set.

    It keeps most documents out of the join below, whose result does not depend on it.
    """
    word = F.pmod("place", F.lit(BITS // 64))
    bit = F.expr("shiftleft(1L, cast(pmod(shiftright(place, 32), 64) as int))")
    out = np.zeros(BITS // 64, dtype=np.int64)
    for row in keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toLocalIterator():
        out[row["word"]] = row["bits"]  # at most BITS / 64 rows
    return out


def _sets(documents: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(sig, grams) of the sets in ``wanted`` (sig), each read at one of its documents.

    Not written: they end behind an exchange on ``sig``, which both sides of a join of pairs share.
    """
    wanted = saved(wanted.distinct(), "wanted")
    place = F.xxhash64("doc_id", "digest")
    at = classes.join(wanted, "sig", "left_semi").select("at.doc_id", "at.digest").select(place.alias("place"))
    bits = documents.sparkSession.sparkContext.broadcast(_bits(at))
    schema = pa.schema([("sig", pa.binary()), ("grams", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_numpy()
            hit = bits.value[places % (BITS // 64)] >> ((places >> 32) % 64) & 1
            grams = [shingles(text, words) for text in batch.column("text").filter(pa.array(hit == 1)).to_pylist()]
            if grams:
                columns = [signature(g) for g in grams], [g.tobytes() for g in grams]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], schema=schema)

    found = documents.select("text", place.alias("place")).mapInArrow(read, "sig binary, grams binary")
    return found.join(wanted, "sig", "left_semi").dropDuplicates(["sig"])


def _may_be_similar(percent: int) -> Column:
    """Length filter and positional filter of prefix rows l and r of one shingle.

    At the first shared shingle nothing before it is shared, so what stands from there on
    bounds the overlap; a pair whose first shared shingle fails is not similar.
    """
    length = 100 * F.least("l.n", "r.n") >= percent * F.greatest("l.n", "r.n")
    rest = F.least(F.col("l.n") - F.col("l.pos"), F.col("r.n") - F.col("r.pos"))
    return length & ((100 + percent) * rest >= percent * (F.col("l.n") + F.col("r.n")))


def _shared_at_most(x: bytes | None, y: bytes | None, n: int, m: int) -> int:
    """Most shingles that two sets can share, by their numbers in each range."""
    if x is None or y is None:
        return min(n, m)
    return int(np.minimum(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)).sum(dtype=np.int64))


def _shared(x: bytes, y: bytes, n: int, m: int) -> int:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    return len(np.intersect1d(a, b, assume_unique=True))


def _kept(pairs: DataFrame, sets: DataFrame, column: str, shared, percent: int) -> DataFrame:
    """The pairs (a, b, n, m) whose ``shared`` shingles would be enough for a link."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            numbers = zip(batch["x"], batch["y"], batch["n"], batch["m"], strict=True)
            keep = [(100 + percent) * shared(x, y, n, m) >= percent * (n + m) for x, y, n, m in numbers]
            yield batch.loc[keep, ["a", "b", "n", "m"]]

    left = sets.select(F.col("sig").alias("a"), F.col(column).alias("x"))
    right = sets.select(F.col("sig").alias("b"), F.col(column).alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y")
    return both.mapInPandas(each, "a binary, b binary, n long, m long")


def _similar(pairs: DataFrame, documents: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of ``pairs`` (a, b, n, m) that are similar: suffix filter, then whole sets."""
    with Scratch(documents.sparkSession) as scope:
        close = saved(_kept(pairs, classes, "ranges", _shared_at_most, percent), "pairs")
        wanted = close.select(F.col("a").alias("sig")).unionByName(close.select(F.col("b").alias("sig")))
        similar = _kept(close, _sets(documents, classes, wanted, words), "grams", _shared, percent)
        return scope.result(similar.select("a", "b"), "pairs")


def _ordered() -> list[Column]:
    """A pair of rows l and r as (a, b, n, m), the smaller signature first."""
    swapped = F.col("l.sig") > F.col("r.sig")
    either = lambda c, first, second: F.when(swapped, F.col(f"{first}.{c}")).otherwise(F.col(f"{second}.{c}"))
    return [
        either("sig", "r", "l").alias("a"), either("sig", "l", "r").alias("b"),
        either("n", "r", "l").cast("long").alias("n"), either("n", "l", "r").cast("long").alias("m"),
    ]


def _links(prefixes: DataFrame, documents: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between signatures that connect every group of similar sets."""
    with Scratch(documents.sparkSession) as scope:
        rows = saved(prefixes.join(classes.select("key", "sig"), "key").select("shingle", "sig", "n", "pos"), "rows")
        first = F.min_by(F.struct("sig", "n", "pos"), F.struct("pos", "sig")).alias("first")
        leaders = saved(
            rows.groupBy("shingle").agg(first, F.count("*").alias("size")).select("shingle", "size", "first.*"), "leaders"
        )
        same = F.col("l.shingle") == F.col("r.shingle")
        pairs = leaders.alias("l").join(rows.alias("r"), same & _may_be_similar(percent) & (F.col("l.sig") != F.col("r.sig")))
        found = _similar(pairs.select(*_ordered()).distinct(), documents, classes, words, percent)
        roots = saved(components(found), "roots")

        # A bucket of two had its only pair compared; the others may hold pairs still apart.
        larger = saved(leaders.where("size > 2").select("shingle"), "larger")
        rows = saved(rows.join(larger, "shingle", "left_semi"), "rows")
        placed = rows.join(roots, rows["sig"] == roots["node"], "left").select(
            "shingle", "sig", "n", "pos", F.coalesce("root", "sig").alias("root")
        )
        placed = saved(placed, "placed")
        # The largest component of every bucket that still has several.
        sizes = placed.groupBy("shingle", "root").agg(F.count("*").alias("size"))
        main = saved(
            sizes.groupBy("shingle")
            .agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("roots"))
            .where("roots > 1").select("shingle", "main"),
            "main",
        )
        apart = saved(placed.join(main, "shingle"), "apart")
        once = (F.col("r.root") == F.col("r.main")) | (F.col("l.sig") < F.col("r.sig"))
        pairs = apart.where("root != main").alias("l").join(
            apart.alias("r"), same & (F.col("l.root") != F.col("r.root")) & once & _may_be_similar(percent)
        )
        also = _similar(pairs.select(*_ordered()).distinct(), documents, classes, words, percent)
        return scope.result(found.unionByName(also), "links")


def near_groups(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, digest (hash of the text), n_shingles and component_id of every document."""
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _digest(F.col("text")).alias("digest"))
    with Scratch(spark) as scope:
        everything = _profiles(documents, words)
        profiles = everything.where("chunk is null")
        classes = saved(
            profiles.where("n > 0").groupBy("sig", "key").agg(
                F.min(F.struct("doc_id", "digest")).alias("at"), F.min("ranges").alias("ranges"),
                F.min("doc_id").alias("first_id"),
            ),
            "classes",
        )
        rarity = spark.sparkContext.broadcast(_rarity(everything))
        prefixes = _shared_prefixes(documents, rarity, words, percent)
        roots = components(_links(prefixes, documents, classes, words, percent))

        rooted = saved(
            classes.join(roots, classes["sig"] == roots["node"], "left").select("sig", "first_id", F.coalesce("root", "sig").alias("root")),
            "rooted",
        )
        groups = saved(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "groups")
        by_class = saved(rooted.join(groups, "root").select("sig", "component_id"), "by-class")
        # Copies of one text share their class: both sides are tables, so a hot one can be split.
        found = profiles.join(by_class, "sig", "left").select(
            "doc_id", "digest", F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        return scope.result(found, "near")


def one_of_each(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """``documents`` with one document of each group: the one with the smallest id.

    Documents without words are in no group and stay.
    """
    with Scratch(documents.sparkSession) as scope:
        found = near_groups(documents, words, percent)
        wordless = found.where("n_shingles = 0").select("doc_id", "digest").distinct().withColumn("alone", F.lit(True))
        first = (
            found.where("n_shingles > 0").groupBy("component_id")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "digest")).alias("at"))
            .select("at.doc_id", "at.digest").withColumn("alone", F.lit(False))
        )
        copies = found.groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
        chosen = first.unionByName(wordless)
        same = F.col("c.doc_id").eqNullSafe(F.col("k.doc_id")) & F.col("c.digest").eqNullSafe(F.col("k.digest"))
        chosen = scope.result(
            chosen.alias("c").join(copies.alias("k"), same).select(
                F.col("c.doc_id").alias("_id"), F.col("c.digest").alias("_digest"),
                (~F.col("c.alone") & (F.col("copies") > 1)).alias("_repeated"),
            ),
            "chosen",
        )
    here = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & _digest(F.col("text")).eqNullSafe(F.col("_digest"))
    kept = documents.join(chosen.hint("shuffle_hash"), here)
    repeated = kept.where("_repeated").dropDuplicates(["_id", "_digest"])
    return kept.where("not _repeated").unionByName(repeated).select(*documents.columns)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose sets of 4-word shingles overlap by 85 % or more."""
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
