"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts, kept as tables: how often each byte followed each
context of up to ORDER bytes in the training texts. A byte unseen in its longest context
escapes to the next shorter one; the escape is estimated by the number of distinct bytes that
followed (method C), and bytes that the longer context knows are excluded below. The code
length of a byte depends on its context alone, so it is worked out once for every distinct
string of ORDER + 1 bytes in the corpus, in joins, and summed per document.

Texts are lower-cased (A-Z) and their words joined by blanks, with an end mark before and
after. Texts meet the parts of the tables that they need block by block, and a block is worked on
in parts, which bound a task's memory; nothing of the size of the vocabulary or the trie
passes through the driver or is broadcast.

Nulls: a null text counts as empty and has the end as its only token; a null id counts as an
empty text in the fold. Without training texts all bytes are equally likely. An empty table
gives an empty result; repeated rows give repeated rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.llm.common import distinct, fold, table
from pairlore.sources.scratch import saved

ORDER = 4
FOLDS, HELD_OUT = 10, 0
BLOCK_BYTES = 8 << 20  # of text that one task scores at once
CHUNK = 4 << 20  # bytes whose strings are counted together
PART = 1 << 20  # of a block that are in memory as words and strings
END = b"\n"  # no word: stands for the end among the words
WORD, GRAM = 0, 1
COUNTS = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])
NEEDS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("key", pa.int64())])
SCORES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base", pa.float64()), ("score", pa.float64()),
])


def tokens(text: str | None) -> list[bytes]:
    """Words of the whole text, A-Z lower-cased; ``bytes.split`` parts at \\x20, \\x09-\\x0D."""
    return (text or "").encode("utf-8", "replace").lower().split()


def grams(words: list[bytes], order: int = ORDER) -> np.ndarray:
    """Every byte of the words and the end mark, behind its ``order`` bytes of context."""
    raw = np.frombuffer(bytes(order) + b" ".join(words) + b"\0", dtype=np.uint8).astype(np.int64)
    n = len(raw) - order
    out = np.zeros(n, dtype=np.int64)
    for k in range(order + 1):
        out = (out << 8) | raw[k : k + n]
    return out


def word_keys(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)).view(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], most: int) -> Iterator[list[tuple]]:
    """Rows of the batches, about ``most`` characters of text together; text comes first."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            rows.append(row)
            size += len(row[0] or "")
            if size >= most:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _slices(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """A group in batches of few rows: only one of them becomes Python objects at a time."""
    return iter(group.to_batches(max_chunksize=256))


def _table(schema: pa.Schema, *columns) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def counts(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """(kind, key, n): occurrences in training texts of words and of byte strings.

    Byte strings of held-out texts are listed too, with 0 where training lacks them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches, ("text", "held_out"), CHUNK):
            words: Counter[bytes] = Counter()
            found: dict[bool, list[np.ndarray]] = {True: [], False: []}
            for text, held_out in rows:
                own = tokens(text)
                found[held_out].append(grams(own, order))
                if not held_out:
                    words.update(own)
                    words[END] += 1
            parts = []
            if words:
                parts.append((WORD, word_keys(list(words)), np.fromiter(words.values(), np.int64, len(words))))
            for held_out, lists in found.items():
                if lists:
                    keys, n = np.unique(np.concatenate(lists), return_counts=True)
                    parts.append((GRAM, keys, n * (not held_out)))
            for kind, keys, n in parts:
                yield from _table(COUNTS, np.full(len(keys), kind), keys, n).to_batches()

    rows = documents.select("text", "held_out").mapInArrow(count, "kind int, key long, n long")
    return saved(rows.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def _low(column: Column, n_bytes: int) -> Column:
    return column.bitwiseAND(F.lit((1 << (8 * n_bytes)) - 1))


def code_lengths(strings: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, cost) for every row of ``strings`` (key, n): log10 probability of its last byte.

    ``n`` is the number of occurrences in training. The tables of the orders below are sums of
    the longest one: ``by_gram[k]`` counts (context, byte), ``by_context[k]`` has the total,
    the number of distinct bytes, and what these bytes count in the next shorter context.
    """
    key = F.col("key")
    by_gram = {order: saved(strings.where("n > 0").select(key.alias("gram"), F.col("n").alias("seen")), "grams")}
    for k in range(order - 1, -1, -1):
        shorter = by_gram[k + 1].groupBy(_low(F.col("gram"), k + 1).alias("gram")).agg(F.sum("seen").alias("seen"))
        by_gram[k] = saved(shorter, "grams")
    by_context = {}
    for k in range(order, -1, -1):
        rows = by_gram[k].select(F.shiftright("gram", 8).alias("context"), "seen", _low(F.col("gram"), k).alias("shorter"))
        if k:
            below = by_gram[k - 1].select(F.col("gram").alias("shorter"), F.col("seen").alias("below"))
            rows = rows.join(below, "shorter")
        else:
            rows = rows.withColumn("below", F.lit(0))
        by_context[k] = saved(
            rows.groupBy("context").agg(
                F.sum("seen").alias("total"), F.count("*").alias("distinct"), F.sum("below").alias("excluded")
            ),
            "contexts",
        )
    left = strings.select("key", F.lit(0.0).alias("cost"), F.lit(0).cast("long").alias("out"), F.lit(0).cast("long").alias("gone"))
    done = []
    for k in range(order, -1, -1):
        contexts, seen = by_context[k], by_gram[k]
        if k <= 2:  # at most 256 ** k contexts
            contexts = F.broadcast(contexts)
        if k <= 1:  # at most 256 ** (k + 1) strings
            seen = F.broadcast(seen)
        context = _low(F.shiftright("key", 8), k) if k else F.lit(0).cast("long")
        step = left.withColumn("context", context).withColumn("gram", _low(F.col("key"), k + 1))
        step = step.join(contexts, "context", "left").join(seen, "gram", "left")
        total = F.col("total") - F.col("out") + F.col("distinct") - F.col("gone")
        escape = F.when(F.col("distinct") > F.col("gone"), F.log10((F.col("distinct") - F.col("gone")) / total)).otherwise(0.0)
        known = F.col("total").isNotNull()
        step = step.select(
            "key",
            (F.col("cost") + F.when(F.col("seen").isNotNull(), F.log10(F.col("seen") / total)).when(known, escape).otherwise(0.0)).alias("cost"),
            F.when(known, F.col("excluded")).otherwise(F.col("out")).alias("out"),
            F.when(known, F.col("distinct")).otherwise(F.col("gone")).alias("gone"),
            F.col("seen").isNotNull().alias("done"),
        )
        step = saved(step, "lengths")
        done.append(step.where("done").select("key", "cost"))
        left = step.where("not done").drop("done")
    out = left.select("key", (F.col("cost") - F.log10(F.lit(256.0) - F.col("gone"))).alias("cost"))
    for part in done:
        out = out.unionByName(part)
    return out


def score(documents: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of ``documents`` (doc_id, text, held_out), trained on those not held out."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out",
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"),
    )
    counted = counts(documents, order)
    words = counted.where(F.col("kind") == WORD)
    of_words = words.agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).first()
    n, n_distinct = of_words["n"] or 0, of_words["distinct"]
    lengths = code_lengths(counted.where(F.col("kind") == GRAM).select("key", "n"), order)
    values = saved(
        words.select("kind", "key", F.col("n").cast("double").alias("value")).unionByName(
            lengths.select(F.lit(GRAM).alias("kind"), "key", F.col("cost").alias("value"))
        ),
        "values",
    )
    per_token = float(np.log10(n + 0.1 * (n_distinct + 1)))

    def needed(group: pa.Table) -> pa.Table:
        own, strings, block = set(), [], group.column("block")[0].as_py()
        for part in _chunks(_slices(group), ("text",), PART):
            found = [tokens(text) for (text,) in part]
            own.update(*found)
            strings.append(distinct(np.concatenate([grams(ws, order) for ws in found])))
        own.add(END)
        keys, strings = word_keys(list(own)), distinct(np.concatenate(strings))
        kind = np.repeat([WORD, GRAM], [len(keys), len(strings)])
        return _table(NEEDS, np.full(len(kind), block), kind, np.concatenate([keys, strings]))

    def scored(group: pa.Table, found: pa.Table) -> pa.Table:
        kind, key = found.column("kind").to_numpy(), found.column("key").to_numpy()
        value = found.column("value").to_numpy()
        lookup = {}
        for k in (WORD, GRAM):
            lookup[k] = pd.Index(key[kind == k]), value[kind == k]
        out = []
        for part in _chunks(_slices(group), ("text", "doc_id", "held_out"), PART):
            out += _scored(part, lookup, per_token, order)
        return _table(SCORES, *zip(*out, strict=True))

    # All columns, though only the text is read: so both uses of the rows share one exchange.
    needs = rows.groupBy("block").applyInArrow(needed, "block long, kind int, key long")
    found = needs.join(values, ["kind", "key"])
    result = rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"
    )
    return result.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )


def _scored(rows: list[tuple], lookup: dict, per_token: float, order: int) -> list[tuple]:
    """Rows of SCORES for rows (text, doc_id, held_out), whose values are looked up together."""
    own = [tokens(text) for text, _, _ in rows]
    strings = [grams(words, order) for words in own]
    count = _looked_up(lookup[WORD], word_keys([w for words in own for w in (*words, END)]))
    logs, cost = np.log10(count + 0.1), _looked_up(lookup[GRAM], np.concatenate(strings))
    word, string, out = 0, 0, []
    for (_, doc_id, held_out), words, of_text in zip(rows, own, strings, strict=True):
        at = slice(word, word + len(words) + 1)
        base = float(logs[at].sum() - (len(words) + 1) * per_token)
        score = float(cost[string : string + len(of_text)].sum())
        out.append((doc_id, held_out, len(words) + 1, int((count[at] > 0).sum()), base, score))
        word, string = at.stop, string + len(of_text)
    return out


def _looked_up(pairs: tuple[pd.Index, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Values of the keys, 0 where there is none."""
    known, values = pairs
    if not len(known):
        return np.zeros(len(keys))
    at = known.get_indexer(keys)  # hashed: a binary search in a block's table takes far longer
    return np.where(at >= 0, values[at], 0.0)


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lengths of every document under a model of nine tenths of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(documents.withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT))
