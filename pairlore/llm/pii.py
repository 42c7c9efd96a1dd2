"""Personal data: overlapping candidates, judged by boosted trees.

Strict patterns give the base spans, which always stay. Loose generators propose further,
overlapping spans (spelled-out addresses, digit runs with other separators, ...). What breaks a
format rule goes; trees judge the rest by format and context. They learn from the strict spans
and from well-formed candidates that their context tells to be something else; a threshold per
kind, calibrated on such examples that the trees did not see, selects what is added.

Nulls: a null text counts as empty and has no spans. An empty table gives an empty result;
repeated rows give repeated rows. Other columns are ignored (``find``) or kept (``redact``).
All patterns run in linear time, so very long texts are searched whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairlore.llm.boosting import Trees, fit, fit_table
from pairlore.llm.common import table
from pairlore.sources.scratch import Scratch, saved

KINDS = ("email", "ip", "card", "phone")
GRID = 2.0**16  # parts of 1 that the scores of held out examples are counted in
SLICES = 32  # of a kind and label, so that no task orders all its examples
PRECISION = 0.98  # of added spans, among the candidates held out
CONTEXT = 24  # characters on either side

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behinds stand after the first digit: a search for a digit is what runs fast.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){11,}+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# High recall. Digit patterns run inside zones of digits and separators; all are bounded.
ZONE = re.compile(r"[+(0-9][0-9 ()./,_-]{5,}")
LOOSE_NUMBERS = (
    ("ip", re.compile(r"(?=(?<![0-9.])([0-9]{1,4}(?:[.,] ?[0-9]{1,4}){3})(?![0-9]))")),
    ("card", re.compile(r"(?=(?<![0-9A-Za-z])([0-9](?:[ ./_-]{0,2}[0-9]){11,18})(?![0-9A-Za-z]))")),
    ("phone", re.compile(r"(?=(?<![0-9A-Za-z+])((?:\+|00|\()?[0-9](?:[ ()./-]{0,3}[0-9]){6,14})(?![0-9A-Za-z]))")),
)
AROUND_AT = re.compile(r"[^\s@<>()\[\]\"',;:]{1,255}")
SPELLED_AT = re.compile(r"[(\[](?:at|AT)[)\]]")
BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?$")
SPELLED_DOMAIN = re.compile(r" ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[](?:dot|DOT)[)\]]) ?[A-Za-z0-9-]{1,63}){1,4}")
HINTS = {
    "email": ("mail", "@", "contact"), "ip": ("ip", "host", "addr"),
    "card": ("card", "visa", "pay"), "phone": ("tel", "phone", "call", "fax"),
}
SPAN = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ back over the local part, so a long run of its characters is read once."""
    end, at = 0, text.find("@")
    while at >= 0:
        found = DOMAIN.match(text, at)
        if found:
            start = at
            while start > end and LOCAL.match(text, start - 1):
                start -= 1
            if start < at:
                end = found.end()
                yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The strict spans, by kind in the order of KINDS."""
    out = [("email", *x) for x in _emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping proposals of the generators, each (kind, start, end) once."""
    found, at = [], text.find("@")
    while at >= 0:
        start = at
        while start > max(0, at - 64) and AROUND_AT.match(text[start - 1]):
            start -= 1
        domain = AROUND_AT.match(text, at + 1)
        if start < at and domain:
            found.append(("email", start, domain.end()))
        at = text.find("@", at + 1)
    for m in SPELLED_AT.finditer(text):
        local = BEFORE_AT.search(text[max(0, m.start() - 65) : m.start()])
        domain = SPELLED_DOMAIN.match(text, m.end())
        if local and domain:
            found.append(("email", m.start() - len(local[0]), domain.end()))
    for zone in ZONE.finditer(text):
        for kind, p in LOOSE_NUMBERS:
            found += [(kind, *m.span(1)) for m in p.finditer(text, zone.start(), min(len(text), zone.end() + 1))]
    return list(dict.fromkeys(found))


def _breaks_format(kind: str, span: str) -> bool:
    """What no datum of this kind looks like: the negatives."""
    digits = _digits(span)
    if kind == "email":
        return not re.search(r"[A-Za-z]{2,}\]?$", span)
    if kind == "ip":
        return not all(map(_small, re.findall(r"[0-9]+", span)))
    if kind == "card":
        return not luhn(digits)
    return not 9 <= len(digits) <= 15


def candidate_features(text: str, kind: str, start: int, end: int) -> list[float]:
    span = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    return [
        *(float(kind == k) for k in KINDS),
        len(span), len(digits), sum(c.isalpha() for c in span), sum(c.isspace() for c in span),
        span.count("."), span.count("-"), span.count("("), span.count("@"), float(span[:1] == "+"),
        float(span[:1] == "0"), len(groups), max(groups, default=0), min(groups, default=0),
        float(luhn(digits)) if digits else 0.0, float(len(set(digits))),
        max((int(g) for g in re.findall(r"[0-9]{1,6}", span)), default=0),
        float(before[-1:].isspace() or not before), float(before[-1:].isalnum()),
        float(after[:1].isalnum()), float(after[:1] in ".,;"), sum("0" <= c <= "9" for c in before),
        sum("0" <= c <= "9" for c in after), float(_hinted(kind, before)),
        float(":" in before[-3:] or "=" in before[-3:]), float(bool(re.search(r"\.[A-Za-z]{2,}$", span))),
    ]


class PiiModel(NamedTuple):
    trees: Trees
    thresholds: dict[str, float]

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Candidates over the threshold that touch no base span of their kind."""
        taken = Taken(base)
        left = [c for c in candidates(text) if self.thresholds[c[0]] <= 1 and not taken.touches(c)]
        left = [c for c in left if not _breaks_format(c[0], text[c[1] : c[2]])]
        if not left:
            return []
        p = self.trees.probability(np.array([candidate_features(text, *c) for c in left], dtype=float))
        kept = []
        for score, c in sorted(zip(p, left, strict=True), key=lambda x: (-x[0], x[1][1], -x[1][2], x[1][0])):
            if score >= self.thresholds[c[0]] and not taken.touches(c):
                taken.add(c)
                kept.append(c)
        return kept


class Taken:
    """Disjoint spans by kind, to ask whether another one touches them."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.by_kind = {k: sorted((s, e) for kind, s, e in spans if kind == k) for k in KINDS}

    def touches(self, span: tuple[str, int, int]) -> bool:
        kind, start, end = span
        own = self.by_kind[kind]
        i = bisect_left(own, (end, 0))  # the last span that starts before this one's end
        return i > 0 and own[i - 1][1] > start

    def add(self, span: tuple[str, int, int]) -> None:
        insort(self.by_kind[span[0]], span[1:])


NO_MODEL = PiiModel(fit(np.zeros((0, 1)), np.zeros(0)), dict.fromkeys(KINDS, 2.0))


def _hinted(kind: str, before: str) -> bool:
    near = before.lower()
    return any(h in near for h in HINTS[kind])


def _passing_twin(span: str) -> str:
    """``span`` with its last digit changed so that the Luhn sum is right."""
    at = max(i for i, c in enumerate(span) if "0" <= c <= "9")
    return next(t for c in "0123456789" if luhn(_digits(t := span[:at] + c + span[at + 1 :])))


def _examples(text: str) -> Iterator[tuple[str, int, str, int, int]]:
    """(kind, label, text, start, end) of what passes the format filter, as the judged candidates do.

    Positive are the strict spans. Negative are other candidates that touch a strict span of
    another kind or have no hint of their own kind before them; one with a hint has no label.
    Numbers that are no cards pass the Luhn test once in ten times, so one of nine that fail it,
    chosen by hash, is a negative too, with the last digit changed, unless it then is a strict span.
    """
    base = base_spans(text)
    taken = Taken(base)
    for k, s, e in base:
        if not _breaks_format(k, text[s:e]):
            yield k, 1, text, s, e
    for k, s, e in candidates(text):
        if taken.touches((k, s, e)):
            continue
        span, before = text[s:e], text[max(0, s - CONTEXT) : s]
        if not _breaks_format(k, span):
            if not _hinted(k, before) or any(taken.touches((other, s, e)) for other in KINDS if other != k):
                yield k, 0, text, s, e
        elif k == "card" and _hash(span) % 9 == 0:
            near = before + _passing_twin(span) + text[e : e + CONTEXT]
            twin = (k, len(before), len(before) + len(span))
            if not Taken(base_spans(near)).touches(twin):
                yield k, 0, near, *twin[1:]


def _hash(*parts: str) -> int:
    data = "\0".join(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "big", signed=True)


def _keyed(texts: Iterator[str]) -> Iterator[tuple[str, int, str, int, int, int]]:
    """(kind, label, text, start, end, key) of all examples.

    The key is a hash of the span with its context, which is all that the features see.
    """
    for text in texts:
        for kind, label, source, start, end in _examples(text):
            near = source[max(0, start - CONTEXT) : start], source[start:end], source[end : end + CONTEXT]
            yield kind, label, source, start, end, _hash(kind, *near)


def _described(kind: str, source: str, start: int, end: int) -> tuple[int, list[float]]:
    """(fold, features); the fold is a hash of the span alone, so that a datum is either learned from or held out."""
    return _hash(kind, source[start:end]) % 3, candidate_features(source, kind, start, end)


def _smallest(texts: Iterator[str], limit: int) -> Iterator[tuple[str, int, int, int, list[float]]]:
    """(kind, label, key, fold, features) of the distinct examples with the ``limit`` smallest keys of each kind and label."""
    kept: dict[tuple[str, int], dict[int, tuple[int, list[float]]]] = defaultdict(dict)
    most: dict[tuple[str, int], int] = {}
    for kind, label, source, start, end, key in _keyed(texts):
        group = (kind, label)
        own = kept[group]
        if key in own or key > most.get(group, key):
            continue
        own[key] = _described(kind, source, start, end)
        if len(own) >= 2 * limit:
            kept[group] = {k: own[k] for k in sorted(own)[:limit]}
            most[group] = max(kept[group])
    for (kind, label), own in kept.items():
        for key in sorted(own)[:limit]:
            yield kind, label, key, *own[key]


def examples(documents: DataFrame, limit: int | None = None) -> DataFrame:
    """(kind, label, key, fold, x): the distinct examples of all documents.

    With a ``limit``, those of each kind and label with the smallest keys: tasks, then slices
    of the keys, then kinds and labels keep their smallest, so each step hands on a bounded number.
    """
    columns = ["kind", "label", "key", "fold", "x"]

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if limit is not None:
            rows = list(_smallest((text for batch in batches for text in batch["text"]), limit))
            yield pd.DataFrame(rows, columns=columns)
            return
        for batch in batches:
            met = {(kind, label, key): at for kind, label, *at, key in _keyed(batch["text"])}
            rows = [(*k, *_described(k[0], *at)) for k, at in met.items()]
            yield pd.DataFrame(rows, columns=columns)

    rows = (
        documents.select("text").where("text is not null")
        .mapInPandas(found, "kind string, label int, key bigint, fold int, x array<double>")
        .dropDuplicates(["kind", "label", "key"])
    )
    if limit is None:
        return rows
    rows = rows.withColumn("slice", F.pmod("key", F.lit(SLICES)))
    for group in (["kind", "label", "slice"], ["kind", "label"]):
        nth = F.row_number().over(Window.partitionBy(*group).orderBy("key"))
        rows = rows.withColumn("nth", nth).where(F.col("nth") <= limit)
    return rows.drop("slice", "nth")


def train(documents: DataFrame, limit: int | None = None) -> PiiModel:
    """Trees and thresholds from all distinct examples of all documents, or at most ``limit`` of each kind and label."""
    with Scratch(documents.sparkSession):  # examples, plain and binned
        rows = saved(examples(documents, limit), "examples")
        if rows.isEmpty():
            return NO_MODEL
        trees = fit_table(rows.where("fold <> 0"))

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            p = trees.probability(np.array(x.tolist(), dtype=float))
            return pd.Series(np.floor(p * GRID) / GRID)

        held_out = (
            rows.where("fold = 0").select("kind", "label", score("x").alias("score"))
            .groupBy("kind", "score").agg(F.sum("label").alias("right"), F.count("*").alias("seen"))
            .orderBy("kind", F.desc("score")).toPandas()  # at most GRID rows a kind
        )
        of_kind = (held_out[held_out["kind"] == k] for k in KINDS)
        return PiiModel(trees, {
            k: _threshold(*(own[c].to_numpy() for c in ("score", "right", "seen"))) for k, own in zip(KINDS, of_kind, strict=True)
        })


def _threshold(p: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The lowest score from which the precision holds, equal scores together; 2 (never) without enough evidence.

    Of ``n`` examples of a score (1 by default), ``y`` are right.
    """
    order = np.argsort(-p, kind="stable")
    right, seen = np.cumsum(y[order]), np.cumsum(np.ones(len(y)) if n is None else n[order])
    last = np.append(np.diff(p[order]) != 0, True)[: len(y)]
    holds = np.flatnonzero(((right + 1) / (seen + 2) >= PRECISION) & last)
    return float(p[order][holds[-1]]) if len(holds) else 2.0


def spans_udf(model: PiiModel):
    """Text to its spans by start, then by kind."""

    @F.pandas_udf(SPAN)
    def spans(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            base = base_spans(text)
            rows = [(k, s, e, True) for k, s, e in base] + [(k, s, e, False) for k, s, e in model.added(text, base)]
            rows.sort(key=lambda r: (r[1], KINDS.index(r[0]), r[2]))
            out.append([dict(zip(("kind", "start", "end", "base"), r, strict=True)) for r in rows])
        return pd.Series(out)

    return spans


def find(documents: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end, base) of every document; ends are exclusive."""
    documents = documents.select("doc_id", "text")
    model = model or train(documents)
    return documents.select("doc_id", spans_udf(model)(F.coalesce("text", F.lit(""))).alias("spans"))


def redact(documents: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """``documents`` with every span in ``text`` replaced by its kind in brackets.

    A null text stays null. Spans that overlap are replaced together, by the first one's kind.
    """
    model = model or train(documents)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _redacted(t, model) for t in texts], dtype=object)

    return documents.withColumn("text", clean(F.col("text")))


def _redacted(text: str, model: PiiModel) -> str:
    base = base_spans(text)
    spans = sorted(base + model.added(text, base), key=lambda x: (x[1], KINDS.index(x[0]), -x[2]))
    out, end = [], 0
    for kind, start, stop in spans:
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def spans_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = find(table(spark, sf_dir, "documents"))

    def number_of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x.base & (x.kind == kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number_of, KINDS),
        F.sha2(spans_text(F.filter("spans", lambda x: x.base)), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )
