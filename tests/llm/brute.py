"""Plain versions of the contracts, for small inputs."""

import hashlib
import math
import re
import zlib

RULES8 = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def secrets(text):
    """Counts and the digest of the base spans."""
    text, spans, counts = text or "", [], []
    for rank, (kind, (pattern, group, least)) in enumerate(RULES8.items()):
        flags = re.I | re.A if kind == "assign" else 0
        found = [m for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
        counts.append(len(found))
        spans += [(m.start(), rank, m.end(), kind) for m in found]
    return (*counts, sha(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)))


def bench_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contamination(documents, items, window=13):
    """doc (id, text) rows to (n_words, n_hit, items digest, contaminated)."""
    windows = {}
    for item_id, text in items:
        w = bench_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    lengths = {len(k) for k in windows}
    out = []
    for doc_id, text in documents:
        w, hit, found = bench_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    found |= ids
                    hit |= set(range(i, i + n))
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), sha(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


RULES6 = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0


def pii_passes(kind, span):
    digits = [int(c) for c in span if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and passes_luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def pii(text):
    text, spans, counts = text or "", [], []
    for rank, (kind, pattern) in enumerate(RULES6.items()):
        found = [m for m in re.finditer(pattern, text) if pii_passes(kind, m[0])]
        counts.append(len(found))
        spans += [(m.start(), rank, m.end(), kind) for m in found]
    return (*counts, sha(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)))


def shingle_set(text, words=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def near_groups(documents, words=4, percent=85):
    """(id, set size, smallest id reachable) by comparing all pairs of distinct sets."""
    sets = [shingle_set(t, words) for _, t in documents]
    distinct = list(dict.fromkeys(s for s in sets if s))
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    by_size = sorted(distinct, key=len)
    for i, a in enumerate(by_size):
        for b in by_size[i + 1 :]:
            if 100 * len(a) < percent * len(b):
                break
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                parent[find(a)] = find(b)
    least = {}
    for (doc_id, _), s in zip(documents, sets):
        if s and doc_id is not None:
            root = find(s)
            least[root] = min(doc_id, least.get(root, doc_id))
    return [(i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(documents, sets)]


def lower_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


class Trie:
    """PPM by the book: contexts in a dictionary, method C, exclusion of what was escaped."""

    def __init__(self, texts, order=4):
        self.order, self.follows = order, {}
        for text in texts:
            raw = self.raw(text)
            for i in range(order, len(raw)):
                for k in range(order + 1):
                    after = self.follows.setdefault((k, raw[i - k : i]), {})
                    after[raw[i]] = after.get(raw[i], 0) + 1

    def raw(self, text):
        return bytes(self.order) + " ".join(lower_words(text)).encode() + b"\0"

    def probability(self, context, byte):
        p, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            after = self.follows.get((k, context[len(context) - k :]))
            if not after:
                continue
            left = {b: n for b, n in after.items() if b not in excluded}
            total = sum(left.values()) + len(left)
            if byte in left:
                return p * left[byte] / total
            if left:
                p *= len(left) / total
            excluded |= set(after)
        return p / (256 - len(excluded))

    def score(self, text):
        raw = self.raw(text)
        return sum(math.log10(self.probability(raw[i - self.order : i], raw[i])) for i in range(self.order, len(raw)))


def ppm(documents, folds=10, held=0):
    train = [t for i, t in documents if crc(i) % folds != held]
    counts = {}
    for t in train:
        for w in [*lower_words(t), None]:
            counts[w] = counts.get(w, 0) + 1
    n, v, trie, out = sum(counts.values()), len(counts), Trie(train), []
    for i, t in documents:
        own = [counts.get(w, 0) for w in [*lower_words(t), None]]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in own)
        out.append((i, crc(i) % folds == held, len(own), sum(c > 0 for c in own), n, base, trie.score(t)))
    return out
