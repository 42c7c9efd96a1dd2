"""op12: Hirschberg repair against exhaustive search and a plain full-table walk."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from pairlore.llm import conversations as cv

LEGAL = re.compile(r"(s?(ua)+)?")
FAULTS = (None, "blank", "duplicate", "truncated")


def brute(rows):
    """Cheapest, then ASCII-least audit, over all scripts with at most two inserts a gap."""
    n = len(rows)
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    for choice in itertools.product(["D", "K", "Ru", "Ra"], repeat=n):
        ok, cost = True, 0
        for (initial, fault), c in zip(rows, choice):
            if fault in ("blank", "duplicate") and c != "D":
                ok = False
            if c == "K" and initial not in "sua":
                ok = False
        if not ok:
            continue
        for ins in itertools.product(gaps, repeat=n + 1):
            seq, audit, cost = "", "", 0
            for i in range(n + 1):
                seq += ins[i]
                audit += "I" * len(ins[i])
                cost += 2 * len(ins[i])
                if i == n:
                    break
                (initial, fault), c = rows[i], choice[i]
                extra = 1 if fault == "truncated" and c != "D" else 0
                if c == "D":
                    audit += "D"; cost += 3
                elif c == "K":
                    audit += "K"; cost += extra; seq += initial
                else:
                    audit += "R"; cost += 2 + extra; seq += c[1]
            if LEGAL.fullmatch(seq) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def plain(rows):
    """Greedy on a full table of backward costs (no divide and conquer)."""
    stop = cv._closed_back([0.0 if s in cv.ACCEPT else cv.INF for s in range(4)])
    edits, end = cv._greedy(rows, 0, len(rows), cv.EMPTY, stop)
    return edits + cv._finish(end)


def test_small_rows_match_exhaustive_search():
    rng = random.Random(5)
    cases = [[], [("s", None)], [("u", None)], [("a", "truncated")], [("x", None), ("u", "blank")]]
    cases += [[(rng.choice("suax"), rng.choice(FAULTS)) for _ in range(rng.randint(1, 4))] for _ in range(150)]
    for rows in cases:
        cost, edits = cv.repair(rows)
        assert (cost, "".join(e for e, _ in edits)) == brute(rows), rows


@pytest.mark.parametrize("base", [1, 2, 3, 16])
def test_divide_and_conquer_equals_full_table(monkeypatch, base):
    monkeypatch.setattr(cv, "BASE", base)
    rng = random.Random(base)
    for n in (5, 17, 64, 257):
        rows = [(rng.choice("suaus"), rng.choice(FAULTS + (None, None))) for _ in range(n)]
        assert cv.repair(rows)[1] == plain(rows)


def test_long_conversation_is_linear():
    rows = [("u", None), ("a", "truncated")] * 20_000 + [("s", "blank")]
    cost, edits = cv.repair(rows)
    assert cost == 20_000 + 3 and len(edits) == len(rows)


def test_faults_take_the_first():
    roles = ["user", "user", "user", "user", "assistant"]
    texts = [" \t", "Hi.", "Hi.", "Hi", "Hi."]
    assert cv.faults(roles, texts) == ["blank", None, "duplicate", "truncated", None]


def py_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if d == 0:
            continue
        text = "" if d == 1 else re.sub(r"[.!?]", "", text) if d == 2 else text
        role = "user" if d == 4 else role
        out += [(conv_id, turn, role, text)] * (2 if d == 3 else 1)
    return sorted(out, key=repr)


def test_spark_query_on_odd_rows(spark):
    rows = [(c, t, r, x) for c in range(12) for t, r, x in [(0, "system", "Be nice."), (1, "user", "Hi there"), (2, "assistant", "Hello!")]]
    rows += [(50, None, None, None), (50, 3, "user", None), (51, 1, "tool", "x" * 100_000), (None, 1, "user", "q?")]
    schema = "conv_id long, turn long, role string, text string, score string, audit string"
    df = spark.createDataFrame([r + ("a", "b") for r in rows], schema)
    got = {r.conv_id: r for r in cv.repaired(df).collect()}
    assert set(got) == {r[0] for r in rows}
    assert [tuple(r) for r in sorted(cv.damaged(df).collect(), key=repr)] == py_damage(rows)
    for conv_id, row in got.items():
        mine = [r for r in py_damage(rows) if r[0] == conv_id]
        if not mine:
            assert (row.cost, row.audit, row.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
            continue
        import pandas as pd
        want = cv._conversation(pd.DataFrame(mine, columns=["conv_id", "turn", "role", "text"])).iloc[0]
        assert (row.cost, row.audit, row.repaired_sha256, row.blank, row.gaps) == (
            want.cost, want.audit, want.repaired_sha256, want.blank, want.gaps)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cv.repaired(df).count() == 0
