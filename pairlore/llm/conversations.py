"""Conversation structure repair: cheapest edits to a legal role sequence, in linear space.

Rows are first damaged by crc32("conv_id:turn") % 20 (nulls as one space): 0 drops the row,
1 empties its text, 2 removes its ``.!?``, 3 repeats it (same turn), 4 makes it a user row.
Each conversation's rows are then ordered by turn (nulls first), role, text. A row's first
fault counts: blank (no character outside ``[\\x20\\x09-\\x0D]``), duplicate (same role and text
seen earlier), truncated (its last such character is not ``.``, ``!`` or ``?``).

Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only edit of a blank or duplicate
row), Insert an empty user or assistant row anywhere 2; a truncated row that is kept or
rerolled costs 1 more. The repaired role initials must read ``(s?(ua)+)?``. Of all cheapest
edit sequences the one whose initials (D, I, K, R) are ASCII-least is taken.

The method is Hirschberg's divide and conquer on a four-state automaton (empty, after system,
after user, after assistant). A segment of rows is split in the middle; a forward sweep from
the segment's start state and a backward sweep from its terminal cost vector give two cost
vectors that meet at the middle, and their sum names the optimal crossing states. The first
half is solved first against the backward vector, which yields the ASCII-least crossing (its
path is the least one), then the second half from there. Short segments are walked greedily,
letter by letter, on backward costs. Memory is linear in the rows: no table of rows by states
is kept, only O(log n) vectors.

Spark does the damage, the ordering keys and the bookkeeping; one conversation is one group of
``applyInPandas`` and is processed in one task, in memory linear in its rows (an edit path
and the hash of the repaired text are sequential in the conversation).

Defined results: a conversation without rows after damage has zeros, an empty audit and the
SHA-256 of the empty text. Null conv_id rows form one conversation (conv_id null). Null turns
sort first and do not count for gaps. A role's initial is its first character (empty for an
empty role); only ``s``, ``u``, ``a`` are legal, so other roles must be rerolled or deleted.
Extra input columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairlore.llm.common import table

INF = float("inf")
EMPTY, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
ACCEPT = (EMPTY, ASSISTANT)
BASE = 16  # rows below which a segment is walked greedily
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 3, 2, 0, 2, 1
LEGAL_PAIRS = {"su", "ua", "au"}
_BLANK = re.compile(r"[^\x20\x09-\x0D]")
_LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")

SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _after_user(state: int) -> int | None:
    """State after a user row, or None where one may not follow."""
    return USER if state in (EMPTY, SYSTEM, ASSISTANT) else None


def _after_assistant(state: int) -> int | None:
    return ASSISTANT if state == USER else None


def _inserted(state: int) -> int:
    """State after inserting the one row that may follow: user, or assistant after user."""
    return ASSISTANT if state == USER else USER


def _moves(row: tuple[str, int], state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the row edits from ``state``, in letter order."""
    initial, fault = row
    moves = [("D", DELETE, state)]
    if fault in ("blank", "duplicate"):
        return moves
    extra = TRUNCATED if fault == "truncated" else 0
    kept = {"s": SYSTEM if state == EMPTY else None, "u": _after_user(state), "a": _after_assistant(state)}.get(initial)
    if kept is not None:
        moves.append(("K", KEEP + extra, kept))
    target = _after_user(state) if state != USER else _after_assistant(state)
    moves.append(("R", REROLE + extra, target))
    return moves


def _closed_back(costs: list[float]) -> list[float]:
    """Cost-to-go with inserts allowed before the next row."""
    costs = list(costs)
    for _ in range(4):
        for s in range(4):
            costs[s] = min(costs[s], INSERT + costs[_inserted(s)])
    return costs


def _closed_forward(costs: list[float]) -> list[float]:
    costs = list(costs)
    for _ in range(4):
        for s in range(4):
            t = _inserted(s)
            costs[t] = min(costs[t], costs[s] + INSERT)
    return costs


def _back(row: tuple[str, int], after: list[float]) -> list[float]:
    """Cost-to-go before a row (before inserts there) from the cost-to-go after it."""
    costs = [min(c + after[t] for _, c, t in _moves(row, s)) for s in range(4)]
    return _closed_back(costs)


def _forward(row: tuple[str, int], before: list[float]) -> list[float]:
    """Cheapest cost of reaching each state after a row, inserts before it included."""
    before = _closed_forward(before)
    costs = [INF] * 4
    for s in range(4):
        if before[s] < INF:
            for _, c, t in _moves(row, s):
                costs[t] = min(costs[t], before[s] + c)
    return costs


def _greedy(rows: Sequence[tuple[str, int]], lo: int, hi: int, state: int, terminal: list[float]):
    """ASCII-least cheapest edits of rows[lo:hi] from ``state`` against ``terminal`` costs."""
    costs = [terminal]
    for i in range(hi - 1, lo - 1, -1):
        costs.append(_back(rows[i], costs[-1]))
    costs.reverse()  # costs[i - lo]: cost-to-go before row i, before inserts there
    edits: list[tuple[str, int]] = []
    i = lo
    while i < hi:
        here, after = costs[i - lo], costs[i - lo + 1]
        options = [(letter, c + after[t], t, 1) for letter, c, t in _moves(rows[i], state)]
        options.append(("I", INSERT + here[_inserted(state)], _inserted(state), 0))
        letter, _, state, step = min((o for o in options if o[1] == here[state]), key=lambda o: o[0])
        edits.append((letter, state))
        i += step
    return edits, state


def _solve(rows, lo, hi, state, terminal):
    """Hirschberg: split in the middle, meet the cost vectors, solve the first half first."""
    if hi - lo <= BASE:
        return _greedy(rows, lo, hi, state, terminal)
    mid = (lo + hi) // 2
    back = terminal
    for i in range(hi - 1, mid - 1, -1):
        back = _back(rows[i], back)
    front = [INF] * 4
    front[state] = 0.0
    for i in range(lo, mid):
        front = _forward(rows[i], front)
    best = min(f + b for f, b in zip(front, back))
    first, crossing = _solve(rows, lo, mid, state, back)
    assert front[crossing] + back[crossing] == best, "crossing off the optimum"
    second, end = _solve(rows, mid, hi, crossing, terminal)
    return first + second, end


def _finish(state: int) -> list[tuple[str, int]]:
    """Inserts after the last row: none in an accepting state."""
    edits = []
    while state not in ACCEPT:
        state = _inserted(state)
        edits.append(("I", state))
    return edits


def repair(rows: Sequence[tuple[str, int]]) -> tuple[int, list[tuple[str, int]]]:
    """(cost, edits) for rows of (role initial, fault); an edit is (letter, state after it)."""
    stop = _closed_back([0.0 if s in ACCEPT else INF for s in range(4)])
    if not rows:
        return 0, []
    edits, end = _solve(rows, 0, len(rows), EMPTY, stop)
    edits += _finish(end)
    cost = 0
    i = 0
    for letter, _ in edits:
        if letter == "I":
            cost += INSERT
            continue
        fault = rows[i][1]
        extra = TRUNCATED if fault == "truncated" and letter in "KR" else 0
        cost += {"D": DELETE, "K": KEEP, "R": REROLE}[letter] + extra
        i += 1
    return cost, edits


def faults(roles: Sequence[str], texts: Sequence[str]) -> list[str | None]:
    """First fault of each row, in order: blank, duplicate, truncated or None."""
    seen: set[tuple[str, str]] = set()
    out = []
    for role, text in zip(roles, texts):
        if not _BLANK.search(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            last = _LAST.search(text)
            out.append("truncated" if last is None or last.group(1) not in ".!?" else None)
        seen.add((role, text))
    return out


def _conversation(frame: pd.DataFrame) -> pd.DataFrame:
    conv_id = frame["conv_id"].iloc[0]
    frame = frame.sort_values(["turn", "role", "text"], na_position="first", kind="stable")
    roles, texts = list(frame["role"]), list(frame["text"])
    turns = frame["turn"].dropna()
    gaps = int(turns.max() - turns.min() + 1 - turns.nunique()) if len(turns) else 0
    kinds = faults(roles, texts)
    initials = [r[:1] for r in roles]
    illegal = sum(1 for a, b in zip(initials, initials[1:]) if a + b not in LEGAL_PAIRS)
    cost, edits = repair(list(zip(initials, kinds)))
    lines, i = [], 0
    for letter, state in edits:
        if letter == "I":
            lines.append(("user" if state == USER else "assistant") + ":")
            continue
        if letter == "K":
            lines.append(f"{roles[i]}:{texts[i]}")
        elif letter == "R":
            lines.append(("user" if state == USER else "assistant") + ":" + texts[i])
        i += 1
    return pd.DataFrame(
        {
            "conv_id": [None if pd.isna(conv_id) else int(conv_id)],
            "gaps": [gaps],
            "blank": [kinds.count("blank")],
            "duplicate": [kinds.count("duplicate")],
            "truncated": [kinds.count("truncated")],
            "illegal": [illegal],
            "cost": [cost],
            "audit": ["".join(letter for letter, _ in edits)],
            "repaired_sha256": [hashlib.sha256("\n".join(lines).encode("utf-8")).hexdigest()],
        }
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage: conv_id, turn, role, text (nulls of role and text as one space)."""
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    d = F.crc32(key) % 20
    role = F.coalesce(F.col("role"), F.lit(" "))
    text = F.coalesce(F.col("text"), F.lit(" "))
    return (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            role.alias("role"), text.alias("text"), d.alias("d"),
        )
        .where(F.col("d") != 0)
        .select(
            "conv_id", "turn",
            F.when(F.col("d") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("d") == 1, F.lit(""))
            .when(F.col("d") == 2, F.regexp_replace("text", r"[.!?]", ""))
            .otherwise(F.col("text")).alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("d") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per original conv_id: faults, cost, audit and hash of the repaired text."""
    done = damaged(conversations).groupBy("conv_id").applyInPandas(_conversation, SCHEMA)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.join(done.withColumnRenamed("conv_id", "_done"), ids.conv_id.eqNullSafe(F.col("_done")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.col("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.col("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, damaged and repaired."""
    return repaired(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
