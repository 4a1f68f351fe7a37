"""Conversation structure repair: the cheapest edits that make a conversation's roles well formed, by branch and bound.

Rows are damaged first (``damaged``), by ``crc32("conv_id:turn") % 20`` with nulls written as one space: 0 drops the
row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it right after itself, 4 makes it a user row.
Null roles and texts are one space. A conversation's rows are then taken by turn (nulls first; ties by role, text).

Each row has its first fault: blank (no character outside ``SPACE``), duplicate (role and text seen before in the
conversation) or truncated (its last such character is not one of ``.!?``). The roles of the repaired conversation
must spell ``(s?(ua)+)?`` by their initials. Edits: keep (K, 0), rerole to user or assistant (R, 2), delete (D, 3;
the only edit for blank and duplicate rows), insert an empty user or assistant row anywhere (I, 2); a truncated row
that is not deleted costs 1 more. The audit is the edits' initials in order; of the cheapest, the ASCII-least.

The search is a depth-first branch and bound (``repair``): an explicit stack of partial solutions, a lower bound on the
cost of every suffix of rows, an incumbent (cost, audit) that starts as "delete all", and a table per node (row,
role state) of the best (cost, audit) that reached it, which removes every later prefix that is worse there. The stack
empties only when no partial solution can beat the incumbent, so it is optimal.

Spark does the damage, orders the rows and groups them by conversation; each group is solved in a Pandas task. A
conversation is one group: its audit and hash are one sequential result, and the tie rule on audits cannot be
settled piecewise. Every original ``conv_id`` (null too) gives one row; one without rows after damage has zeros, an
empty audit and the hash of the empty text. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: damage kinds, costs, edit initials, characters.
DROP, EMPTY, UNPUNCTUATE, REPEAT, AS_USER = 0, 1, 2, 3, 4
KINDS = 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACE = "\x20\x09-\x0d"
ENDS = ".!?"
ROLE_NAMES = {"s": "system", "u": "user", "a": "assistant"}

_VISIBLE = re.compile(f"[^{SPACE}]")
#: Role states: nothing yet, after the system row, after a user row, after an assistant row. Final: start, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
#: The role initial that each state takes next, and the state it leads to.
NEXT = {START: ("s", "u"), SYSTEM: ("u",), USER: ("a",), ASSISTANT: ("u",)}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, n_rows long"
)


def _marked(conversations: DataFrame) -> DataFrame:
    """Every row after damage, dropped ones with ``present`` false so that their conversation stays known."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % KINDS
    text = F.coalesce(F.col("text"), F.lit(" "))
    text = F.when(kind == EMPTY, F.lit("")).when(kind == UNPUNCTUATE, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == AS_USER, F.lit("user")).otherwise(F.coalesce(F.col("role"), F.lit(" ")))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy"), (F.col("kind") != DROP).alias("present"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, with ``copy`` (0, or 1 for a repeat): conv_id, turn, role, text, copy."""
    return _marked(conversations).where("present").drop("present")


def faults(rows: list[tuple[str, str]]) -> list[str | None]:
    """Each row's first fault: 'blank', 'duplicate', 'truncated' or None."""
    seen, out = set(), []
    for role, text in rows:
        visible = _VISIBLE.findall(text)
        if not visible:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif visible[-1] not in ENDS:
            out.append("truncated")
        else:
            out.append(None)
        seen.add((role, text))
    return out


def _row_bound(role: str, fault: str | None) -> int:
    if fault in ("blank", "duplicate"):
        return DELETE
    base = KEEP if role[:1] in ROLE_NAMES else REROLE
    return min(base + (TRUNCATED if fault == "truncated" else 0), DELETE)


def _better(cost: int, audit: str, than: tuple[int, str] | None) -> bool:
    """Whether every completion of (cost, audit) beats the same completion of ``than``."""
    if than is None or cost < than[0]:
        return True
    if cost > than[0] or audit == than[1]:
        return False
    # Equal cost: the audit decides only where it differs from the other before either ends.
    return audit < than[1] and not than[1].startswith(audit) and not audit.startswith(than[1])


def repair(rows: list[tuple[str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cheapest edits of (role, text) rows by branch and bound: (cost, audit, repaired rows)."""
    kinds = faults(rows)
    n = len(rows)
    bound = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        bound[i] = bound[i + 1] + _row_bound(rows[i][0], kinds[i])
    best = (DELETE * n, "D" * n)
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, START, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        low = cost + bound[i]
        if low > best[0]:
            continue
        if low == best[0] and audit > best[1][: len(audit)]:
            continue
        seen = table.get((i, state))
        if seen is not None and _better(*seen, (cost, audit)):
            continue
        if _better(cost, audit, seen):
            table[(i, state)] = (cost, audit)
        if i == n:
            if state in FINAL and (cost, audit) < best:
                best = (cost, audit)
        children = []
        for initial in NEXT[state]:
            if initial != "s":
                children.append((i, AFTER[initial], cost + INSERT, audit + "I"))
        if i < n:
            role, fault = rows[i][0], kinds[i]
            children.append((i + 1, state, cost + DELETE, audit + "D"))
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                for initial in NEXT[state]:
                    if role[:1] == initial:
                        children.append((i + 1, AFTER[initial], cost + KEEP + extra, audit + "K"))
                    elif initial != "s":
                        children.append((i + 1, AFTER[initial], cost + REROLE + extra, audit + "R"))
        # Popped last, tried first: the ASCII-least edit first, so good incumbents come early.
        stack.extend(sorted(children, key=lambda c: c[3], reverse=True))
    return best[0], best[1], rebuild(rows, best[1])


def rebuild(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired (role, text) rows that an audit gives."""
    out, state, i = [], START, 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "I":
            initial = "u" if state in (START, SYSTEM, ASSISTANT) else "a"
            out.append((ROLE_NAMES[initial], ""))
        else:
            role, text = rows[i]
            i += 1
            wanted = [x for x in NEXT[state] if (x == role[:1]) == (edit == "K") and (edit == "K" or x != "s")][0]
            out.append((role if edit == "K" else ROLE_NAMES[wanted], text))
            initial = wanted
        state = AFTER[initial]
    return out


def summary(conv_id, turns: list, rows: list[tuple[str, str]]) -> dict:
    kinds = faults(rows)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for r, _ in rows]
    illegal = sum(1 for x, y in zip(initials, initials[1:]) if x + y not in ("su", "ua", "au"))
    cost, audit, repaired = repair(rows)
    text = "\n".join(f"{role}:{body}" for role, body in repaired)
    return {
        "conv_id": conv_id,
        "gaps": gaps,
        "blank": kinds.count("blank"),
        "duplicate": kinds.count("duplicate"),
        "truncated": kinds.count("truncated"),
        "illegal": illegal,
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(),
        "n_rows": len(rows),
    }


def _solve(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[frame["present"]]
    order = frame.assign(null_turn=frame["turn"].notna()).sort_values(["null_turn", "turn", "role", "text", "copy"], kind="stable")
    turns = [None if pd.isna(t) else int(t) for t in order["turn"]]
    return pd.DataFrame([summary(None, turns, list(zip(order["role"], order["text"])))])


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per original ``conv_id``: the counts, the cost, the audit and the hash of the repaired text."""
    both = _marked(conversations)

    def solve(key, frame: pd.DataFrame) -> pd.DataFrame:
        out = _solve(frame)
        out["conv_id"] = key[0]
        return out

    return both.groupBy("conv_id").applyInPandas(solve, RESULT)
