"""Conversation repair against brute force."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidelog.llm import conversations, queries

TABLES = "/root/testdata/sf0.01"
LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """Cost, letters and repaired rows, by search over all states in order of (cost, letters)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while True:
        cost, letters, at, roles, left = heapq.heappop(heap)
        state = roles[-1:] if roles != "s" else "s"
        if at == len(rows) and LEGAL.fullmatch(roles):
            return cost, letters, left
        if (at, state) in seen:
            continue
        seen.add((at, state))
        steps = [(5, "I", 0, r, (r, "")) for r in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append((2, "D", 1, "", None))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                steps.append((more, "K", 1, role if role else "?", (role, text)))
                steps += [(1 + more, "R", 1, r, (r, text)) for r in ("user", "assistant")]
        for price, letter, taken, role, row in steps:
            then = roles + role[:1]
            if re.fullmatch(r"s?(ua)*u?", then):
                heapq.heappush(heap, (cost + price, letters + letter, at + taken, then, left + ((row,) if row else ())))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(table, damage=True):
    """conv -> the query's columns."""
    known, after = {r[0] for r in table}, defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv in known:
        taken = sorted(after[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in taken if t is not None]
        rows = faults([r[1:] for r in taken])
        count = [sum(f == kind for _, _, f in rows) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, letters, left = cheapest(rows)
        done = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *count, illegal, cost, letters, done)
    return out


def found(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


@pytest.mark.parametrize("seed", range(40))
def test_prices_and_trace(seed):
    rng = random.Random(seed)
    rows = [(rng.choice("suax"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(0, 12))]
    layers = conversations._layers([(i if i in "sua" else "", f) for i, f in rows])
    price = conversations.settle(layers, conversations.END)
    edits, state = conversations.trace(layers, price, conversations.END, conversations.START)
    names = {"s": "system", "u": "user", "a": "assistant", "x": "x"}
    cost, letters, _ = cheapest([(names[i], "", f) for i, f in rows])
    assert (price[0], "".join(e[0] for e in edits)) == (cost, letters)
    assert state in (conversations.START, conversations.ASSISTANT)


def test_costs_between_states():
    """Sixteen costs of a block are the prices when one state alone may end it."""
    rows = [("s", ""), ("u", "truncated"), ("a", ""), ("a", "blank")]
    layers = conversations._layers(rows)
    costs = conversations.costs(layers)
    assert costs[0] == 8 and costs[4 * conversations.ASSISTANT] >= conversations.NEVER
    # s kept, the rest deleted
    assert costs[conversations.SYSTEM] == 6
    # two blocks one after the other cost what the whole costs
    halves = conversations.costs(conversations._layers(rows[:2])), conversations.costs(conversations._layers(rows[2:]))
    for q in range(4):
        for r in range(4):
            assert min(costs[4 * q + r], conversations.NEVER) == min(min(halves[0][4 * q + m] + halves[1][4 * m + r] for m in range(4)), conversations.NEVER)


def test_query_equals_brute_force(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{TABLES}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.conversation_repair(spark, TABLES)) == expected(table)


def odd_rows():
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (1, None, "assistant", "So."), (1, None, "assistant", "So."), (1, 0, "user", "And so on"),
        (2, 5, "", "no role."), (2, 6, "unknown", "u."), (2, 9, "tool", "?"), (3, 1, "user", "x" * 300_000), (3, 1, "system", ""), (3, 1, "assistant", " \t\x1c"), (3, 2, "user", "İ。"),
        (4, -7, "assistant", "."), (4, -7, "assistant", ". \n"), (5, 1, None, "x."), (6, 3, "user", None),
    ]
    rng = random.Random(5)
    return rows + [(rng.randrange(10, 14), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "u", None]), rng.choice(["a.", "b", "c!", "", "d?"])) for _ in range(60)]


def as_table(spark, rows):
    """With columns that carry names of the operator's own."""
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.withColumns({n: F.lit("x") for n in ("conv", "block", "fault", "copy", "earlier", "state", "end", "kind", "at")})


def test_odd_rows(spark):
    rows = odd_rows()
    edits = conversations.repair(as_table(spark, rows), conv="conv_id")
    known = as_table(spark, rows).select(F.col("conv_id").alias("conv"))
    assert found(conversations.summary(edits, known)) == expected(rows, damage=False)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_do_not_change_results(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = odd_rows()
    edits = conversations.repair(as_table(spark, rows), conv="conv_id")
    known = as_table(spark, rows).select(F.col("conv_id").alias("conv"))
    assert found(conversations.summary(edits, known)) == expected(rows, damage=False)


def test_long_conversation_in_blocks(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "no", f"Number {k}."])) for k in range(600)]
    monkeypatch.setattr(conversations, "BLOCK", 50)
    edits = conversations.repair(as_table(spark, rows), conv="conv_id")
    known = as_table(spark, rows).select(F.col("conv_id").alias("conv"))
    assert found(conversations.summary(edits, known)) == expected(rows, damage=False)


def test_edits_are_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Bye.")]
    edits = conversations.repair(as_table(spark, rows)).orderBy("block", "at").collect()
    assert [(r.edit, r.fault, r.role_before, r.role, r.text, r.cost) for r in edits] == [
        ("R", "", "assistant", "user", "Hello.", 1), ("D", "duplicate", "assistant", "assistant", "Hello.", 2), ("R", "", "user", "assistant", "Bye.", 1)
    ]


def test_empty_table_and_lost_conversations(spark):
    none = as_table(spark, odd_rows()).limit(0)
    assert conversations.repair(none).count() == 0
    known = spark.createDataFrame([(1,), (None,)], "conv long")
    gone = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(conversations.summary(conversations.repair(none), known)) == {1: gone, None: gone}
