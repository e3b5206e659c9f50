"""Repair of the structure of conversations: cheapest edits that give a legal order of roles.

The rows of a conversation and the four states of a legal order (nothing yet, after a system, user or assistant row)
make a lattice; an edit is an arc with a whole-number cost. Prices come from the auction algorithm for shortest paths:
a path grows from an origin along the cheapest arc; where no arc fits the price of its last node, that price rises and
the node leaves the path. Every node is an origin once, from the last row to the first, and a path ends at nodes that
earlier paths have settled, so the work is linear. Prices are then exact everywhere, the arcs that fit them (tight
arcs) are those of cheapest edits, and the trace takes the least letter among them.

A conversation is cut into blocks of ``BLOCK`` turns. Blocks are priced apart: costs between the states at both ends of
each block, then prices at the ends along the blocks, then the states in which the traces enter them. Only those few
numbers a block meet in one task, so a conversation of any length is the work of many.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.llm.common import stored

#: Turns in a block.
BLOCK = 16_384
#: Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that a changed or new row has in each state, and names of roles.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLES = ("", "system", "user", "assistant")
NEVER = 1 << 60
#: Prices after the last row: nothing at all, or an assistant's row at the end.
END = (0, NEVER, NEVER, 0)

Arc = tuple[str, int, int, int]


def _arcs(initial: str, fault: str, state: int) -> list[Arc]:
    """(edit, rows taken, next state, cost) of a row in a state, by letter."""
    wanted = _NEXT[state]
    arcs = [("D", 1, state, DELETE), ("I", 0, wanted, INSERT)]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        if initial == "sua"[wanted - 1] or (initial == "s" and state == START):
            arcs.append(("K", 1, SYSTEM if initial == "s" else wanted, more))
        arcs.append(("R", 1, wanted, REROLE + more))
    return arcs


_OF_ROW = {(i, f): [_arcs(i, f, q) for q in range(4)] for i in ("s", "u", "a", "") for f in ("", "blank", "duplicate", "truncated")}
_AT_END = [[("I", 0, _NEXT[q], INSERT)] for q in range(4)]


def _layers(rows: Sequence[tuple[str, str]]) -> list[list[list[Arc]]]:
    """Arcs by row and state; after the last row only new rows are left."""
    return [*(_OF_ROW[i if i in ("s", "u", "a") else "", f] for i, f in rows), _AT_END]


def settle(layers: Sequence[Sequence[Sequence[Arc]]], end: Sequence[int]) -> list[int]:
    """Exact price (cost of the cheapest way to the end) of every node ``4 * row + state``; NEVER if there is none.

    ``end`` has the price of each state after the last row.
    """
    last = len(layers) - 1
    price, settled = [0] * (4 * last + 4), [False] * (4 * last + 4)
    # from a user's or assistant's state none of the first two can be reached again
    if end[USER] >= NEVER and end[ASSISTANT] >= NEVER:
        for node in range(len(price)):
            if node % 4 > (START if end[SYSTEM] >= NEVER else SYSTEM):
                price[node], settled[node] = NEVER, True
    for origin in (4 * row + q for row in range(last, -1, -1) for q in range(4)):
        path = [origin]
        while not settled[path[-1]]:
            node = path[-1]
            row, state = divmod(node, 4)
            best, to = (end[state], None) if row == last else (NEVER, None)
            for _, taken, then, cost in layers[row][state]:
                head = 4 * (row + taken) + then
                if cost + price[head] < best:
                    best, to = cost + price[head], head
            if best >= NEVER:
                price[node], settled[node] = NEVER, True
                if len(path) > 1:
                    path.pop()
            elif price[node] < best:
                # contraction
                price[node] = best
                if len(path) > 1:
                    path.pop()
            elif to is None:
                break
            else:
                # extension
                path.append(to)
        for node in path:
            settled[node] = True
    return price


def trace(layers: Sequence[Sequence[Sequence[Arc]]], price: Sequence[int], end: Sequence[int], state: int) -> tuple[list[tuple[str, int, int]], int]:
    """The least sequence of cheapest edits (letter, row, state after it), and the state in which it ends."""
    row, last, edits = 0, len(layers) - 1, []
    while not (row == last and end[state] == price[4 * row + state]):
        here = price[4 * row + state]
        letter, taken, then, _ = next(a for a in layers[row][state] if a[3] + price[4 * (row + a[1]) + a[2]] == here)
        edits.append((letter, row, then))
        row, state = row + taken, then
    return edits, state


def costs(layers: Sequence[Sequence[Sequence[Arc]]]) -> list[int]:
    """Costs from each state before a block to each state after it, 16 numbers."""
    ends = [settle(layers, [0 if q == r else NEVER for q in range(4)]) for r in range(4)]
    return [ends[r][q] for q in range(4) for r in range(4)]


# Spark


def with_faults(frame: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, block, turn, role, text, copy, fault): the rows of conversations with the first fault of each.

    Faults: ``blank`` (nothing but blanks), ``duplicate`` (role and text stood earlier in the conversation),
    ``truncated`` (the last character before blanks is none of ``.!?``), else empty. Rows stand by turn (null first),
    then role, then text. A null role or text is one blank. A null conversation is one of its own.
    """
    given = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(" "))
    rows = frame.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), given(role).alias("role"), given(text).alias("text"))
    # rows alike in everything are counted before they are shuffled
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("turn").isNotNull(), "turn")
    first = rows.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t")).agg(F.min(place).alias("first"))
    # turns are neither counted nor drawn: a conversation's block is given by its turn alone
    rows = rows.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t")))
    rows = rows.withColumn("earlier", F.struct(F.col("turn").isNotNull(), "turn") != F.col("first"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    end = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    fault = F.when(end == "", "blank").when(F.col("earlier") | (F.col("copy") > 1), "duplicate").when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    return rows.select("conv", F.expr(f"turn div {BLOCK}").alias("block"), "turn", "role", "text", "copy", fault.alias("fault"))


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows that agree in their first columns."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return groupby(rows, key=lambda row: row[:keys])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _packed(rows: Iterable[tuple], schema: pa.Schema, at_once: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield _table(held, schema)
            held = []
    if held:
        yield _table(held, schema)


def _map(frame: DataFrame, made: pa.Schema, spark_schema: str, keys: int, work: Any) -> DataFrame:
    """``work(key, rows)`` gives rows for every run of equal keys."""

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed((out for key, rows in _groups(batches, keys) for out in work(key, rows)), made)

    return frame.mapInArrow(every, spark_schema)


def _types(frame: DataFrame) -> tuple[str, pa.DataType]:
    kind = frame.schema["conv"].dataType
    return kind.simpleString(), to_arrow_type(kind)


_ORDER = ["conv", "block", "turn", "role", "text", "copy"]
_LONGS = pa.list_(pa.int64())


def _borders(rows: DataFrame, conv: pa.DataType, kind: str) -> DataFrame:
    """(conv, block, state, end) for the blocks of conversations that have several: the state before, the prices after."""
    several = rows.groupBy("conv").agg(F.min(F.struct(F.col("block").isNotNull(), "block")).alias("low"), F.max(F.struct(F.col("block").isNotNull(), "block")).alias("high"))
    several = several.where("low <> high").select(F.col("conv").alias("long"))
    narrow = rows.withColumn("initial", F.substring("role", 1, 1))
    narrow = narrow.join(several, F.col("conv").eqNullSafe(F.col("long")), "left_semi")
    # by the same order as the trace
    dealt = narrow.repartition("conv", "block").sortWithinPartitions(*_ORDER).select("conv", "block", "initial", "fault")

    def between(key: tuple, inside: Iterator[tuple]) -> Iterator[tuple]:
        yield (*key, costs(_layers([r[2:4] for r in inside])))

    def backwards(key: tuple, blocks: Iterator[tuple]) -> Iterator[tuple]:
        matrices = [r[1:3] for r in blocks]
        # the same auction over the ends of blocks: an arc for each pair of states
        layers = [[[("", 1, r, m[4 * q + r]) for r in range(4) if m[4 * q + r] < NEVER] for q in range(4)] for _, m in matrices]
        price = settle([*layers, [[], [], [], []]], END)
        for k, (block, _) in enumerate(matrices):
            yield (*key, block, price[4 * k + 4 : 4 * k + 8])

    def leaving(key: tuple, inside: Iterator[tuple]) -> Iterator[tuple]:
        taken = list(inside)
        layers, end = _layers([r[2:4] for r in taken]), taken[0][4]
        price = settle(layers, end)
        yield (*key, end, [trace(layers, price, end, q)[1] if price[q] < NEVER else START for q in range(4)])

    def forwards(key: tuple, blocks: Iterator[tuple]) -> Iterator[tuple]:
        state = START
        for _, block, end, exits in blocks:
            yield (*key, block, state, end)
            state = exits[state]

    schema = lambda *more: pa.schema([("conv", conv), ("block", pa.int64()), *more])
    by_conv = lambda frame: frame.repartition("conv").sortWithinPartitions("conv", "block")
    matrices = _map(dealt, schema(("costs", _LONGS)), f"conv {kind}, block long, costs array<long>", 2, between)
    ends = _map(by_conv(matrices), schema(("end", _LONGS)), f"conv {kind}, block long, end array<long>", 1, backwards)
    ends = ends.select(F.col("conv").alias("c"), F.col("block").alias("b"), "end")
    priced = narrow.join(ends, F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    priced = priced.repartition("conv", "block").sortWithinPartitions(*_ORDER).select("conv", "block", "initial", "fault", "end")
    exits = _map(priced, schema(("end", _LONGS), ("exits", _LONGS)), f"conv {kind}, block long, end array<long>, exits array<long>", 2, leaving)
    found = schema(("state", pa.int32()), ("end", _LONGS))
    return _map(by_conv(exits), found, f"conv {kind}, block long, state int, end array<long>", 1, forwards)


def repair(frame: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits of all conversations, one row each, cheapest in sum and least by letters among those.

    Columns: conv, block and ``at`` (its place: by block, then at), turn, edit (Keep, Rerole, Delete, Insert by their
    initials), fault, role_before, role, text, cost. A repaired conversation is its rows but those of edit D; their
    roles are nothing, or an optional system row and then user and assistant in turn. Roles count by their first
    letter; a row with another letter or an empty role must be given a role or go. New rows have no turn and no text.

    Rows stand by turn (null first), then role and text; repeated rows are duplicates and go. A null role or text is one
    blank, a null conversation one of its own. Other columns are left out; an empty table gives an empty table.
    """
    rows = stored(with_faults(frame, conv, turn, role, text), "turns")
    kind, arrow = _types(rows)
    borders = _borders(rows, arrow, kind).select(F.col("conv").alias("c"), F.col("block").alias("b"), "state", "end")
    rows = rows.join(borders, F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")), "left")
    dealt = rows.repartition("conv", "block").sortWithinPartitions(*_ORDER).select("conv", "block", "turn", "role", "text", "fault", "state", "end")

    def edits(key: tuple, inside: Iterator[tuple]) -> Iterator[tuple]:
        taken = list(inside)
        state, end = (START, END) if taken[0][6] is None else taken[0][6:8]
        layers = _layers([(r[3][:1], r[5]) for r in taken])
        price = settle(layers, end)
        for at, (letter, row, then) in enumerate(trace(layers, price, end, state)[0]):
            if letter == "I":
                yield (*key, at, None, letter, "", None, _ROLES[then], "", INSERT)
                continue
            _, _, when, before, content, fault, _, _ = taken[row]
            cost = {"K": 0, "R": REROLE, "D": DELETE}[letter] + (TRUNCATED if fault == "truncated" and letter != "D" else 0)
            yield (*key, at, when, letter, fault, before, _ROLES[then] if letter == "R" else before, content, cost)

    text_field = lambda *names: [(n, pa.string()) for n in names]
    made = pa.schema([("conv", arrow), ("block", pa.int64()), ("at", pa.int64()), ("turn", pa.int64()), *text_field("edit", "fault", "role_before", "role", "text"), ("cost", pa.int64())])
    return _map(dealt, made, f"conv {kind}, block long, at long, turn long, edit string, fault string, role_before string, role string, text string, cost long", 2, edits)


def summary(edits: DataFrame, known: DataFrame) -> DataFrame:
    """One row per conversation of ``known`` (column conv): counts of faults, cost, edits and a hash of the result.

    gaps: turns that lack between the first and the last; illegal: neighbours whose roles may not follow each other.
    Rows are hashed one by one, so that memory does not grow with a conversation; only its letters are held.
    """
    names = ["turn", "edit", "fault", "role_before", "role", "text", "cost"]
    # a row without an edit opens every conversation, also those that have no rows left
    opening = known.select("conv").distinct().select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("at"), *[F.lit(None).cast(edits.schema[n].dataType).alias(n) for n in names])
    rows = opening.unionByName(edits.select("conv", F.lit(1).alias("kind"), "block", "at", *names))
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "kind", "block", "at").select("conv", *names)
    kind, arrow = _types(edits)

    def one(key: tuple, inside: Iterator[tuple]) -> Iterator[tuple]:
        count, cost, turns, illegal = {"blank": 0, "duplicate": 0, "truncated": 0}, 0, 0, 0
        low = high = before = None
        letters, joined, mark = [], hashlib.sha256(), b""
        for _, turn, edit, fault, was, role, content, price in inside:
            if edit is None:
                continue
            letters.append(edit)
            cost += price
            if edit != "I":
                if fault:
                    count[fault] += 1
                if before is not None and before[:1] + was[:1] not in ("su", "ua", "au"):
                    illegal += 1
                before = was
                if turn is not None and turn != high:
                    low, high, turns = turn if low is None else low, turn, turns + 1
            if edit != "D":
                joined.update(mark + f"{role}:{content}".encode())
                mark = b"\n"
        gaps = 0 if low is None else high - low + 1 - turns
        yield (*key, gaps, *count.values(), illegal, cost, "".join(letters), joined.hexdigest())

    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    made = pa.schema([("conv", arrow), *[(n, pa.int64()) for n in longs], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return _map(dealt, made, f"conv {kind}, {', '.join(f'{n} long' for n in longs)}, audit string, repaired_sha256 string", 1, one)


def damaged(frame: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of ``conv_id:turn``: rows dropped, emptied, cut short, repeated, or of role user.

    Nulls count as one blank, in the checksum too.
    """
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn"))) % 20
    rows = frame.select("conv_id", "turn", given("role").alias("role"), given("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text: Column = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
    return rows.withColumn("nth", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("kind", "nth")
