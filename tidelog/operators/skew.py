"""Cutting the rows of heavy keys into ordered chunks, for scans over segments.

A window partitioned by a key runs each key in one task, so a key that holds a third of the table
is the whole job's run time. The operators here partition by key and chunk instead. A chunk is a
contiguous stretch of the key's order, so neighbours can be found within the chunk; each chunk hands
one carry row (its borders, its count) to a second, tiny scan over the chunks of a key, and the
carries are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE = -1  # chunk number of rows that are not cut
LAST = 1 << 62

ROWS_PER_CHUNK = 1_000_000
DRAWS_PER_CHUNK = 64  # rows that are drawn, on average, of so many as a chunk may have
HEAVY = 2  # chunks' worth of rows from which on a key, or a value within it, is cut
FINER = 4  # cells to a chunk's worth of rows, so that uneven stretches still make small chunks
UNEVEN = 16  # how much finer than on average single values are cut


def split_hot_keys(
    rows: DataFrame,
    key: str,
    positions: Sequence[Column],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> tuple[DataFrame, list[str]]:
    """Add chunk numbers that rise along the order of each heavy key.

    ``positions`` are whole numbers that, compared from left to right, never fall along the order
    the caller uses within a key. Returns the frame and its two chunk columns, which compare from left
    to right too. A key in one piece carries ``WHOLE`` in both.

    Everything happens when the plan runs; nothing is collected and no job runs before. Rows are
    drawn by a hash of key and positions, ``DRAWS_PER_CHUNK`` in ``rows_per_chunk``, so every read
    draws the same rows. A key with ``HEAVY`` times ``rows_per_chunk`` rows or more by this draw is cut
    evenly along the first position. A value there that is heavy itself has chunks of its own, cut
    along the next position that differs (and the one after, where cells are as fine as single values).
    Rows that agree in all positions, or have no first one, cannot be told apart.

    The draw only chooses where to cut: every row stays in the result. What is broadcast has at most one
    entry for every ``HEAVY`` times ``rows_per_chunk`` rows, whatever the keys are.
    """
    names = [f"_position{n}" for n in range(len(positions))]
    placed = rows.select("*", *[p.cast("long").alias(name) for p, name in zip(positions, names, strict=True)])
    keys = F.broadcast(_heavy_keys(placed, key, names, rows_per_chunk))
    located = placed.join(keys, F.expr(f"`{key}` <=> _key"), "left").selectExpr(
        *[f"`{c}`" for c in placed.columns],
        "_low",
        "_span",
        "_cells",
        f"2L * size(filter(_values, v -> v.at < {names[0]})) AS _before",
        f"get(filter(_values, v -> v.at = {names[0]}), 0) AS _value",
    )
    chunks = {
        "_chunk0": f"CASE WHEN _cells IS NULL THEN {WHOLE}L WHEN _value IS NULL THEN _before ELSE _before + 1L END",
        "_chunk1": f"CASE WHEN _cells IS NULL THEN {WHOLE}L "
        f"WHEN _value IS NULL THEN {_cell(names[0], '_low', '_span', '_cells')} ELSE {_within_value(names[1:])} END",
    }
    return located.selectExpr(*[f"`{c}`" for c in rows.columns], *[f"{e} AS {c}" for c, e in chunks.items()]), list(chunks)


def _heavy_keys(placed: DataFrame, key: str, positions: Sequence[str], rows_per_chunk: int) -> DataFrame:
    """A row per key to cut: the edges of its first position, the number of cells, and the heavy values there."""
    every = max(1, rows_per_chunk // DRAWS_PER_CHUNK)
    listed = ", ".join([f"`{key}`", *positions])
    drawn = placed.selectExpr(f"`{key}`", *positions).where(f"pmod(xxhash64({listed}), {every}) = 0")

    first, rest = positions[0], positions[1:]
    edges = [f"struct(min({p}) AS low, max({p}) AS high, count_if({p} IS NULL) AS nulls) AS {p}" for p in rest]
    varied = [f"WHEN {p}.low < {p}.high OR ({p}.low IS NOT NULL AND {p}.nulls > 0) THEN {n}" for n, p in enumerate(rest)]
    along = f"CASE {' '.join(varied)} END" if rest else "cast(NULL AS int)"
    # Few rows are drawn, so both groupings may share one shuffle.
    values = drawn.repartition(F.col(key)).groupBy(key, first).agg(F.expr(f"count(*) * {every}").alias("_rows"), *map(F.expr, edges))
    values = values.selectExpr("*", f"{along} AS _along", f"ceil(_rows * {FINER} / {rows_per_chunk}) AS _cells")
    fields = ["_rows AS rows", "_along AS along", "_cells AS cells", *[f"{p}.low AS low{n}" for n, p in enumerate(rest)]]
    if rest:
        here, following = (f"get(array({', '.join(rest)}), _along + {step})" for step in (0, 1))
        span = "(cast({0}.high AS double) - cast({0}.low AS double) + 1)"
        finer = f"{span.format(here)} <= _cells AND {span.format(following)} > 1"
        fields += [
            f"{here}.low AS low",
            f"{here}.high AS high",
            f"{span.format(here)} AS span",
            # The position after counts only below single values, and if it is there and not the same everywhere.
            f"CASE WHEN {finer} THEN {following}.low END AS next_low",
            f"{span.format(following)} AS next_span",
            f"ceil(_cells / {span.format(here)}) * {UNEVEN} AS next_cells",
        ]
    heavy = f"{first} IS NOT NULL AND _rows >= {HEAVY * rows_per_chunk}"
    values = values.selectExpr(f"`{key}`", first, "_rows", f"CASE WHEN {heavy} THEN struct({first} AS at, {', '.join(fields)}) END AS _value")
    found = values.groupBy(F.col(key).alias("_key")).agg(
        F.sum("_rows").alias("_rows"), F.min(first).alias("_low"), F.max(first).alias("_high"), F.collect_list("_value").alias("_values")
    )
    return found.where(f"_rows >= {HEAVY * rows_per_chunk}").selectExpr(
        "_key",
        "_low",
        "cast(_high AS double) - cast(_low AS double) + 1 AS _span",
        f"ceil(_rows * {FINER} / {rows_per_chunk}) AS _cells",
        "_values",
    )


def _cell(at: str, low: str, span: str, cells: str) -> str:
    """Number of the cell, the outermost one beyond the edges of the rows drawn; a null counts as lowest."""
    return f"greatest(0L, least({cells} - 1, coalesce(floor((cast({at} AS double) - cast({low} AS double)) / {span} * {cells}), 0L)))"


def _within_value(positions: Sequence[str]) -> str:
    """Number of the cell within a heavy value; 0 and ``LAST`` are for rows beyond the edges of those drawn."""
    if not positions:
        return "0L"
    # Positions that were the same in all rows drawn may differ in others, which lie before or after all cells.
    others = [
        f"WHEN _value.along > {n} AND _value.low{n} IS NOT NULL AND ({p} IS NULL OR {p} < _value.low{n}) THEN 0L "
        f"WHEN _value.along > {n} AND {p} IS NOT NULL AND (_value.low{n} IS NULL OR {p} > _value.low{n}) THEN {LAST}L"
        for n, p in enumerate(positions)
    ]
    here, following = (f"get(array({', '.join(positions)}), _value.along + {step})" for step in (0, 1))
    # A single value's cells follow each other, so its number times their count and theirs is in order.
    return f"""CASE WHEN _value.along IS NULL THEN 0L {' '.join(others)}
        WHEN {here} IS NULL OR {here} < _value.low THEN 0L WHEN {here} > _value.high THEN {LAST}L
        WHEN _value.next_low IS NULL THEN 1L + {_cell(here, '_value.low', '_value.span', '_value.cells')}
        ELSE 1L + ({here} - _value.low) * _value.next_cells
             + {_cell(following, '_value.next_low', '_value.next_span', '_value.next_cells')} END"""
