"""Pairing start events with end events of the same key."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidelog.functions.time import seconds_between, time_positions
from tidelog.operators.skew import ROWS_PER_CHUNK, WHOLE, split_hot_keys


def adjacent_pairs(
    events: DataFrame,
    key: str,
    time: str,
    is_start: Column,
    is_end: Column,
    tie_break: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Starts whose directly following event of the same key is an end.

    Only starts and ends count as events: anything else is dropped before "following" is decided.
    Of two starts in a row the first is left out, and so is an end without a start. ``tie_break``
    orders events with equal times; where it does not decide either, ends come first. Result: key,
    ``start_time``, ``end_time``, ``seconds``.

    One shuffle, on key and chunk, of the columns needed. The rows of a heavy key are cut into chunks
    (``split_hot_keys``), and only the borders of chunks are compared along the key.
    """
    marked = events.select(key, time, *tie_break, is_start.alias("_start"), is_end.alias("_end")).where(
        F.col("_start") | F.col("_end")
    )
    whole_numbers = itertools.takewhile(lambda c: isinstance(marked.schema[c].dataType, IntegralType), tie_break)
    positions = [*time_positions(marked, time), *map(F.col, whole_numbers)]
    rows, chunks = split_hot_keys(marked, key, positions, rows_per_chunk)

    along = Window.partitionBy(key, *chunks).orderBy(*_event_order(time, tie_break))
    within = (
        rows.withColumn("_next_time", F.lead(time).over(along))
        .withColumn("_next_end", F.lead("_end").over(along))
        .where(F.col("_start") & F.col("_next_end"))
        .select(key, F.col(time).alias("start_time"), F.col("_next_time").alias("end_time"))
    )
    pairs = within.unionByName(_pairs_across_chunks(rows, key, chunks, time, tie_break))
    return pairs.withColumn("seconds", seconds_between(pairs, "start_time", "end_time"))


def _event_order(time: str, tie_break: Sequence[str]) -> list[str]:
    return [time, *tie_break, "_start", "_end"]


def _pairs_across_chunks(
    rows: DataFrame, key: str, chunks: Sequence[str], time: str, tie_break: Sequence[str]
) -> DataFrame:
    """Pairs whose start closes one chunk and whose end opens the next.

    Each task reduces its rows to a first and a last event per chunk before the shuffle, so the
    window sees one row per chunk.
    """
    event = F.struct(*_event_order(time, tie_break))
    along = Window.partitionBy(key).orderBy(*chunks)
    return (
        rows.where(F.col(chunks[0]) != WHOLE)
        .groupBy(key, *chunks)
        .agg(F.min(event).alias("first"), F.max(event).alias("last"))
        .withColumn("following", F.lead("first").over(along))
        .where(F.col("last._start") & F.col("following._end"))
        .select(
            key,
            F.col("last").getField(time).alias("start_time"),
            F.col("following").getField(time).alias("end_time"),
        )
    )


def ordinal_pairs(
    events: DataFrame,
    key: str,
    order: Sequence[str],
    positions: Sequence[Column],
    is_start: Column,
    is_end: Column,
    on: Sequence[str] = (),
    carry: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """The n-th start of a key with its n-th end, where the ``on`` columns agree too.

    Starts and ends are numbered separately, so one start that never ended shifts every later pair
    of its key. Rows with a null key pair with nothing. ``positions`` are whole numbers that follow
    ``order`` (see ``split_hot_keys``). Result: key, ``ordinal``, the ``on``
    columns, and each ``carry`` column twice (``start_…``, ``end_…``).

    Keys in one piece: starts and ends are numbered and brought together after one shuffle, without a join.
    Keys that are cut: numbers within a chunk, plus the rows of earlier chunks, joined back; then starts and ends meet by
    ``(key, ordinal)``, which spreads evenly however the keys do. Without a heavy key nothing of this runs.
    """
    light, heavy = ordinal_pairs_apart(events, key, order, positions, is_start, is_end, on, carry, rows_per_chunk)
    return light.unionByName(heavy)


def ordinal_pairs_apart(
    events: DataFrame,
    key: str,
    order: Sequence[str],
    positions: Sequence[Column],
    is_start: Column,
    is_end: Column,
    on: Sequence[str] = (),
    carry: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """``ordinal_pairs`` of the keys in one piece, which lie by key, and of the keys that are cut, which do not."""
    needed = list(dict.fromkeys([*order, *on, *carry]))
    marked = events.select(key, *needed, is_start.alias("_start"), is_end.alias("_end")).where(
        (F.col("_start") | F.col("_end")) & F.col(key).isNotNull()
    )
    rows, chunks = split_hot_keys(marked, key, positions, rows_per_chunk)
    kinds = F.filter(F.array(F.when(F.col("_start"), False), F.when(F.col("_end"), True)), lambda kind: kind.isNotNull())
    kept = rows.withColumn("_is_end", F.explode(kinds)).select(key, "_is_end", *chunks, *needed)
    whole = F.col(chunks[0]) == WHOLE
    # The rows stay where repartition puts them: windows and groups need nothing but equal keys in one place.
    along = Window.partitionBy(key, "_is_end").orderBy(*order)
    light = kept.where(whole).repartition(key).withColumn("ordinal", F.row_number().over(along).cast("long"))
    heavy = _number(kept.where(~whole), [key, "_is_end"], chunks, order)
    return _meet(light, key, on, carry), _meet(heavy, key, on, carry)


def _meet(numbered: DataFrame, key: str, on: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """A start and an end of one number meet in a group of their own, so large keys spread over many groups."""
    for name in on:
        numbered = numbered.where(F.col(name).isNotNull())
    carried = F.struct(F.lit(True).alias("_there"), *carry)
    sides = {"start": ~F.col("_is_end"), "end": F.col("_is_end")}
    return (
        numbered.groupBy(key, "ordinal", *on)
        .agg(*[F.first(F.when(of_side, carried), ignorenulls=True).alias(f"_{side}_row") for side, of_side in sides.items()])
        .where("_start_row IS NOT NULL AND _end_row IS NOT NULL")
        .select(key, "ordinal", *on, *[F.col(f"_{side}_row").getField(c).alias(f"{side}_{c}") for side in sides for c in carry])
    )


def _number(rows: DataFrame, keys: Sequence[str], chunks: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Running number from 1 within the keys: number within the chunk plus rows in earlier chunks."""
    local = F.row_number().over(Window.partitionBy(*keys, *chunks).orderBy(*order))
    earlier = Window.partitionBy(*keys).orderBy(*chunks).rowsBetween(Window.unboundedPreceding, -1)
    # The carry of a chunk is its count. Numbered rows already lie by key and chunk, so only the carries move.
    carries = (
        rows.groupBy(*keys, *chunks)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, *chunks, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return rows.withColumn("_local", local).join(carries, [*keys, *chunks]).withColumn(
        "ordinal", F.col("_local").cast("long") + F.col("_before")
    )
