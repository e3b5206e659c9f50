"""Near duplicates by SimHash: pigeonhole blocks, exact check of the distance, connected classes.

Two 64-bit fingerprints that differ in at most ``bits`` bits, cut into ``blocks`` blocks, agree in at least
``blocks - bits`` whole blocks. Every choice of that many blocks is a key, so each close pair shares a key. Equal
fingerprints are one node before anything is paired. In a cell (the nodes that share a key) close nodes are found by
walking from node to node, so a cell gives a spanning forest of its links and never all pairs of a class; larger
cells are cut into parts, and every two parts meet in a cell of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import connected, packed, stored, unpacked

SHINGLE, BITS, BLOCKS = 3, 3, 6
#: Nodes in one part of a cell, about; the same where built-in functions walk it.
PART, BUILT_IN_PART = 2048, 1024
_WORD = regex.compile(rb"[^\x20\x09-\x0D]+")
#: Hashes counted at once.
_SLICE = 1 << 14
_SHIFTS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of word shingles, repeats included; zero without words."""
    words = _WORD.findall((text or "").encode("utf-8", "replace").lower())
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _SLICE):
        part = np.array(hashes[k : k + _SLICE], np.uint64)
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int((np.uint64(1) << _SHIFTS[ones * 2 > len(hashes)]).sum(dtype=np.uint64))


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long (the same 64 bits, signed)."""

    def every(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            values = np.array([fingerprint(x if isinstance(x, str) else None, shingle) for x in texts], np.uint64)
            yield pd.Series(values.view(np.int64))

    every.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(every, "long").asNondeterministic()(text)


def with_fingerprints(frame: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """The columns of the frame but ``text``, and ``fp`` as by ``fingerprints``; in built-in functions.

    A row per shingle, added up where it is made: two bits of the hash are counted in one long. Repeated rows stay.
    """
    others = [c for c in frame.columns if c != text]
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = frame.select(*others, F.monotonically_increasing_id().alias("_row"), F.array_remove(F.split(lower, r"[\x20\x09-\x0D]+"), "").alias("_words"))
    shingles = words.select(*others, "_row", "_words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("_words") - shingle, F.lit(0)))).alias("_at"))
    # of fewer words than a shingle the missing ones are null and left out
    text_of = F.concat_ws(" ", *[F.get("_words", F.col("_at") + k) for k in range(shingle)])
    hashes = shingles.select(*others, "_row", F.when(F.size("_words") > 0, F.xxhash64(text_of)).otherwise(0).alias("_h"))
    counts = [F.sum(F.shiftrightunsigned("_h", k).bitwiseAND(F.lit((1 << 32) + 1))).alias(f"_c{k}") for k in range(32)]
    counted = hashes.groupBy("_row", *others).agg(F.count("*").alias("_n"), *counts)
    ones = lambda b: F.shiftrightunsigned(f"_c{b % 32}", b - b % 32).bitwiseAND(F.lit((1 << 32) - 1))
    bits = [F.when(ones(b) * 2 > F.col("_n"), F.lit((1 << b) - ((1 << 64) if b == 63 else 0))).otherwise(F.lit(0).cast("long")) for b in range(64)]
    return counted.select(*others, reduce(Column.bitwiseOR, bits).alias("fp"))


def block_keys(value: Column, bits: int = BITS, blocks: int = BLOCKS) -> Column:
    """Array of (choice, key): for each choice of blocks - bits blocks the bits of the value in them."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - bits):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[F.struct(F.lit(k).alias("choice"), value.bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)])


def forest(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (from, to) that connect what is connected by distances of at most ``bits``."""
    links, left = [], np.arange(len(values))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= bits
            if near.any():
                links += [(at, x) for x in left[near]]
                queue += left[near].tolist()
                left = left[~near]
    return links


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def forest_links(values: Column, bits: int) -> Column:
    """``forest`` of an array of distinct longs in built-in functions: an array of (a, b)."""

    def step(state: Column, _: Column) -> Column:
        waits = F.size(state["queue"]) > 0
        rest = F.when(waits, state["rest"]).otherwise(F.slice(state["rest"], 2, F.greatest(F.size(state["rest"]) - 1, F.lit(0))))
        queue = F.slice(state["queue"], 2, F.greatest(F.size(state["queue"]) - 1, F.lit(0)))
        close = lambda at: lambda y: F.bit_count(y.bitwiseXOR(at)) <= bits
        met = lambda at, near, rest: F.struct(
            F.array_except(rest, near).alias("rest"),
            F.concat(queue, near).alias("queue"),
            F.concat(state["links"], F.transform(near, lambda y: F.struct(F.least(at, y).alias("a"), F.greatest(at, y).alias("b")))).alias("links"),
        )
        at = F.coalesce(F.get(state["queue"], F.lit(0)), F.get(state["rest"], F.lit(0)))
        return _let(at, lambda at: _let(rest, lambda rest: _let(F.filter(rest, close(at)), lambda near: met(at, near, rest))))

    begin = F.struct(values.alias("rest"), F.array().cast("array<bigint>").alias("queue"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("links"))
    # after all values but one have been compared with the rest, no link is left
    return F.aggregate(F.slice(values, 2, F.size(values)), begin, step, lambda state: state["links"])


def close_links(nodes: DataFrame, bits: int = BITS, blocks: int = BLOCKS, part: int = PART, built_in: bool = False) -> DataFrame:
    """Links (a, b) of distinct longs ``fp`` that connect all values within ``bits`` bits of one another.

    With ``built_in`` the cells are walked by built-in functions, which is slower than in Python.
    """
    keyed = nodes.select("fp", F.explode(block_keys(F.col("fp"), bits, blocks)).alias("k")).select("fp", "k.choice", "k.key")
    crowds = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    placed = keyed.join(crowds, ["choice", "key"])
    placed = placed.withColumn("parts", F.ceil(F.col("n") / part).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    placed = placed.withColumn("mine", mine)
    # a part meets every part: cells (i, j) with i <= j
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("choice", "key", F.least("mine", "other"), F.greatest("mine", "other"))
    cells = placed.select(cell.alias("cell"), "choice", "key", "fp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    if built_in:
        walked = cells.groupBy("cell", "choice", "key", "i", "j").agg(F.collect_list("fp").alias("fps"))
        links = walked.select(F.explode(forest_links(F.col("fps"), bits)).alias("l"))
        return links.select("l.a", "l.b").distinct()
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "choice", "key", "i", "j", "fp")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = {c: batch[c].to_numpy(zero_copy_only=False) for c in ("cell", "choice", "key", "i", "j", "fp")}
            if rest is not None:
                table = {c: np.concatenate([rest[c], table[c]]) for c in table}
            n = len(table["fp"])
            if not n:
                continue
            differs = np.zeros(n, bool)
            for c in ("cell", "choice", "key", "i", "j"):
                differs[1:] |= table[c][1:] != table[c][:-1]
            starts = np.flatnonzero(differs)
            last = starts[-1] if len(starts) else 0
            yield from _linked(table["fp"][:last], np.r_[0, starts] if last else starts, bits)
            rest = {c: table[c][last:] for c in table}
        if rest is not None:
            yield from _linked(rest["fp"], np.array([0]), bits)

    return dealt.mapInArrow(walk, "a long, b long").distinct()


def _linked(values: np.ndarray, starts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Links of the cells that begin at starts."""
    if not len(values):
        return
    unsigned = values.astype(np.int64).view(np.uint64)
    starts = starts[starts < len(values)]
    sizes = np.diff(np.r_[starts, len(values)])
    pairs = starts[sizes == 2]
    pairs = pairs[np.bitwise_count(unsigned[pairs] ^ unsigned[pairs + 1]) <= bits]
    a, b = [pairs], [pairs + 1]
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        if links := forest(unsigned[s : s + n], bits):
            found = np.array(links) + s
            a.append(found[:, 0])
            b.append(found[:, 1])
    x, y = values[np.concatenate(a)], values[np.concatenate(b)]
    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def near_duplicates(frame: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS, blocks: int = BLOCKS) -> DataFrame:
    """A row per row of the frame: its id, fingerprint (16 hex digits) and component_id.

    Texts are lower-cased in A-Z; words are runs of anything but blanks and the controls 9 to 13; a text of fewer
    words than a shingle is one shingle. Null, empty and blank texts have fingerprint zero and link like any other.
    component_id is the smallest id that can be reached over links of at most ``bits`` bits; null if all ids there are
    null. Repeated ids and rows come back as often as they are given. An empty table gives an empty table.
    """
    marked = stored(frame.select(F.col(f"`{id_column}`").alias("id"), fingerprints(F.col(f"`{text}`"), shingle).alias("fp")), "simhash")
    classes = component_of(marked, bits, blocks)
    return marked.join(classes, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def component_of(marked: DataFrame, bits: int = BITS, blocks: int = BLOCKS, built_in: bool = False) -> DataFrame:
    """(fp, root, component) for each distinct fp of ``marked`` (id, fp): its class, and the smallest id there."""
    nodes = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    links = close_links(nodes, bits, blocks, BUILT_IN_PART, built_in=True) if built_in else close_links(nodes, bits, blocks)
    roots = connected(links).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return stored(rooted.join(least, "root").select("fp", "root", "component"), "simhash-classes")


def classes_of_texts(frame: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(text_hash, component): for the hash of each text the smallest id in its class of near duplicates.

    In built-in functions alone. Only ids, hashes and counts of bits are stored and shuffled. Classes without any id are left
    out; an empty table gives an empty table.
    """
    content = F.col(f"`{text}`")
    rows = frame.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(content).alias("text_hash"), content.alias("content"))
    marked = stored(with_fingerprints(rows, "content", shingle), "simhash")
    classes = component_of(marked, bits, built_in=True).where("component IS NOT NULL").select("fp", "component")
    texts = marked.groupBy("text_hash").agg(F.min("fp").alias("fp"))
    return stored(texts.join(classes, "fp").select("text_hash", "component"), "simhash-texts")


def keep_one(frame: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row of each class of near duplicates, with all its columns: the one that has the smallest id.

    Of rows that share this id and the class, the one with the smallest text hash stays; of rows that agree in that too,
    one. Where no row of a class has an id, one of them stays by the same rule. An empty table gives an empty table.
    """
    ident, content = F.col(f"`{id_column}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = stored(frame.select(ident.alias("id"), F.xxhash64(content).alias("th"), fingerprints(content, shingle).alias("fp")), "simhash")
    classes = component_of(marked, bits)
    kept = marked.join(classes, "fp").where(F.col("id").eqNullSafe(F.col("component")))
    kept = stored(kept.groupBy("root", "id").agg(F.min("th").alias("th")).select("id", "th"), "simhash-kept")
    rows = frame.select(packed(frame), ident.alias("id"), F.xxhash64(content).alias("th"))
    rows = rows.join(kept, rows["id"].eqNullSafe(kept["id"]) & (rows["th"] == kept["th"]), "left_semi")
    return rows.groupBy("id", "th").agg(F.first("row").alias("row")).select(*unpacked(frame.columns))
