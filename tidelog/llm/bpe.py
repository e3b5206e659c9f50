"""Byte-level BPE encoding and decoding by a given rank file.

A text is cut by the pattern; each match is merged on its own. A segment tree over the byte positions of a match holds
the pair ranks, its root the smallest one furthest left. A merge changes three leaves, so it costs three logarithmic
updates, and a match of n bytes O(n log n) in all.

Matches repeat, so each worker keeps the ids of those it has met lately. New short ones are merged together: their
trees are rows of one array, and each step makes one merge in every row that still has one.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Matches kept with their ids in each Python worker; the longest match, in bytes, that is kept and merged with others.
CACHED, SHORT = 300_000, 64
#: Characters of text worked on at once, and matches merged at once.
SLICE, TOGETHER = 1 << 20, 1 << 13
_NONE = 1 << 62


class Vocabulary:
    """Ranks of byte strings, and the pattern that cuts texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        self._ready = False

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pattern": self.pattern, "_ready": False}

    def _prepare(self) -> None:
        if self._ready:
            return
        # \s of the rank files' pattern is the property White_Space, which leaves out the separators 1C to 1F
        self._find = regex.compile(self.pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        ranks = self.ranks
        self._bytes = {v: k for k, v in ranks.items()}
        self._single = np.array([ranks.get(bytes([k]), -1) for k in range(256)], np.int64)
        self._width = max(ranks.values(), default=0) + 2
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left * self._width + right] = rank
        self._pairs = np.array([*sorted(pairs), _NONE], np.int64)
        self._merged = np.array([*(pairs[k] for k in sorted(pairs)), 0], np.int64)
        self._seen: dict[str, bytes] = {}
        self._ready = True

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_many([text])[0], np.int32).tolist()

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as 32-bit numbers one after another."""
        self._prepare()
        cut = [self._find(x) if x else [] for x in texts]
        words = set().union(*cut)
        new = list(words.difference(self._seen))
        if len(self._seen) + len(new) > CACHED:
            # what this slice holds is what comes up most
            self._seen = {w: self._seen[w] for w in words.intersection(self._seen)}
        seen = self._seen
        pieces = [w.encode("utf-8", "replace") for w in new]
        long, short = {}, []
        for word, piece, whole in zip(new, pieces, map(self.ranks.get, pieces), strict=True):
            if whole is not None:
                seen[word] = whole.to_bytes(4, sys.byteorder)
            elif len(piece) <= SHORT:
                short.append((len(piece), piece, word))
            else:
                long[word] = np.array(merge(piece, self.ranks), np.int32).tobytes()
        short.sort()
        for k in range(0, len(short), TOGETHER):
            part = short[k : k + TOGETHER]
            flat, ends = self._merge_together([x[1] for x in part])
            begin = 0
            for (_, _, word), end in zip(part, ends, strict=True):
                seen[word] = flat[begin:end]
                begin = end
        if long:
            seen = seen | long
        return [b"".join(map(seen.__getitem__, w)) for w in cut]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or ``_NONE``."""
        key = left * self._width + right
        at = np.searchsorted(self._pairs, key)
        return np.where(self._pairs[at] == key, self._merged[at], _NONE)

    def _merge_together(self, pieces: list[bytes]) -> tuple[bytes, list[int]]:
        """Ids of all matches one after another, and where each ends: a row of arrays per match, with a segment tree of its own."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        size = 1 << max(1, int(lengths.max()) - 1).bit_length()
        rows = np.arange(len(pieces))
        inside = np.arange(size) < lengths[:, None]
        ids = np.full((len(pieces), size + 1), self._width - 1, np.int64)
        ids[:, :size][inside] = self._single[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, size + 2, dtype=np.int32), (len(pieces), 1))
        before = np.tile(np.arange(-1, size, dtype=np.int32), (len(pieces), 1))
        # rank and position in one number: the least is the leftmost of the lowest rank; places past the end pair with none
        tree = np.full((len(pieces), 2 * size), _NONE, np.int64)
        ranks = self._rank(ids[:, : size - 1], ids[:, 1:size])
        known = (ranks != _NONE) & inside[:, 1:]
        tree[:, size : 2 * size - 1] = np.where(known, ranks * size + np.arange(size - 1), _NONE)
        level = size
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])

        flat_tree = tree.reshape(-1)

        def put(row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            begin = row * (2 * size)
            at = at + size
            flat_tree[begin + at] = value
            for _ in range(size.bit_length() - 1):
                at = at >> 1
                below = begin + 2 * at
                flat_tree[begin + at] = np.minimum(flat_tree[below], flat_tree[below + 1])

        live = np.ones((len(pieces), size), bool) & inside
        row = rows[tree[:, 1] != _NONE]
        while len(row):
            least = tree[row, 1]
            left = least % size
            right = after[row, left]
            ids[row, left] = least // size
            live[row, right] = False
            following = after[row, right]
            after[row, left] = following
            ends = following >= lengths[row]
            more = ~ends
            before[row[more], following[more]] = left[more]
            previous = before[row, left]
            has = previous >= 0
            rank = self._rank(
                np.concatenate([ids[row, left], ids[row[has], previous[has]]]),
                np.concatenate([ids[row, np.minimum(following, size)], ids[row[has], left[has]]]),
            )
            rank[: len(row)][ends] = _NONE
            spot = np.concatenate([left, previous[has]])
            value = np.where(rank == _NONE, _NONE, rank * size + spot)
            # the leaves first; then the way up from all of them, level by level
            put(np.concatenate([row, row[has], row]), np.concatenate([spot, right]), np.concatenate([value, np.full(len(row), _NONE)]))
            row = row[tree[row, 1] != _NONE]
        return ids[:, :size][live].astype(np.int32).tobytes(), (4 * np.cumsum(live.sum(1))).tolist()

    def decode(self, ids: list[int]) -> bytes:
        self._prepare()
        return b"".join(map(self._bytes.__getitem__, ids))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: the pair of lowest rank, leftmost first, is merged until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << max(0, n - 1).bit_length()
    tree = [_NONE] * (2 * size)
    part = [piece[k : k + 1] for k in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def rank(left: int, right: int) -> int:
        # rank and position in one number: the least is the leftmost of the lowest rank
        found = ranks.get(part[left] + part[right]) if right < n else None
        return _NONE if found is None else found * n + left

    def put(at: int, value: int) -> None:
        at += size
        tree[at] = value
        while at > 1:
            at >>= 1
            left, right = tree[2 * at], tree[2 * at + 1]
            least = left if left < right else right
            if tree[at] == least:
                break
            tree[at] = least

    for k in range(n - 1):
        tree[size + k] = rank(k, k + 1)
    for k in range(size - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right
    while tree[1] != _NONE:
        left = tree[1] % n
        right = after[left]
        part[left] += part[right]
        after[left] = following = after[right]
        if following < n:
            before[following] = left
        put(right, _NONE)
        put(left, rank(left, following))
        if (previous := before[left]) >= 0:
            put(previous, rank(previous, left))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[part[at]])
        at = after[at]
    return ids


def read_vocabulary(spark: SparkSession, path: str, pattern: str) -> Vocabulary:
    """Reads a rank file: a line per token, its bytes in base 64 and its rank. A path with a scheme is read by Spark."""
    if "://" in path:
        lines = [r[0] for r in spark.read.text(path).collect()]
    else:
        with open(path) as file:
            lines = file.read().splitlines()
    return Vocabulary({base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}, pattern)


def encode(frame: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """The frame with the column ``ids`` (replaced if there is one): the ids of the whole text, without special tokens.

    Null and empty texts have no ids. Repeated rows come out alike; an empty table gives an empty table. The vocabulary
    travels as a broadcast: its size is that of the rank file, whatever the data.
    """
    return _mapped(frame, vocabulary, {ids: T.ArrayType(T.IntegerType())}, text, lambda known, texts: [_listed(known.encode_many(texts))])


def encode_and_decode(frame: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """As ``encode``, and with the column ``decoded``: the bytes that these ids stand for, in the same pass."""

    def both(known: Vocabulary, texts: list[str | None]) -> list[pa.Array]:
        listed = known.encode_many(texts)
        return [_listed(listed), pa.array([known.decode(np.frombuffer(x, np.int32).tolist()) for x in listed], pa.binary())]

    return _mapped(frame, vocabulary, {ids: T.ArrayType(T.IntegerType()), decoded: T.BinaryType()}, text, both)


def decode(frame: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The frame with the column ``decoded``: the bytes that the ids stand for; null for null. An id without a token is an error."""
    return _mapped(frame, vocabulary, {decoded: T.BinaryType()}, ids, lambda known, listed: [pa.array([None if x is None else known.decode(x) for x in listed], pa.binary())])


def _listed(ids: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, ids)]) // 4
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _mapped(frame: DataFrame, vocabulary: Vocabulary, new: dict[str, T.DataType], source: str, make) -> DataFrame:
    """Adds columns made from slices of the source column, a few rows at a time, so a worker's memory stays bounded."""
    shared = frame.sparkSession.sparkContext.broadcast(vocabulary)
    kept = [c for c in frame.columns if c not in new]
    # longer than any name of the input, so it cannot be one of them
    given = "source" + "_" * max(map(len, frame.columns))
    read = frame.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias(given))
    schema = T.StructType([*(read.schema[c] for c in kept), *(T.StructField(c, kind) for c, kind in new.items())])

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch[given].value_lengths().fill_null(0).to_numpy() if pa.types.is_list(batch[given].type) else pa.compute.binary_length(batch[given]).fill_null(0).to_numpy()
            begin = 0
            while begin < batch.num_rows:
                total = np.cumsum(sizes[begin : begin + 4096])
                count = max(1, int(np.searchsorted(total, SLICE, "right")))
                part = batch.slice(begin, count)
                begin += part.num_rows
                columns = make(shared.value, part[given].to_pylist())
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), *columns], [*kept, *new])

    return read.mapInArrow(every, schema)


def joined_ids(ids: Column) -> Column:
    """The ids as decimal numbers with commas between them."""
    return F.array_join(ids.cast("array<string>"), ",")
