"""Benchmark passages in documents: CGK embedding, bit-sampling LSH over item-sized windows, exact edit distance.

Items and documents are sequences of words. A CGK walk turns a sequence into one of fixed length: step j writes the
word at its place and moves on by a random bit of (j, word). Sequences a few edits apart fall into step again soon, so
their walks differ in few places, a Hamming distance. Sampling places of the walk is then a locality-sensitive hash. A window
starts at every word; several walks, each sampled several times, are taken until the simulated share of found
windows at the largest allowed distance reaches the target recall. Exact copies always collide.

Each hit is checked exactly: the least edit distance in words between the item and any stretch of the text there.

Before walking, windows are left out that hold more words foreign to the items than edits are allowed: each foreign word
costs an edit, so this loses nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An item of n words is found with up to (1 - SIMILARITY) n edits, rounded down.
SIMILARITY = 0.8
RECALL = 0.95
#: Places of a walk in a key, and keys taken from a walk. Where so many walks do not reach the recall, an item's group
#: begins again with one place less in a key.
SAMPLED, TABLES, WALKS = 3, 6, 48
#: First words by which exact copies of an item are looked up.
FIRST_WORDS = 4
#: Words of items looked for in one pass over the documents; more items are taken in several.
BLOCK_WORDS = 1_000_000
#: Words of documents, and windows, worked on at once.
SLICE, WINDOWS = 1 << 20, 1 << 17
_WORD = re.compile(r"\w+")
LEAK = "array<struct<item:int, edits:int, first:int, words:int, begin:int, end:int>>"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class Group:
    """Items of similar length: what their windows share."""

    least: int
    most: int
    edits: int
    steps: int
    members: list[int]
    places: np.ndarray  # walks x tables x sampled
    known: np.ndarray  # word numbers that occur in the items
    keys: list[np.ndarray] = field(default_factory=list)  # per table, sorted
    owners: list[np.ndarray] = field(default_factory=list)
    first: int = 1  # words in the keys of exact copies
    first_keys: np.ndarray | None = None
    first_owners: np.ndarray | None = None


class Finder:
    """Finds given items in texts. Items without words are never found."""

    def __init__(self, items: list[str | None], similarity: float = SIMILARITY, recall: float = RECALL, seed: int = 11) -> None:
        self.similarity, self.seed = similarity, seed
        self.items = [words_of(x) for x in items]
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for x in self.items for w in x), 1)}
        self.coded = [np.array([self.vocabulary[w] for w in x], np.int32) for x in self.items]
        self.masks = [_masks(x.tolist()) for x in self.coded]
        by_length: dict[int, list[int]] = {}
        for k, x in enumerate(self.items):
            if x:
                by_length.setdefault(len(x), []).append(k)
        self.groups: list[Group] = []
        lengths = sorted(by_length)
        while lengths:
            least = lengths[0]
            same = [n for n in lengths if n <= least * 1.25]
            lengths = lengths[len(same) :]
            self.groups.append(self._group(least, same[-1], [k for n in same for k in by_length[n]], recall))

    def allowed(self, length: int) -> int:
        return int(length * (1 - self.similarity) + 1e-9)

    def _group(self, least: int, most: int, members: list[int], recall: float) -> Group:
        rng = np.random.default_rng(self.seed * 1000 + least)
        steps = max(1, 2 * least - 1)
        known = np.zeros(len(self.vocabulary) + 1, bool)
        for k in members:
            known[self.coded[k]] = True
        walks, sampled_places = 0, min(SAMPLED, steps)
        while not walks:
            places = np.sort(np.argsort(rng.random((WALKS, TABLES, steps)), axis=2)[:, :, :sampled_places], axis=2)
            group = Group(least, most, self.allowed(most), steps, members, places, known)
            walks = self._walks_needed(group, rng, recall)
            sampled_places -= 1
            if not walks and not sampled_places:
                raise ValueError(f"items of {least} to {most} words are not found with recall {recall}")
        group.places = places[:walks]
        group.first = min(least, FIRST_WORDS)
        key = _keyed(np.stack([self.coded[k][: group.first] for k in members]))
        order = np.argsort(key, kind="stable")
        group.first_keys, group.first_owners = key[order], np.array(members)[order]
        joined = np.concatenate([np.r_[self.coded[k], np.zeros(steps, np.int32)] for k in members])
        starts = np.cumsum([0, *(len(self.coded[k]) + steps for k in members[:-1])])
        for walk in range(walks):
            sampled = self._walk(joined, starts, group, walk)
            for table in range(TABLES):
                key = _keyed(sampled[:, places[walk, table]])
                order = np.argsort(key, kind="stable")
                group.keys.append(key[order])
                group.owners.append(np.array(members)[order])
        return group

    def _walks_needed(self, group: Group, rng: np.random.Generator, recall: float) -> int:
        """Walks after which the simulated recall at the largest distance reaches the target; 0 if these many do not."""
        if group.edits == 0:
            return 1
        left, right = [], []
        for k in rng.choice(group.members, 200):
            word = self.coded[k].tolist()
            other = list(word)
            for _ in range(self.allowed(len(word))):
                at, kind = int(rng.integers(0, len(other))), int(rng.integers(0, 3))
                new = int(rng.integers(1, len(self.vocabulary) + 1)) if rng.random() < 0.5 else -int(rng.integers(1, 1 << 30))
                other[at : at + 1] = [[new], [new, other[at]], [] if len(other) > 1 else [other[at]]][kind]
            # a text goes on with other words behind its copy of an item
            left.append(np.r_[word, np.zeros(group.steps, int)])
            right.append(np.r_[other, -rng.integers(1, 1 << 30, group.steps)])
        found = np.zeros(200, bool)
        for walk in range(len(group.places)):
            outs = []
            for side in (left, right):
                starts = np.cumsum([0, *(len(x) for x in side[:-1])])
                outs.append(self._walk(np.concatenate(side), starts, group, walk))
            for table in range(TABLES):
                at = group.places[walk, table]
                found |= (outs[0][:, at] == outs[1][:, at]).all(1)
            if found.mean() >= recall:
                return walk + 1
        return 0

    def _walk(self, words: np.ndarray, starts: np.ndarray, group: Group, walk: int) -> np.ndarray:
        """The walks from the starts: starts x steps."""
        out = np.empty((len(starts), group.steps), np.int32)
        at, last = starts.copy(), len(words) - 1
        for j in range(group.steps):
            word = words[np.minimum(at, last)]
            out[:, j] = word
            salt = (walk * 7919 + j * 104729 + self.seed) * 2 + 1
            at += _bit(word, salt)
        return out

    def candidates(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(starts, items) whose sampled walks collide, in a sequence of word numbers (0: foreign to all items)."""
        for group in self.groups:
            foreign = np.concatenate([[0], np.cumsum(~group.known[words])])
            n = len(words) - 1
            ends = np.minimum(np.arange(n + 1) + group.least, n + 1)
            starts = np.flatnonzero((foreign[ends] - foreign[: n + 1] <= group.edits) & (words > 0))
            # a window may begin with words that the item lacks; then its next start is as good
            for k in range(0, len(starts), WINDOWS):
                part = starts[k : k + WINDOWS]
                yield from _collisions(part, _keyed(words[np.minimum(part[:, None] + np.arange(group.first), n)]), group.first_keys, group.first_owners)
                table = 0
                for walk in range(len(group.places)):
                    sampled = self._walk(words, part, group, walk)
                    for places in group.places[walk]:
                        chosen = sampled[:, places]
                        yield from _collisions(part, _keyed(chosen), group.keys[table], group.owners[table])
                        table += 1

    def find(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text the items found, each once: where it fits best, furthest left if several places do."""
        found: list[list[dict]] = [[] for _ in texts]
        begun, size, listed = 0, 0, []
        get = self.vocabulary.get
        for k, text in enumerate(texts):
            coded = np.fromiter((get(w, 0) for w in words_of(text)), np.int32)
            listed.append(coded)
            size += len(coded)
            if size >= SLICE or k + 1 == len(texts):
                for at, hits in self._found(listed):
                    found[begun + at] = _spans(texts[begun + at], hits)
                begun, size, listed = k + 1, 0, []
        return found

    def _found(self, listed: list[np.ndarray]) -> Iterator[tuple[int, list[tuple[int, int, int, int]]]]:
        # a foreign word between texts; and the end can be walked over
        words = np.concatenate([y for x in listed for y in (x, np.zeros(1, np.int32))])
        bounds = np.cumsum([0, *(len(x) + 1 for x in listed)])
        pairs = [np.stack([s, i], 1) for s, i in self.candidates(words)] if len(words) > len(listed) else []
        if not pairs:
            return
        hits = np.unique(np.concatenate(pairs), axis=0)
        owner = np.searchsorted(bounds, hits[:, 0], "right") - 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        order = np.lexsort((hits[:, 0], hits[:, 1], owner))
        done: tuple[int, int, int] = (-1, -1, -1)
        for k in order.tolist():
            doc, (start, item) = int(owner[k]), hits[k].tolist()
            start -= int(bounds[doc])
            n = len(self.coded[item])
            room = self.allowed(n)
            if done[:2] == (doc, item) and start + n + room <= done[2]:
                continue  # within the stretch already looked at
            low, high = max(0, start - n - room), start + 2 * n + 2 * room
            done = (doc, item, high)
            result = _closest(self.coded[item], self.masks[item], listed[doc][low:high], room)
            if result:
                edits, first, length = result
                if (doc, item) not in best or edits < best[doc, item][0]:
                    best[doc, item] = (edits, first + low, length)
        by_doc: dict[int, list[tuple[int, int, int, int]]] = {}
        for (doc, item), (edits, first, length) in sorted(best.items()):
            by_doc.setdefault(doc, []).append((item, edits, first, length))
        yield from by_doc.items()


def _collisions(starts: np.ndarray, key: np.ndarray, keys: np.ndarray, owners: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, items) of equal keys; those of the items are sorted."""
    low, high = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
    hit = np.flatnonzero(high > low)
    if len(hit):
        times = high[hit] - low[hit]
        offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        yield np.repeat(starts[hit], times), owners[np.repeat(low[hit], times) + offset]


def _bit(word: np.ndarray, salt: int) -> np.ndarray:
    """A random bit of (step, word)."""
    mixed = (word.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)).astype(np.int64)


def _keyed(sampled: np.ndarray) -> np.ndarray:
    key = np.zeros(len(sampled), np.uint64)
    for column in sampled.T:
        key = (key ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key


def _masks(item: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def _ends(masks: dict[int, int], n: int, text: list[int], free: bool) -> list[int]:
    """Edit distance of the item to the best stretch of text (from its begin, unless free) that ends before each word's end.

    Bit-parallel over the item's words, as numbers of any width.
    """
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, ends = full, 0, n, []
    for w in text:
        eq = masks.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full if free else ((ph << 1) | 1) & full
        mh = (mh << 1) & full
        plus = mh | (full & ~(xv | ph))
        minus = ph & xv
        ends.append(score)
    return ends


def _closest(item: np.ndarray, masks: dict[int, int], text: np.ndarray, room: int) -> tuple[int, int, int] | None:
    """(edits, first word, words) of the stretch of text closest to the item; None beyond ``room`` edits."""
    n, listed = len(item), text.tolist()
    ends = _ends(masks, n, listed, True)
    if not ends or min(ends) > room:
        return None
    edits = min(ends)
    end = ends.index(edits) + 1
    back = _ends(_masks(item[::-1].tolist()), n, listed[:end][::-1][: n + room], False)
    length = back.index(edits) + 1 if edits in back else 0
    return edits, end - length, length


def _spans(text: str, hits: list[tuple[int, int, int, int]]) -> list[dict]:
    lowered = text.lower()
    at = [m.span() for m in _WORD.finditer(lowered)]
    exact = len(lowered) == len(text)
    out = []
    for item, edits, first, length in hits:
        begin, end = (at[first][0], at[first + length - 1][1]) if length else (0, 0)
        out.append({"item": item, "edits": edits, "first": first, "words": length, "begin": begin if exact else -1, "end": end if exact else -1})
    return out


def blocks_of(benchmark: DataFrame, item_column: str = "item_id", text: str = "text") -> list[list[tuple]]:
    """The items (id, text) in blocks of at most about ``BLOCK_WORDS`` words, so what a pass carries has a known size."""
    blocks: list[list[tuple]] = [[]]
    size = 0
    listed = benchmark.select(F.col(f"`{item_column}`"), F.col(f"`{text}`")).orderBy(F.col(f"`{item_column}`").asc_nulls_last(), f"`{text}`")
    for item, body in listed.toLocalIterator():
        n = len(words_of(body))
        if size and size + n > BLOCK_WORDS:
            blocks.append([])
            size = 0
        blocks[-1].append((item, body))
        size += n
    return blocks


def leaks(text: Column, items: list[tuple], similarity: float = SIMILARITY, recall: float = RECALL) -> Column:
    """Array of the items found in the text; ``item`` is the item's place in the list."""
    finder = Finder([body for _, body in items], similarity, recall)

    def every(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(finder.find([x if isinstance(x, str) else None for x in texts]))

    every.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(every, LEAK).asNondeterministic()(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """A row per document and item found in it: doc_id, item_id, edits, first word, words, begin and end character.

    Words are runs of letters, digits and underscores in lower case. An item of n words is found where a stretch of
    the text is at most (1 - similarity) n edits of words away; exact copies always, others with the target recall. The
    place is that of the fewest edits, the first such. begin and end are -1 where lower case changes the text's length.
    Null, empty and wordless texts hold nothing, and such items are not found. Repeated rows and items are each
    reported. Empty tables give no rows.
    """
    found = []
    kind = benchmark.schema[item_column].dataType.simpleString()
    for items in blocks_of(benchmark, item_column, item_text):
        hits = docs.select(F.col(f"`{id_column}`").alias("id"), F.explode(leaks(F.col(f"`{text}`"), items, similarity, recall)).alias("leak"))
        names = docs.sparkSession.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], f"number int, item_id {kind}")
        hits = hits.join(names, F.col("leak.item") == F.col("number"))
        found.append(hits.select(F.col("id").alias(id_column), "item_id", "leak.edits", "leak.first", "leak.words", "leak.begin", "leak.end"))
    return reduce(DataFrame.unionAll, found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_column: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The documents that hold no benchmark item, unchanged; see find_leaks for what counts."""
    for items in blocks_of(benchmark, item_column, item_text):
        docs = docs.where(F.size(leaks(F.col(f"`{text}`"), items, similarity, recall)) == 0)
    return docs
