"""Periodic runs of words in a text, and texts without their repeats.

A run is a stretch of words with a smallest period q (words q apart are equal) that is at least ``EXPONENT`` periods and
``LEAST`` words long and cannot be grown. Words that match a word ``lag`` places before form diagonals. A sparse table
keeps the length of the diagonals that are alive: each word looks up its earlier occurrences, opens a diagonal for
each new lag and adds one to those that go on; a diagonal that ends is a run if it is long enough, and given out at once.

What keeps the table sparse without losing runs:

* The shortest diagonal of a run has five words, so occurrences are looked up by the last ``GRAM`` words.
* A diagonal is new only where the words before it differ, so occurrences are kept by the word before them.
* In a run the same words stand one lag later, so a lag is opened only if they do.
* While a run of period q is alive, a longer lag is either a multiple of q (the same stretch, not its smallest period)
  or began at most q words before the run ends, by the theorem of Fine and Wilf. Such lags are looked up when it ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Periods and words that a run has at least.
EXPONENT, LEAST = 4, 6
#: Words by which occurrences are looked up: a diagonal of lag q has at least max(3 * q, 6 - q) words, 5 for q = 1.
GRAM = 5
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)

Run = tuple[int, int, int]


def enough(lag: int) -> int:
    """Words that a diagonal of a lag needs for a run."""
    return max((EXPONENT - 1) * lag, LEAST - lag)


def _grams(words: Sequence[int]) -> np.ndarray:
    """A hash of the ``GRAM`` words that end at each place from ``GRAM - 1`` on."""
    ids = np.array(words, np.uint64)
    n = len(ids) - GRAM + 1
    return sum((ids[k : k + n] * _MIX[k] for k in range(1, GRAM)), ids[:n] * _MIX[0])


def find_runs(words: Sequence[bytes]) -> list[Run]:
    """All runs as (start, length, period), by start and period."""
    n = len(words)
    if n < LEAST:
        return []
    numbers: dict[bytes, int] = {}
    at = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(numbers) == n:
        return []
    hashes = _grams(at)
    _, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    places = np.flatnonzero(counts[which] > 1)
    if not len(places):
        return []
    gram = which.tolist()
    alive: dict[int, int] = {}  # lag -> where its diagonal begins
    met: dict[int, dict[int, list[int]]] = {}  # gram -> word before -> ends of earlier occurrences
    found: list[Run] = []
    none = n + 1
    before, cover = -1, none

    def close(lags: list[int], end: int) -> None:
        starts = set()
        for lag in sorted(lags):
            start = alive.pop(lag) - lag
            # the same stretch ends with its smallest period first
            if end - start - lag >= enough(lag) and start not in starts:
                starts.add(start)
                found.append((start, end - start, lag))

    for place in places.tolist():
        i = place + GRAM - 1
        if alive:
            over = [lag for lag in alive if i != before + 1 or at[i] != at[i - lag]]
            if over:
                close(over, before + 1)
        hidden, cover = cover, min((lag for lag, start in alive.items() if i - start >= enough(lag)), default=none)
        opened = cover > hidden
        last = at[i - GRAM] if i >= GRAM else -1
        earlier = met.setdefault(gram[place], {})
        # a lag must leave room for its diagonal
        most = (n - i + GRAM - 1) // (EXPONENT - 1)
        for word, ends in earlier.items():
            if word == last and not opened:
                continue
            for j in reversed(ends):
                lag = i - j
                if lag >= cover or lag > n // EXPONENT:
                    break
                new = word != last
                if (new and lag > most) or lag in alive or (not new and lag <= hidden):
                    continue
                if new and lag >= 3 and gram[place + lag] != gram[place]:
                    continue
                # equal hashes are compared; a lag that was hidden is followed back to where it began
                start = i + 1
                while start > lag and at[start - 1] == at[start - 1 - lag] and (not new or start > place):
                    start -= 1
                if start <= place and start + enough(lag) <= n:
                    alive[lag] = start
        earlier.setdefault(last, []).append(i)
        before = i
    close(list(alive), before + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return list(words)
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(stays).tolist()]


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run with most periods; the first, then the one of the smallest period, among equals."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, strongest: struct<start: long, length: long, period: long>, collapsed: string>"


def periodic_runs(text: Column) -> Column:
    """A struct for each text: ``n_words``, all ``runs`` (start, length, period) by start and period, the ``strongest``
    (null if there is none) and the ``collapsed`` text, its words joined by one blank.

    Words are runs of anything but blanks and the controls 9 to 13, numbered from 0. A null or blank text has no words,
    no runs and an empty collapsed text. A text is read whole, whatever its length.
    """

    @F.arrow_udf(_FOUND)
    def every(texts: pa.Array) -> pa.Array:
        sizes, offsets, flat, best, left = [], [0], [], [], []
        for value in texts.cast(pa.binary()):
            words = (value.as_py() or b"").split()
            runs = find_runs(words)
            sizes.append(len(words))
            flat += runs
            offsets.append(len(flat))
            best.append(strongest(runs))
            left.append(b" ".join(collapse(words, runs)))
        fields = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
        runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
        best = pa.array([r and dict(zip(("start", "length", "period"), r, strict=True)) for r in best], _RUN)
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), runs, best, pa.array(left, pa.binary()).cast(pa.string())], ["n_words", "runs", "strongest", "collapsed"])

    # computed once, however many fields are read
    return every(text)


def with_periodic_runs(frame: DataFrame, text: str = "text", into: str = "found") -> DataFrame:
    """The frame with a column ``into`` of ``periodic_runs``; a column of that name is replaced. Repeated rows stay,
    an empty table stays empty, other columns pass."""
    return frame.withColumn(into, periodic_runs(F.col(f"`{text}`")))


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for a tenth of the documents its words with a period from some word on, by a checksum of the id.

    Without an id the text stays as it is.
    """
    number = F.crc32(doc_id.cast("string"))
    g = F.floor(number / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words).cast("long")
    first = g % n
    period = F.lit(1) + F.floor((n - first) / (F.lit(3) + g % 8))
    cycle = F.slice(words, (first + 1).cast("int"), period.cast("int"))
    times = F.ceil((n - first) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), (n - first).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), first.cast("int")), tail), " ")
    return F.when((number % 10 == 0) & text.isNotNull(), F.when(n > 0, made).otherwise(text)).otherwise(text)
