"""Quality and toxicity by weak labels.

Heuristic labellers each vote good, bad or not at all on every document. Expectation-maximisation over the counts of
vote patterns (a table whose size depends on the number of labellers alone) estimates how often each labeller is
right and how likely a pattern is good. These posteriors are the labels from which a hashed linear scorer is trained,
on a bounded sample, over words and letter-shape patterns, so that it also judges where few labellers vote.

Toxicity is a second task with labellers of its own, made and trained in the same way. They read marks: words and word
beginnings that stand in toxic documents of a labelled sample far more often than in its other documents, in
whatever language. A held-out part of the sample sets what each labeller takes for a bad sign.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import packed, stored, unpacked

#: Features of the scorer; rows it is trained on, about; parts they are trained in before averaging.
FEATURES, SAMPLE_ROWS, PARTS = 1 << 16, 20_000, 8
EPOCHS, RATE = 4, 0.5
#: A labeller votes bad on at most this share of good documents.
ALARM = 0.003
#: Marks are learnt from, and the labellers' cuts set by, about this many labelled rows. A mark stands in three of them at least.
LABELLED_ROWS, LEAST_SEEN = 20_000, 3
#: Letters of a word's beginnings; the weight from which on a mark is counted as one of several.
BEGINNINGS, SURE = (5, 6, 7, 8), 2.0
#: The least cuts: what a text's marks weigh together, the strongest, the number of sure ones, their weight in a hundred words.
CUTS = (5.0, 4.8, 2.0, 2.0)
#: Bytes hashed at once; words, and letters in them, whose weights a task remembers.
SLICE, REMEMBERED, LETTERS = 1 << 20, 1 << 17, 40
_ENDS = tuple(mark + blank for mark in ".?!" for blank in " \n")
_WORDS = re.compile(r"\w+")
QUALITY = ("marks", "decorated", "capitals", "word_run", "line_repeats", "separators", "short_words", "word_length", "sentences", "variety")
TOXICITY = ("marks_together", "strongest_mark", "sure_marks", "mark_share")


def forms_of(word: str) -> list[str]:
    """What can be a mark in a word: itself, and its beginnings."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


class Weights(dict[str, float]):
    """Weights of words by ``marks``: a word weighs as much as its heaviest mark. Those looked up are remembered, up to a bound."""

    def __init__(self, marks: dict[str, float]) -> None:
        super().__init__()
        self.marks = marks

    def __missing__(self, word: str) -> float:
        weight = max(self.marks.get(f, 0.0) for f in forms_of(word))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= LETTERS:
            self[word] = weight
        return weight


def signs_of(words: set[str], weights: Weights) -> tuple[float, ...]:
    """What the labellers of toxicity judge by, in the order of ``CUTS``.

    Long texts meet marks by chance, so that much is taken off their weight together.
    """
    found = [x for x in map(weights.__getitem__, words) if x]
    total = sum(found)
    return total - math.log1p(len(words) / 100), max(found, default=0.0), float(sum(x >= SURE for x in found)), 100 * total / max(30, len(words))


def _labelled(frame: DataFrame, labels: DataFrame, text: str, key: str, rows: int) -> DataFrame:
    """(text, toxic, held): about ``rows`` labelled texts, a quarter of them held out, both by a hash of the key."""
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col("toxic").cast("int").alias("toxic")).where("key IS NOT NULL AND toxic IS NOT NULL")
    share = rows / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("key", F.lit(9)), F.lit(1 << 40)) < int(share * (1 << 40)))
    texts = frame.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    # at most about ``rows`` keys
    known = F.broadcast(known.groupBy("key").agg(F.max("toxic").alias("toxic")))
    return texts.join(known, "key").select("text", "toxic", (F.pmod(F.xxhash64("key", F.lit(11)), F.lit(4)) == 0).alias("held"))


def learn_marks(frame: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", rows: int = LABELLED_ROWS) -> dict[str, float]:
    """Marks of toxic texts and their weights, from about three quarters of ``rows`` of the ``labels`` (key, toxic).

    A weight is the log of how much more often a mark stands in toxic texts, at the unfavourable end of one standard
    error on both sides. Null keys, labels and texts teach nothing.
    """
    drawn = _labelled(frame, labels, text, key, rows).where("NOT held").select("text", "toxic")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sides: tuple[Counter, Counter] = (Counter(), Counter())
            for one, toxic in zip(part["text"], part["toxic"], strict=True):
                words = set(_WORDS.findall(one.lower()))
                sides[int(toxic > 0)].update({f for w in words for f in forms_of(w)} | {""})
            names = list(sides[0].keys() | sides[1].keys())
            yield pd.DataFrame({"mark": names, "toxic": [sides[1][x] for x in names], "clean": [sides[0][x] for x in names]})

    counted = drawn.mapInPandas(count, "mark string, toxic long, clean long").groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # the empty mark counts the documents
    counted = stored(counted, "marks")
    total = counted.where("mark = ''").first()
    if total is None or not total.toxic or not total.clean:
        return {}
    weight = F.log((F.col("toxic") - F.sqrt("toxic")) / total.toxic) - F.log((F.col("clean") + 1 + F.sqrt("clean")) / total.clean)
    # as many as the bounded sample has
    found = counted.where(f"mark <> '' AND toxic >= {LEAST_SEEN}").withColumn("weight", weight).where("weight > 1.5")
    return {r.mark: r.weight for r in found.collect()}


def learn_cuts(frame: DataFrame, labels: DataFrame, marks: dict[str, float], text: str = "text", key: str = "doc_id", rows: int = LABELLED_ROWS) -> tuple[float, ...]:
    """For each labeller of toxicity what at most ``ALARM`` of the held-out texts that are not toxic exceed, ``CUTS`` at least.

    The more rows marks are learnt from, the more weak ones there are, so no fixed cut fits every sample.
    """

    def weigh(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = Weights(marks)
        for part in parts:
            yield pd.DataFrame([signs_of(set(_WORDS.findall(one.lower())), weights) for one in part["text"]], columns=TOXICITY, dtype=float)

    clean = _labelled(frame, labels, text, key, rows).where("held AND toxic = 0").select("text")
    signs = clean.mapInPandas(weigh, ", ".join(f"{name} double" for name in TOXICITY))
    found = signs.agg(*[F.percentile_approx(name, 1 - ALARM, 100_000) for name in TOXICITY]).first()
    return tuple(max(least, x if x is not None else least) for least, x in zip(CUTS, found, strict=True))


def votes_of(text: str | None, marks: dict[str, float] | None = None, cuts: tuple[float, ...] = CUTS, weights: Weights | None = None) -> tuple[list[int], list[int]]:
    """Votes on quality and on toxicity: 1 good (not toxic), -1 bad (toxic), 0 none.

    A text without words is bad by its variety and its word length, and has no vote on toxicity; nor has any where no
    marks are known. Texts judged in a row share ``weights``, which are those of the marks.
    """
    text = text or ""
    tokens = text.split()
    n = len(tokens)
    if not n:
        return [0, 0, 0, 0, 0, 0, 0, -1, 0, -1], [0] * len(TOXICITY)
    chars, different = sum(map(len, tokens)), set(tokens)
    words = _WORDS.findall(text.lower())
    lengths = list(map(len, words))
    signed = 1 - min(1, sum(lengths) / chars)
    decorated = sum(not x[-1].isalnum() and len(x) > 2 and not x[-2].isalnum() for x in tokens) / n
    upper = sum(map(str.isupper, tokens)) / n
    runs = sum(map(eq, tokens, tokens[1:])) / n
    lines = [x for x in text.split("\n") if x.strip()]
    repeats = 1 - len(set(lines)) / len(lines)
    signs = {x for x in different if len(x) <= 2 and not any(map(str.isalnum, x))}
    bars = sum(map(signs.__contains__, tokens)) / n if signs else 0
    short = sum(map(lengths.count, (1, 2, 3))) / max(1, len(words))
    length = sum(lengths) / n
    ends = sum(map(text.count, _ENDS)) / n
    variety = len(different) / min(n, 2000)

    def vote(bad: bool, none: bool = False) -> int:
        return 0 if none else -1 if bad else 1

    quality = [
        vote(signed > 0.2),
        vote(decorated > 0.2),
        vote(upper > 0.4, n < 10),
        vote(runs > 0.1),
        vote(repeats > 0.3, len(lines) < 4),
        vote(bars > 0.1),
        vote(short < 0.1, n < 30),
        vote(length < 2 or length > 14),
        vote(ends < 0.01 or ends > 0.6, n < 30),
        vote(variety < 0.2, n < 30),
    ]
    if not marks:
        return quality, [0] * len(TOXICITY)
    return quality, [vote(sign > cut) for sign, cut in zip(signs_of(set(words), Weights(marks) if weights is None else weights), cuts, strict=True)]


def votes(text: Column, marks: dict[str, float], cuts: tuple[float, ...]) -> Column:
    """Struct of the two arrays of votes."""

    def every(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = Weights(marks)
        for texts in parts:
            both = [votes_of(x if isinstance(x, str) else None, marks, cuts, weights) for x in texts]
            yield pd.DataFrame({"quality": [x[0] for x in both], "toxicity": [x[1] for x in both]})

    every.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(every, "quality array<int>, toxicity array<int>").asNondeterministic()(text)


@dataclass
class Labels:
    """What expectation-maximisation found: the good share, and for each labeller how often a good (bad) document that
    gets a vote gets each."""

    prior: float
    good: np.ndarray  # labellers x votes (-1, 0, 1)
    bad: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        at = patterns + 1
        each = np.arange(patterns.shape[1])
        up = np.log(self.prior) + np.log(self.good[each, at]).sum(1)
        down = np.log(1 - self.prior) + np.log(self.bad[each, at]).sum(1)
        return 1 / (1 + np.exp(np.clip(down - up, -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Share of right votes among votes given, for each labeller."""
        right = self.prior * self.good[:, 2] + (1 - self.prior) * self.bad[:, 0]
        wrong = self.prior * self.good[:, 0] + (1 - self.prior) * self.bad[:, 2]
        return right / (right + wrong)


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, alarm: float = 1.0) -> Labels:
    """Expectation-maximisation over vote patterns; starts from the majority vote.

    ``alarm`` bounds how often a labeller may vote bad on good documents: without it, a defect that only few labellers
    see can be taken for a habit of good documents.
    """
    patterns, counts = patterns.astype(int), counts.astype(float)
    vote = patterns.sum(1)
    belief = np.where(vote > 0, 0.9, np.where(vote < 0, 0.1, 0.5))
    # a single bad vote starts as a doubt: bad signs are rare, and each labeller looks at something else
    belief = np.where((patterns < 0).any(1), np.minimum(belief, 0.1), belief)
    m = patterns.shape[1]
    if not len(patterns):
        return Labels(0.5, np.ones((m, 3)), np.ones((m, 3)))
    labels = Labels(0.5, np.zeros((m, 3)), np.zeros((m, 3)))
    for _ in range(rounds):
        up, down = counts * belief, counts * (1 - belief)
        labels.prior = float(np.clip((up.sum() + 1) / (counts.sum() + 2), 1e-4, 1 - 1e-4))
        for side, weight in ((labels.good, up), (labels.bad, down)):
            voted = (weight[:, None] * (patterns != 0)).sum(0) + 2
            for v in (-1, 1):
                side[:, v + 1] = ((weight[:, None] * (patterns == v)).sum(0) + 1) / voted
        labels.good[:, 0] = np.minimum(labels.good[:, 0], alarm)
        labels.good[:, 2] = np.maximum(labels.good[:, 2], 1 - alarm)
        for side in (labels.good, labels.bad):
            # no vote says nothing
            side[:, 1] = 1
        new = labels.posterior(patterns)
        moved = np.abs(new - belief).max()
        belief = new
        if moved < 1e-6:
            break
    return labels


# Letters keep their code in lower case; capitals, digits, blanks and marks have classes, so a pattern of marks or capitals is a feature
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] = np.arange(97, 123)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_CLASS = np.full(256, 1, np.uint8)
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[97:123] = 0
_CLASS[128:] = 0
_CLASS[_BLANK] = 4
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64)


def hashed(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, feature) in slices, in the texts' order: a feature for each word and each four-byte pattern of classes."""
    begun, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE or k + 1 == len(texts):
            yield from _hashed(texts[begun : k + 1], begun)
            begun, size = k + 1, 0


def _hashed(texts: list[str | None], first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    coded = [(text or "").encode("utf-8", "replace") + b"\n" for text in texts]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    everything, ends = np.frombuffer(b"".join(coded), np.uint8), np.cumsum(lengths)
    step, at = 4 * SLICE, 0
    while at < len(everything):
        stop = min(len(everything), at + step)
        while stop < len(everything) and not _BLANK[everything[stop - 1]]:
            stop += 1
        raw = everything[at:stop]
        word = ~_BLANK[raw]
        begins = np.flatnonzero(word & np.r_[True, ~word[:-1]])
        if len(begins):
            place = np.arange(len(raw)) - np.repeat(begins, np.diff(np.r_[begins, len(raw)]))[: len(raw)] if begins[0] == 0 else None
            if place is None:
                owner = np.cumsum(np.isin(np.arange(len(raw)), begins)) - 1
                place = np.arange(len(raw)) - begins[np.maximum(owner, 0)]
            value = (_LOWER[raw] + np.uint64(1)) * _POWERS[np.minimum(place, 63)]
            value[~word] = 0
            sums = np.add.reduceat(value, begins)
            yield np.searchsorted(ends, begins + at, "right") + first, _bucket(sums)
        kind = _CLASS[raw].astype(np.uint64)
        if len(kind) >= 4:
            shape = kind[:-3] * np.uint64(125) + kind[1:-2] * np.uint64(25) + kind[2:-1] * np.uint64(5) + kind[3:]
            # plain lower-case patterns say nothing
            spots = np.flatnonzero((kind[:-3] % 4 + kind[1:-2] % 4 + kind[2:-1] % 4 + kind[3:] % 4) > 1)
            if len(spots):
                yield np.searchsorted(ends, spots + at, "right") + first, _bucket(shape[spots] + np.uint64(1 << 40))
        at = stop


def _bucket(key: np.ndarray) -> np.ndarray:
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)).astype(np.int64)


def _rows(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, values) of each text: shares of its features, scaled to length one."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for who, bucket in hashed(texts):
        starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        for s, e in zip(starts, np.r_[starts[1:], len(who)], strict=True):
            parts[who[s]].append(bucket[s:e])
    out = []
    for p in parts:
        cells, n = np.unique(np.concatenate(p), return_counts=True) if p else (np.zeros(0, np.int64), np.zeros(0))
        values = np.log1p(n)
        out.append((cells, values / max(1e-9, np.sqrt((values**2).sum()))))
    return out


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def probability(self, texts: list[str | None]) -> np.ndarray:
        return np.array([1 / (1 + np.exp(-np.clip(self.bias + self.weights[c] @ v, -500, 500))) if len(c) else 0.0 for c, v in _rows(texts)])


def train_scorer(sample: DataFrame) -> Scorer:
    """Logistic regression on (text, p): parts of the sample are trained on their own and the weights averaged."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("h", kind="stable")
        rows, aims = _rows(frame["text"].tolist()), frame["p"].to_numpy()
        weights, squares, bias = np.zeros(FEATURES), np.full(FEATURES, 1e-6), 0.0
        balance = np.where(aims > 0.5, 0.5 / max(1e-3, (aims > 0.5).mean()), 0.5 / max(1e-3, (aims <= 0.5).mean()))
        for epoch in range(EPOCHS):
            for (cells, values), aim, weight in zip(rows, aims, balance, strict=True):
                slip = weight * (1 / (1 + np.exp(-np.clip(bias + weights[cells] @ values, -30, 30))) - aim)
                step = slip * values
                squares[cells] += step * step
                weights[cells] -= RATE * step / np.sqrt(squares[cells])
                bias -= 0.05 * slip / (1 + epoch)
        used = np.flatnonzero(weights)
        return pd.DataFrame({"cell": np.r_[used, FEATURES], "weight": np.r_[weights[used], bias]})

    parted = sample.select("text", "p", F.xxhash64("text").alias("h")).withColumn("part", F.pmod("h", F.lit(PARTS)))
    learnt = parted.groupBy("part").applyInPandas(fit, "cell long, weight double").groupBy("cell").agg((F.sum("weight") / PARTS).alias("weight")).toPandas()
    weights = np.zeros(FEATURES + 1)
    weights[learnt["cell"].to_numpy(np.int64)] = learnt["weight"].to_numpy()
    return Scorer(weights[:-1].astype(np.float32), float(weights[-1]))


@dataclass
class QualityModel:
    quality: Labels
    toxicity: Labels
    scorer: Scorer
    toxic_scorer: Scorer
    marks: dict[str, float]
    cuts: tuple[float, ...]


def fit_quality(frame: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS, labels: DataFrame | None = None, key: str = "doc_id") -> QualityModel:
    """Estimates the labellers over all documents and trains the scorers on about ``rows`` of their distinct texts, drawn by a hash.

    ``labels`` (key, toxic) give the marks of toxic texts; without them the labellers of marks never vote.
    """
    return _fit(frame, None, text, rows, labels, key)[0]


def fit_and_classify(frame: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS, labels: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """``classify`` by the model that ``fit_quality`` finds in the same frame. The labellers vote once on each row; rows are stored with their votes."""
    model, voted = _fit(frame, packed(frame), text, rows, labels, key)
    return _judged(voted, frame.columns, model, text)


def _fit(frame: DataFrame, row: Column | None, text: str, rows: int, labels: DataFrame | None, key: str) -> tuple[QualityModel, DataFrame]:
    """The model, and the votes on each row; with ``row`` they are stored beside it."""
    marks = learn_marks(frame, labels, text, key) if labels is not None else {}
    cuts = learn_cuts(frame, labels, marks, text, key) if marks else CUTS
    if row is None:
        voted = frame.select(votes(F.col(f"`{text}`"), marks, cuts).alias("votes"))
    else:
        voted = stored(frame.select(row).withColumn("votes", votes(F.col("row").getField(text), marks, cuts)), "voted")
    patterns = stored(voted.groupBy("votes").count(), "votes").toPandas()
    counts = patterns["count"].to_numpy(float)
    found = []
    for task, names in (("quality", QUALITY), ("toxicity", TOXICITY)):
        table = np.array([list(x[task]) for x in patterns["votes"]], int).reshape(-1, len(names))
        found.append(fit_labels(table, counts, alarm=ALARM))
    share = rows / max(1.0, counts.sum())
    sample = frame.select(F.col(f"`{text}`").alias("text")).where("text is not null")
    if share < 1:
        sample = sample.where(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 40)) < int(share * (1 << 40)))
    # copies share a hash, so they are drawn together: a text counts once
    sample = stored(sample.dropDuplicates(["text"]).withColumn("votes", votes(F.col("text"), marks, cuts)), "quality-sample")
    scorers = [train_scorer(sample.withColumn("p", posterior(labels, F.col(f"votes.{task}")))) for labels, task in zip(found, ("quality", "toxicity"), strict=True)]
    return QualityModel(*found, *scorers, marks, cuts), voted


def posterior(labels: Labels, pattern: Column) -> Column:
    """Probability of good for an array of votes, in built-in functions."""
    up, down = F.lit(float(np.log(labels.prior))), F.lit(float(np.log(1 - labels.prior)))
    for k in range(len(labels.good)):
        for side, name in ((labels.good, "up"), (labels.bad, "down")):
            term = F.get(F.array(*[F.lit(float(np.log(x))) for x in side[k]]), F.get(pattern, k) + 1)
            if name == "up":
                up = up + term
            else:
                down = down + term
    return 1 / (1 + F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), down - up))))


def classify(frame: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The frame with columns posterior, score, not_toxic, toxic_score, keep, which replace columns of these names.

    posterior and not_toxic come from the labellers, score and toxic_score (probabilities of good and of not toxic)
    from the scorers. A document is kept if its quality posterior and score agree that it is good (their mean, in log
    odds, is above a half), and labellers and scorer agree in the same way that it is not toxic; without marks nothing
    is said of that. Null, empty and blank texts are not kept. Repeated rows are judged alike. An empty table gives an empty table.
    """
    voted = frame.select(packed(frame)).withColumn("votes", votes(F.col("row").getField(text), model.marks, model.cuts))
    return _judged(voted, frame.columns, model, text)


def _judged(voted: DataFrame, columns: list[str], model: QualityModel, text: str) -> DataFrame:
    scorer, toxic_scorer, marks = model.scorer, model.toxic_scorer, model.marks

    def every(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            rows = _rows([x if isinstance(x, str) else None for x in texts])
            p, q = (np.array([s.bias + float(s.weights[c] @ v) for c, v in rows]) for s in (scorer, toxic_scorer))
            yield pd.DataFrame({"p": p, "q": q})

    every.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    judged = F.pandas_udf(every, "p double, q double").asNondeterministic()
    odd = lambda p: F.log(F.greatest(p, F.lit(1e-12)) / F.greatest(1 - p, F.lit(1e-12)))
    logistic = lambda x: 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), x))))
    rows = voted.withColumn("j", judged(F.col("row").getField(text)))
    rows = rows.select(
        "row",
        posterior(model.quality, F.col("votes.quality")).alias("posterior"),
        logistic(F.col("j.p")).alias("score"),
        posterior(model.toxicity, F.col("votes.toxicity")).alias("not_toxic"),
        logistic(F.col("j.q")).alias("toxic_score"),
    )
    good = odd(F.col("posterior")) + odd(F.col("score")) > 0
    clean = (odd(F.col("not_toxic")) + odd(F.col("toxic_score")) > 0) if marks else F.lit(True)
    some = F.trim(F.coalesce(F.col("row").getField(text), F.lit(""))) != ""
    new = ("posterior", "score", "not_toxic", "toxic_score", "keep")
    return rows.select(*unpacked(columns, *new), *new[:-1], (good & clean & some).alias("keep"))
