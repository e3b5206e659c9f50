"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

Four kinds of evidence about a document's language L are fused as log probabilities:

* text: naive Bayes over hashed letter trigrams, fitted on a bounded sample of labelled rows. Trigrams overlap, so
  the evidence of a text counts as that of ``EVIDENCE`` trigrams at most;
* the declared language (markup or metadata): P(declared | L);
* the address suffix: P(suffix | L);
* the host: P(L | host), smoothed towards the host's domain, and that towards the whole corpus.

The last three come from grouped aggregates over all documents, by the language that the text alone suggests. A
document's own vote is taken out of its host's counts.

Class ``und`` spreads its probability evenly over all trigrams: it wins where no known language explains the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import packed, stored, unpacked

BUCKETS = 1 << 16
#: Rows that the text model is fitted on, about, the same number for each label that has so many.
SAMPLE_ROWS = 20_000
#: Labels with fewer rows in the table are not learnt.
LEAST_ROWS = 5
#: A text's evidence counts as that of so many independent trigrams at most.
EVIDENCE = 60.0
#: Bytes of text worked on at once.
SLICE = 1 << 20
UNKNOWN = "und"

_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


@dataclass
class TextModel:
    """languages[k] scores sum over weights[:, k]; the last language is ``und``."""

    languages: list[str]
    weights: np.ndarray


def trigrams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed trigrams in slices: arrays (number of the text, bucket). Only trigrams around a letter count."""
    begun, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE or k + 1 == len(texts):
            yield from _sliced(texts[begun : k + 1], begun)
            begun, size = k + 1, 0


def _sliced(texts: list[str | None], first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    coded = [f" {text.lower()} ".encode("utf-8", "replace") if text else b"  " for text in texts]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    raw = _KEEP[np.frombuffer(b"".join(coded), np.uint8)]
    owner = np.repeat(np.arange(first, first + len(coded)), lengths)
    for begin in range(0, len(raw) - 2, 4 * SLICE):
        part = raw[begin : begin + 4 * SLICE + 2]
        key = (part[:-2].astype(np.uint32) << 16) | (part[1:-1].astype(np.uint32) << 8) | part[2:]
        who = owner[begin + 1 : begin + 1 + len(key)]
        good = part[1:-1] != 32
        yield who[good], ((key[good] * np.uint32(2654435769)) >> np.uint32(16)).astype(np.int64)


def fit_text_model(labelled: DataFrame, text: str, label: str, rows: int = SAMPLE_ROWS) -> TextModel:
    """Fits the trigram model on about ``rows`` labelled rows, an equal share for every label that has LEAST_ROWS in
    the table. Distinct texts are drawn, by a hash, so a group of copies counts once however large it is.

    Each task counts (label, trigram) pairs of its rows; what reaches the driver is one count per pair.
    """
    narrow = labelled.select(F.col(text).alias("text"), language_tag(F.col(label)).alias("label")).where("text <> '' and label is not null")
    sizes = {r["label"]: r["count"] for r in narrow.groupBy("label").count().where(F.col("count") >= LEAST_ROWS).collect()}
    kept = sorted(sizes)
    span = 1 << 40
    shares = [x for k in kept for x in (F.lit(k), F.lit(int(span * min(1.0, rows / len(kept) / sizes[k]))))]
    drawn = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(span)) < F.try_element_at(F.create_map(*shares), F.col("label")) if kept else F.lit(False)
    sample = stored(narrow.where(drawn).dropDuplicates(["text", "label"]), "langid-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(kept), BUCKETS), np.int64)
        place = {x: k for k, x in enumerate(kept)}
        for batch in batches:
            numbers = np.array([place.get(x, -1) for x in batch["label"].to_pylist()], np.int64)
            for who, bucket in trigrams(batch["text"].to_pylist()):
                cell = numbers[who]
                known = cell >= 0
                if known.any():
                    sums += np.bincount(cell[known] * BUCKETS + bucket[known], minlength=sums.size).reshape(sums.shape)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums.ravel()[cells])], ["cell", "n"])

    sums = np.zeros(len(kept) * BUCKETS)
    if kept:
        counted = sample.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        sums[counted["cell"].to_numpy(np.int64)] = counted["n"].to_numpy()
    sums = sums.reshape(len(kept), BUCKETS)
    smooth = 0.05
    known = np.log((sums + smooth) / (sums.sum(1, keepdims=True) + smooth * BUCKETS))
    weights = np.vstack([known, np.full((1, BUCKETS), -np.log(BUCKETS))]).T
    return TextModel([*kept, UNKNOWN], np.ascontiguousarray(weights, np.float32))


def language_tag(value: Column) -> Column:
    """Primary subtag in lower case, or null: 'de-AT' is 'de'."""
    found = F.regexp_extract(F.lower(value), r"^\s*([a-z]{2,3})(?:[-_].*)?\s*$", 1)
    return F.when(found != "", found)


def text_evidence(model: TextModel, text: Column) -> Column:
    """Log likelihood of the text for each language of the model; an empty array without letters."""
    weights = model.weights

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            listed = [x if isinstance(x, str) else None for x in texts]
            sums, n = np.zeros((len(listed), weights.shape[1])), np.zeros(len(listed), np.int64)
            for who, bucket in trigrams(listed):
                if len(who):
                    starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                    sums[who[starts]] += np.add.reduceat(weights[bucket], starts, axis=0, dtype=np.float64)
                    n[who[starts]] += np.diff(np.r_[starts, len(who)])
            scale = np.minimum(1, EVIDENCE / np.maximum(n, 1))
            yield pd.Series([row.tolist() if k else [] for row, k in zip(sums * scale[:, None], n, strict=True)])

    # not deterministic for Catalyst, which would otherwise run it again for a filter on its result
    return F.pandas_udf(_typed(score), "array<double>").asNondeterministic()(text)


def _typed(function):
    function.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return function


def host_parts(host: Column) -> tuple[Column, Column]:
    """(domain, suffix) of a host name: its last two labels and its last one."""
    labels = F.split(F.lower(host), r"\.")
    many = F.size(labels) >= 2
    domain = F.when(many, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.lower(host))
    return domain, F.when(many, F.element_at(labels, -1))


def identify(
    frame: DataFrame,
    model: TextModel,
    text: str = "text",
    declared: Column | None = None,
    host: Column | None = None,
    least: float = 0.5,
    smoothing: float = 10.0,
) -> DataFrame:
    """The frame with columns detected, posterior and accepted, which replace columns of these names.

    ``declared`` and ``host`` are expressions over the frame's columns. Null, empty and letterless texts give
    detected ``und``, posterior 0 and are not accepted; a language whose posterior is below ``least``, and ``und``,
    are not accepted either. A null declaration, host or suffix is no evidence. Repeated rows are each judged, alike.
    An empty table gives an empty table.
    """
    names, size = model.languages, len(model.languages)
    null = F.lit(None).cast("string")
    wide = frame.select(packed(frame), (null if declared is None else declared).alias("declared"), (null if host is None else host).alias("host"))
    domain, suffix = host_parts(F.col("host"))
    base = wide.select(
        "row",
        F.coalesce(language_tag(F.col("declared")), F.lit("")).alias("declared"),
        F.coalesce(F.lower("host"), F.lit("")).alias("host"),
        F.coalesce(domain, F.lit("")).alias("domain"),
        F.coalesce(suffix, F.lit("")).alias("suffix"),
    )
    scored = base.withColumn("ll", text_evidence(model, F.col("row").getField(text)))
    top = F.when(F.size("ll") > 0, F.array_position("ll", F.array_max("ll")).cast("int") - 1)
    votes = scored.select("declared", "host", "domain", "suffix", top.alias("k")).where("k is not null")
    votes = stored(votes.groupBy("declared", "host", "domain", "suffix", "k").count(), "langid-votes")

    def counts(*keys: str) -> DataFrame:
        """A row per key with the counts of each language."""
        return votes.groupBy(*keys).agg(F.array(*[F.sum(F.when(F.col("k") == k, F.col("count")).otherwise(0)).cast("double") for k in range(size)]).alias("n"))

    whole = np.array([x or 0.0 for x in counts().first()["n"]]) + 1.0
    prior = (whole / whole.sum()).tolist()
    # P(value | L), each with a share for unseen values; joined by key, so Spark broadcasts only what it knows to be small
    total = F.array(*[F.lit(float(x)) for x in whole])
    likely = F.transform(F.arrays_zip("n", total.alias("t")), lambda x: F.log((x["n"] + 0.5) / (x["t"] + 50.0)))
    by_declared = stored(counts("declared").where("declared <> ''").select("declared", likely.alias("by_declared")), "langid-declared")
    by_suffix = stored(counts("suffix").where("suffix <> ''").select("suffix", likely.alias("by_suffix")), "langid-suffix")
    first = F.array(*[F.lit(x) for x in prior])
    shrunk = F.transform(F.arrays_zip("n", first.alias("p")), lambda x: x["n"] + F.lit(smoothing) * x["p"])
    domains = counts("domain").select("domain", shrunk.alias("d"))
    hosts = counts("host", "domain").where("host <> ''").join(domains, "domain").select("host", "n", "d")
    by_host = stored(hosts.select("host", F.col("n").alias("by_host"), F.col("d").alias("by_domain")), "langid-hosts")

    joined = scored.join(by_declared, "declared", "left").join(by_suffix, "suffix", "left").join(by_host, "host", "left")
    joined = joined.withColumn("top", top)
    none = F.array(*[F.lit(0.0)] * size)

    def own(k: Column) -> Column:
        return (F.col("top") == k).cast("double")

    # the document's own vote goes out of its domain's counts and out of its host's
    domain_sum = F.aggregate("by_domain", F.lit(0.0), lambda a, x: a + x) - 1
    host_sum = F.aggregate("by_host", F.lit(0.0), lambda a, x: a + x) - 1
    joined = joined.withColumns({"domain_sum": domain_sum, "host_sum": host_sum})
    prior_at = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda k: F.log(
            F.greatest(
                (
                    F.coalesce(F.get("by_host", k), F.lit(0.0)) - F.when(F.col("by_host").isNotNull(), own(k)).otherwise(0.0)
                    + F.lit(smoothing) * F.coalesce((F.get("by_domain", k) - own(k)) / F.col("domain_sum"), F.get(first, k))
                )
                / (F.coalesce("host_sum", F.lit(0.0)) + F.lit(smoothing)),
                F.lit(1e-9),
            )
        ),
    )
    fused = joined.withColumn("prior", prior_at).withColumn(
        "fused",
        F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)),
            lambda k: F.get("ll", k) + F.get(F.coalesce("by_declared", none), k) + F.get(F.coalesce("by_suffix", none), k) + F.get("prior", k),
        ),
    )
    fused = fused.withColumn("peak", F.array_max("fused"))
    fused = fused.withColumn("posterior", F.when(F.size("ll") > 0, 1 / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("peak")))).otherwise(F.lit(0.0)))
    listed = F.array(*[F.lit(x) for x in names])
    detected = F.when(F.size("ll") > 0, F.get(listed, (F.array_position("fused", F.col("peak")) - 1).cast("int"))).otherwise(F.lit(UNKNOWN))
    fused = fused.withColumn("detected", detected)
    accepted = (F.col("detected") != UNKNOWN) & (F.col("posterior") >= least)
    return fused.select(*unpacked(frame.columns, "detected", "posterior", "accepted"), "detected", "posterior", accepted.alias("accepted"))


def page_evidence(html: Column, url: Column) -> tuple[Column, Column]:
    """(declared language, host) of a web page: the lang attribute of its html tag and the host of its address."""
    lang = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(lang != "", lang), F.when(host != "", host)


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and markup, for the trigram model."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&#?\w+;", " ")
