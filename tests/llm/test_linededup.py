"""Line dedup against its rule in plain Python, and shares of planted passages."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.test_operators import ODD, TABLES
from tidelog.llm import linededup


def bodies_of(text):
    return [u.strip(" ") for line in (text or "").split("\n") for u in re.split(r" (?<=[.!?…] )(?=[^ \t\n\x0b\f\r])", line)]


def begins(bodies):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in bodies]
    pair = lambda a, b: signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)))
    r = [float("inf"), *map(pair, h, h[1:]), float("inf")]
    return [i for i in range(len(h) - 1) if i == 0 or (r[i] <= r[i - 1] and r[i] <= r[i + 1])]


def brute(rows, party=None):
    """Numbers of the units that go, by key, comparing texts as they are."""
    docs = {key: bodies_of(text) for key, text in rows}
    group = (lambda k: party[k]) if party else (lambda k: k)
    first = {}
    for key in sorted(docs, key=lambda k: (group(k), k)):
        for at in begins(docs[key]):
            first.setdefault(tuple(docs[key][at : at + 2]), (key, at))
    gone = defaultdict(set)
    for key, own in docs.items():
        met = defaultdict(list)
        for at in begins(own):
            other, there = first[tuple(own[at : at + 2])]
            if (other, there) != (key, at) and (party is None or group(other) != group(key)):
                met[other, there - at].append(at)
        for (other, shift), ats in met.items():
            theirs = docs[other]
            low, high = max(0, -shift, min(ats) - 8), min(len(own), len(theirs) - shift, max(ats) + 10)
            equal = lambda i: low <= i < high and own[i] == theirs[i + shift]  # noqa: B023, E731
            for at in ats:
                start, end = at, at + 2
                while equal(start - 1):
                    start -= 1
                while equal(end):
                    end += 1
                if len("\n".join(own[start:end])) >= 40:
                    gone[key].update(range(start, end))
    return gone


def words(rng, n=9):
    return " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()}


def test_equals_brute_force(spark, texts):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    found = linededup.dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_removed", "removed_chars"]
    rows = {r.doc_id: r for r in found.collect()}
    gone = brute(list(texts.items()))
    assert {i: r.n_removed for i, r in rows.items()} == {i: len(gone[i]) for i in texts}
    for i, r in rows.items():
        bodies = bodies_of(texts[i])
        left = [b for k, b in enumerate(bodies) if k not in gone[i]]
        assert Counter(x for x in bodies_of(r.text) if x) == Counter(x for x in left if x)
        if not gone[i]:
            assert r.text == texts[i] and r.removed_chars == 0


def test_small_alphabets_equal_brute_force(spark):
    """Many ties, repeats within documents, and stretches that begin alike and go on differently."""
    rng = np.random.default_rng(3)
    lines = [f"line number {k} with some more words in it." for k in range(6)]
    rows = [(d, "\n".join(str(x) for x in rng.choice(lines, int(rng.integers(1, 40))))) for d in range(120)]
    gone = brute(rows)
    found = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in found} == {d: len(gone[d]) for d, _ in rows}


def test_documents_together_do_not_cut_each_other(spark):
    rng = np.random.default_rng(4)
    passages = [[words(rng) + "." for _ in range(6)] for _ in range(5)]
    rows = [(d, "\n".join([words(rng) + ".", *passages[d % 5], words(rng) + "."])) for d in range(40)]
    party = {d: d % 10 for d, _ in rows}
    gone = brute(rows, party)
    frame = spark.createDataFrame([(*r, party[r[0]]) for r in rows], "doc_id long, text string, class long")
    classes = frame.select(F.xxhash64("text").alias("text_hash"), F.col("class").alias("party"))
    found = {r.doc_id: r.n_removed for r in linededup.dedup_lines(frame, together=classes).collect()}
    assert found == {d: len(gone[d]) for d, _ in rows}
    # parties 0 to 4 hold the passages first, in all their documents; 5 to 9 lose them in all
    assert all((n > 0) == (d % 10 >= 5) for d, n in found.items())


def test_documents_meet_once(spark):
    """Stretches that two documents share at many distances take one row."""
    rng = np.random.default_rng(11)
    pair = [words(rng) + ".", words(rng) + "."]
    rows = [(d, "\n".join(x for _ in range(30) for x in [*pair, words(rng) + "."])) for d in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = linededup.alignments(docs, ["doc_id"])
    assert found.count() == found.select("key").distinct().count() <= 20
    gone = brute(rows)
    assert {r.doc_id: r.n_removed for r in linededup.dedup_lines(docs).collect()} == {d: len(gone[d]) for d, _ in rows}
    assert sum(map(len, gone.values())) > 100


def test_documents_ask_once_for_a_repeated_beginning(spark):
    """A line that stands again and again gives one row a document with all its places, in the first document too."""
    rng = np.random.default_rng(12)
    common = "the same line of more than forty characters, again."
    rows = [(d, "\n".join([words(rng) + ".", *[common] * (50 + d), words(rng) + ".", *[common] * 50])) for d in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    heads = linededup.chunk_heads(docs, ["doc_id"]).collect()
    assert len(heads) == len({(r.key, r.h, r.g) for r in heads})
    places = {d: set(begins(bodies_of(t))) for d, t in rows}
    assert sum(len(r.ats) for r in heads) == sum(map(len, places.values())) > 20 * len(heads)
    assert all(r.at == r.ats[0] and r.ats == sorted(r.ats) for r in heads)
    assert {d: {x for r in heads if r.key.doc_id == d for x in r.ats} for d, _ in rows} == places
    gone = brute(rows)
    # twice the same rows are the same documents
    for frame in (docs, docs.union(docs)):
        found = linededup.dedup_lines(frame).collect()
        assert {r.doc_id: r.n_removed for r in found} == {d: len(gone[d]) for d, _ in rows} and len(found) == frame.count()


def test_planted_passages(spark):
    """Shares of passages of one to six lines (two sentences each) that go from a second and third document."""
    rng = np.random.default_rng(5)
    line = lambda: f"{words(rng)}. {words(rng)}."
    passages = {k: [line() for _ in range(1 + k % 6)] for k in range(300)}
    rows = [(d * 1000 + k, "\n".join([line(), *p, line()])) for d in range(2) for k, p in passages.items()]
    rows += [(2000 + k, f"{line()} {' '.join(p)} {line()}") for k, p in passages.items()]
    found = {r.doc_id: r.text for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = Counter()
    for k, p in passages.items():
        assert found[k] == dict(rows)[k]
        for d in (1, 2):
            own, left = dict(rows)[d * 1000 + k], found[d * 1000 + k]
            # the lines around stay
            assert left.startswith(own.split(".")[0]) and left.endswith(own.rsplit(". ", 1)[1])
            gone[len(p)] += not any(x in left for x in p)
    shares = {n: gone[n] / 100 for n in range(1, 7)}
    print(shares)
    assert shares[3] >= 0.8 and shares[4] >= 0.9 and shares[5] >= 0.95 and shares[6] >= 0.95


def test_exact_copies_go_whole(spark):
    rng = np.random.default_rng(6)
    groups = ["\n".join(words(rng) for _ in range(2 + g)) for g in range(30)]
    rows = [(d * 100 + g, t) for d in range(4) for g, t in enumerate(groups)]
    found = {r.doc_id: r.text for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: t if i < 100 else "" for i, t in rows}


def test_odd_rows(spark):
    rows = [(i, t, "en", "h", "r", 1, "c", "k", 5) for i, t in ODD]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string, row string, id int, chunks string, key string, n_removed long")
    odd = odd.withColumns({n: F.lit("x") for n in ("units", "gone", "stay", "at", "party", "low", "compared", "text_hash")})
    found = linededup.dedup_lines(odd).collect()
    assert {(r.doc_id, r.text) for r in found if r.doc_id != 6} == {(i, t) for i, t in ODD if i != 6} and len(found) == len(ODD)
    assert [(r.text, r.n_removed) for r in found if r.doc_id == 6] == [("the same line again and again, as it was before", 199)]
    assert linededup.dedup_lines(odd.limit(0)).count() == 0
    classes = odd.select(F.xxhash64("text").alias("text_hash"), F.lit(1).alias("party")).distinct()
    again = linededup.dedup_lines(odd, order=["lang", "doc_id"], together=classes).collect()
    assert len(again) == len(ODD) and all(r.n_removed == 0 for r in again)
    assert len(linededup.dedup_lines(odd, together=classes.limit(0)).collect()) == len(ODD)


def test_bodies_are_cut_and_hashed_once(spark):
    """The size of the hashes is asked for in a filter; the plan does not compute them again for it."""
    docs = spark.createDataFrame([(1, "one line.\nand another one. And a third"), (2, "one")], "doc_id long, text string")
    found = linededup.chunk_heads(docs, ["doc_id"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    assert {r.at for r in found.collect()} <= {0, 1} and found.count() >= 1
