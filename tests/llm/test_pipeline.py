"""The pipeline as a whole, and what its stages leave to each other."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import ODD, TABLES
from tidelog.llm import linededup, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n=9, letters="abcdefghijkl"):
    return " ".join("".join(rng.choice(list(letters), 6)) for _ in range(n))


def through(spark, rows, stages):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    for stage in stages:
        docs = stage(spark, docs, "")
    return sorted((r.doc_id, r.text) for r in docs.collect())


DEDUP = (corpus_pipeline.lines, corpus_pipeline.near_duplicates)


def test_one_of_each_group_of_copies_is_left(spark):
    rng = np.random.default_rng(6)
    groups = ["\n".join(words(rng) for _ in range(1 + g)) for g in range(12)]
    rows = [(d * 100 + g, t) for d in range(5) for g, t in enumerate(groups)]
    assert through(spark, rows, DEDUP) == list(enumerate(groups))


def test_one_of_each_group_of_near_copies_is_left(spark):
    """Near copies within the distance of the near-dedup stage do not leave their differences behind."""
    rng = np.random.default_rng(7)
    rows, classes = [], 0
    for g in range(20):
        text = [words(rng) + "." for _ in range(60)]
        for d in range(4):
            own = list(text)
            own[int(rng.integers(0, 60))] += " changed."
            rows.append((d * 100 + g, "\n".join(own)))
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    left = [i for i, _ in through(spark, rows, DEDUP)]
    # at most one of each class, as from the near-dedup stage alone
    assert len({classes[i] for i in left}) == len(left) < 40


def test_passages_go_from_all_documents_of_a_class(spark):
    rng = np.random.default_rng(8)
    passage = "\n".join(words(rng) + "." for _ in range(9))
    own = [[words(rng) + "." for _ in range(30)] for _ in range(3)]
    rows = [(0, "\n".join([*own[0], passage])), (1, "\n".join([*own[1], passage])), (2, "\n".join([*own[1], passage])), (3, "\n".join(own[2]))]
    assert through(spark, rows, DEDUP) == [(0, rows[0][1]), (1, "\n".join(own[1])), (3, rows[3][1])]


def test_line_stage_runs_no_python(spark, monkeypatch):
    plans = []

    def noted(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(frame, label)

    keep = simhash.stored
    for module in (simhash, linededup, corpus_pipeline):
        monkeypatch.setattr(module, "stored", noted)
    rng = np.random.default_rng(9)
    text = [words(rng) + "." for _ in range(40)]
    rows = [(d, "\n".join([*text[: 30 + d % 5], words(rng)])) for d in range(20)]
    assert through(spark, rows, (corpus_pipeline.lines,))
    assert len(plans) > 5 and not any(x in p for p in plans for x in ("Python", "Arrow", "Pandas"))


def test_built_in_classes_are_those_of_the_near_dedup_stage(spark):
    rows = [*ODD, (100, "One"), (101, "One tWo"), (102, "A \x0b b\tC\n"), (103, "Ünï Ö b " + "x y z " * 30_000), (104, None), (104, None)]
    rows += [(200 + k, f"a text with few words that are another at place {k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = docs.select("doc_id", simhash.fingerprints(F.col("text")).alias("fp"))
    assert sorted(simhash.with_fingerprints(docs, "text").collect(), key=str) == sorted(own.collect(), key=str)
    classes = {r.text_hash: r.component for r in simhash.classes_of_texts(docs).collect()}
    there = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    hashes = docs.select("doc_id", F.xxhash64("text").alias("h")).collect()
    assert {(r.doc_id, classes.get(r.h)) for r in hashes} == there
    assert simhash.classes_of_texts(docs.limit(0)).count() == 0


def test_built_in_links_connect_as_brute_force(spark):
    rng = np.random.default_rng(10)
    seeds = rng.integers(-(1 << 62), 1 << 62, 40)
    values = {int(s) for s in seeds}
    for s in seeds[:8].tolist():
        at = s
        for _ in range(60):
            for b in rng.choice(63, 2, replace=False).tolist():
                at ^= 1 << b
            values.add(at if rng.random() < 0.5 else s ^ (1 << int(rng.integers(63))))
    values = np.array(sorted(values), np.int64)
    root = {int(x): int(x) for x in values}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    def classes(links):
        for x in root:
            root[x] = x
        for a, b in links:
            root[max(top(a), top(b))] = min(top(a), top(b))
        return {x: top(x) for x in root}

    u = values.view(np.uint64)
    close = np.argwhere(np.bitwise_count(u[:, None] ^ u[None, :]) <= 3)
    expected = classes([(int(values[a]), int(values[b])) for a, b in close if a < b])
    nodes = spark.createDataFrame([(int(x),) for x in values], "fp long")
    # small parts, so that parts meet
    for part in (16, 1024):
        assert classes([tuple(r) for r in simhash.close_links(nodes, part=part, built_in=True).collect()]) == expected


def run_on(spark, folder, documents):
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{TABLES}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(folder)).collect()


def test_whole_pipeline_with_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    odd = [(10**9 + k, t, "en", "s", 0) for k, t in enumerate([None, "", " \n", "x" * 200_000])] + [(None, None, None, None, None)]
    both = docs.unionByName(spark.createDataFrame(odd, SCHEMA).select(docs.columns))
    # all rows twice: one of each stays
    found = run_on(spark, tmp_path / "twice", both.union(both))
    assert found and all(r.decodes and r.n_tokens == len(r.ids) > 0 for r in found)
    ids = {r.doc_id for r in found}
    assert len(ids) == len(found) and not ids & {None, 10**9, 10**9 + 1, 10**9 + 2}
    once = {r.doc_id for r in run_on(spark, tmp_path / "once", docs)}
    # the odd rows and the doubled ones change counts, and with them few languages in doubt
    assert len((ids - {10**9 + 3}) ^ once) <= 0.01 * len(once)
    assert len(once) > 0.6 * docs.count()


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    assert run_on(spark, tmp_path / "empty", docs.limit(0)) == []


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_level_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("text", [None, "", " "])
def test_texts_without_words_go_at_the_first_stage(spark, text):
    docs = spark.createDataFrame([(1, text, "en", "s", 0), *((k, f"the one and only text number {k} of this table", "en", "s", 0) for k in range(2, 12))], SCHEMA)
    assert all(r.doc_id != 1 for r in corpus_pipeline.language(spark, docs, "").collect())
