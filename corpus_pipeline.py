"""A training corpus from raw documents: language, repeated passages, near duplicates, benchmark passages, token ids.

Every stage takes (spark, docs, sf_dir) and returns a frame; each result is stored and read again as the next one's
docs. All but the last return the columns of ``documents``. Repeated rows are near duplicates of one another, so one
stays; an empty table gives an empty table through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, decontam, langid, linededup, simhash
from tidelog.llm.common import stored
from tidelog.llm.queries import RANKS


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told; a null, empty or blank text has none and goes."""
    model = langid.fit_text_model(docs, "text", "lang")
    found = langid.identify(docs, model, declared=F.col("lang"), host=F.col("source"))
    return found.where("accepted").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand in an earlier one; those that lose all their text go.

    Near duplicates do not cut each other, and are all cut alike: else what differs between them would be left as
    documents that the next stage can no longer tell. It finds whole near duplicates and keeps one.
    """
    classes = simhash.classes_of_texts(docs).withColumnRenamed("component", "party")
    # stored first: a filter on the new text would make Catalyst copy the nested chunk expressions into it
    cut = stored(linededup.dedup_lines(docs, together=classes), "lines")
    cut = cut.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return cut.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id, one of those that share it."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; an empty benchmark keeps all."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text again; a null text counts as an empty one."""
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    coded = bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), vocabulary)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("byte_level_bpe", tokens),
]

#: Trigram likelihoods, hash chunks, CGK walks and BPE merges have no SQL; the operators are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
