"""The package's operators as queries over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import ann, bpe, conversations, decontam, htmltext, langid, licenses, linededup, periodic, quality, sharding, simhash, warc

RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    _, host = langid.page_evidence(F.col("html"), F.col("url"))
    found = htmltext.extract(pages, host)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return quality.fit_and_classify(docs, labels=_table(spark, folder, "labels")).drop("text")


def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(_table(spark, folder, "embeddings"))


def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(_table(spark, folder, "pages"))


def simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))


def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    docs = bpe.encode_and_decode(_table(spark, folder, "documents").select("doc_id", "text"), vocabulary)
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(bpe.joined_ids(F.col("ids")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(_table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    model = langid.fit_text_model(docs, "text", "lang")
    found = langid.identify(docs, model, declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", F.col("lang").alias("declared"), "detected", "posterior", "accepted")


def language_id_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The same operator where markup and addresses are at hand."""
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    declared, host = langid.page_evidence(F.col("html"), F.col("url"))
    pages = pages.select("page_id", declared.alias("declared"), host.alias("host"), langid.visible_text(F.col("html")).alias("text"))
    model = langid.fit_text_model(pages, "text", "declared")
    found = langid.identify(pages, model, declared=F.col("declared"), host=F.col("host"))
    return found.select("page_id", "host", "declared", "detected", "posterior", "accepted")


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    edits = conversations.repair(conversations.damaged(given))
    return conversations.summary(edits, given.select(F.col("conv_id").alias("conv"))).withColumnRenamed("conv", "conv_id")


def periodic_run_detection(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.with_periodic_runs(docs).withColumn("best", F.col("found.strongest"))
    lines = F.transform("found.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # each run on a line of its own, the last one too
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("found.runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
    )


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.with_licenses(_table(spark, folder, "documents").select("doc_id", "text"), into="found")
    base = F.filter("found.places", lambda p: p["template"] < len(licenses.PHRASES))
    starts = F.transform(base, lambda p: p["start"])
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return found.select(
        "doc_id", "found.n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels("found.places").alias("labels"), "found.score",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": html_extraction,
        "op2_quality_classifier": quality_classifier,
        "op3_benchmark_decontamination": benchmark_decontamination,
        "op4_nearest_neighbours": nearest_neighbours,
        "op5_warc": warc_archives,
        "op6_simhash_near_duplicates": simhash_near_duplicates,
        "op7_line_dedup": line_dedup,
        "op8_byte_level_bpe": byte_level_bpe,
        "op9_sharding": shards,
        "op10_language_id": language_id,
        "op11_conversation_repair": conversation_repair,
        "op12_periodic_runs": periodic_run_detection,
        "op13_license_scan": license_scan,
        "language_id_pages": language_id_pages,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc": """
            WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
            q AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
            r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM q)
            SELECT page_id, payload_bytes, payload_digest,
                   CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
            FROM r
        """,
    }
