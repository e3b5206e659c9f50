"""Inputs in the shapes the readers expect, made by Spark from whole tables."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.schemas import HEADER_FACTS, LOG_FIELDS, STAMP_FORMAT, VOTE_ACTION, VOTE_END, VOTE_LEVEL, VOTE_START
from tidelog.session import scratch_path
from tidelog.sources.machine_logs import NO_SEPARATOR

# Executors need not have this package installed: the functions they run travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def log_events(events: DataFrame) -> DataFrame:
    """Events in the words of a machine log: clicks enable a voter, purchases record the vote.

    Other events report a header fact or nothing of interest, some lines have another level or
    action. One log per user, in event order.
    """
    said = [F.lit(f"{mark}{separator} ") for mark, separator in HEADER_FACTS.values()]
    other = F.get(F.array(*said), (F.col("event_id") % 9).cast("int"))
    message = (
        F.when(F.col("event_type") == "click", F.lit(VOTE_START))
        .when(F.col("event_type") == "purchase", F.lit(VOTE_END))
        .otherwise(F.coalesce(F.concat(other, "props"), F.lit("Tecla indevida")))
    )
    return events.select(
        "event_id",
        "event_type",
        F.to_date("ts").alias("date"),
        F.date_format("ts", STAMP_FORMAT).alias("stamp"),
        F.when(F.col("event_id") % 11 == 0, "ALERTA").otherwise(VOTE_LEVEL).alias("level"),
        F.col("user_id").cast("string").alias("machine"),
        F.when(F.col("event_id") % 13 == 0, "LOGD").otherwise(VOTE_ACTION).alias("action"),
        message.alias("message"),
        F.col("event_id").cast("string").alias("check_code"),
    )


# The same lines for a SQL engine without Spark's functions.
LOG_EVENTS_SQL = """
SELECT event_id, event_type, user_id, CAST(ts AS DATE) AS "date", ts,
       strftime(ts, '%d/%m/%Y %H:%M:%S') AS stamp,
       CASE WHEN event_id % 11 = 0 THEN 'ALERTA' ELSE 'INFO' END AS level,
       CAST(user_id AS VARCHAR) AS machine,
       CASE WHEN event_id % 13 = 0 THEN 'LOGD' ELSE 'VOTA' END AS action,
       CASE WHEN event_type = 'click' THEN 'Eleitor foi habilitado'
            WHEN event_type = 'purchase' THEN 'O voto do eleitor foi computado'
            ELSE CASE event_id % 9
                 WHEN 0 THEN 'Turno da UE: ' || props
                 WHEN 1 THEN 'Modelo de Urna: ' || props
                 WHEN 2 THEN 'Fase da UE: ' || props
                 WHEN 3 THEN 'Modo de carga da UE- ' || props
                 WHEN 4 THEN 'Município: ' || props
                 WHEN 5 THEN 'Zona Eleitoral: ' || props
                 WHEN 6 THEN 'Seção Eleitoral: ' || props
                 ELSE 'Tecla indevida' END
       END AS message,
       CAST(event_id AS VARCHAR) AS check_code
FROM events"""


def write_log_files(lines: DataFrame, path: str) -> None:
    """Latin-1 log files, one folder per day, lines in event order.

    Errors get a seventh field and sign-ups lack the sixth, so readers meet long and short lines.
    """
    fields = [F.col(name) for name in LOG_FIELDS]
    line = (
        F.when(F.col("event_type") == "error", F.concat_ws("\t", *fields, F.lit("")))
        .when(F.col("event_type") == "signup", F.concat_ws("\t", *fields[:5]))
        .otherwise(F.concat_ws("\t", *fields))
    )
    (
        lines.select("date", "event_id", line.alias("line"))
        .repartitionByRange("date", "event_id")
        .sortWithinPartitions("date", "event_id")
        .select("date", "line")
        .write.partitionBy("date")
        .options(sep=NO_SEPARATOR, quote="", escape="", encoding="ISO-8859-1", header=False)
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def log_files(spark: SparkSession, folder: str, between: Column | None = None, path: str | None = None) -> str:
    """Writes the log files of a table folder's events and returns their path."""
    lines = log_events(table(spark, folder, "events"))
    target = path or scratch_path(spark, "logs")
    write_log_files(lines if between is None else lines.where(between), target)
    return target


def trips(orders: DataFrame) -> DataFrame:
    """Orders as trips; the data has no coordinates, so they are computed from the keys."""

    def degrees(base: float, key: str, steps: int) -> Column:
        return F.lit(base) + F.col(key) % steps / F.lit(1000.0)

    return orders.select(
        "o_orderkey",
        "o_custkey",
        degrees(40.6, "o_orderkey", 200).alias("start_station_latitude"),
        degrees(-74.05, "o_orderkey", 150).alias("start_station_longitude"),
        degrees(40.6, "o_custkey", 200).alias("end_station_latitude"),
        degrees(-74.05, "o_custkey", 150).alias("end_station_longitude"),
    )


def correspondence_files(spark: SparkSession, folder: str) -> str:
    """Customers as a machine/precinct table in semicolon files, every row twice, with a spare column."""
    state = F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))
    rows = table(spark, folder, "customer").select(
        F.lit(2024).alias("AA_ELEICAO"),
        F.lit("x").alias("DS_EXTRA"),
        F.lit(452).alias("CD_PLEITO"),
        state.alias("SG_UF"),
        (F.col("c_custkey") % 97).alias("CD_MUNICIPIO"),
        F.concat(F.lit("SÃO "), "c_mktsegment").alias("NM_MUNICIPIO"),
        (F.col("c_custkey") % 7).alias("NR_ZONA"),
        F.col("c_custkey").alias("NR_URNA_ESPERADA"),
    )
    target = scratch_path(spark, "correspondence")
    for _ in range(2):
        rows.write.mode("append").csv(target, sep=";", header=True, encoding="ISO-8859-1")
    return target


def catalogue_pages(pages: DataFrame) -> DataFrame:
    """Each page's links as a catalogue of files: every second one a ZIP, every third without a link."""
    links = F.regexp_extract_all("html", F.lit(r'<li><a href="/([^"]*)"'), F.lit(1))

    def entry(link: Column, at: Column) -> Column:
        kind = F.when(at % 2 == 0, F.lit(".zip")).otherwise(F.lit(".pdf"))
        opening = '<ul><li><a class="btn resource-url-analytics" href="https://files.example/d/'
        download = F.concat(F.lit(opening), link, kind, F.lit('">get</a></li></ul>'))
        heading = F.concat(F.lit('<li><a class="heading" title="'), link, F.lit('">'), link, F.lit("</a>"))
        return F.concat(heading, F.when(at % 3 == 2, F.lit("")).otherwise(download), F.lit("</li>"))

    listing = F.array_join(F.transform(links, entry), "\n")
    noise = '<ul><li><a class="heading" title="n">n</a><a class="resource-url-analytics" href="/n.zip">n</a></li></ul>'
    return pages.select(
        "page_id",
        F.concat(F.lit(noise + '<ul class="resource-list">'), listing, F.lit("</ul>" + noise)).alias("html"),
    )


DOCUMENTS_PER_ARCHIVE = 40


def archive_files(spark: SparkSession, folder: str, nested: bool) -> str:
    """Documents packed into ZIP archives by the tasks, in files; returns their folder.

    Plain archives hold one text member per document. Nested ones hold one archive per document. A
    task that runs again writes the same files again.
    """
    target = scratch_path(spark, "archives")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(target)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS_PER_ARCHIVE):
                rows = batch.slice(start, DOCUMENTS_PER_ARCHIVE)
                names, texts = rows["doc_id"].to_pylist(), rows["text"].to_pylist()
                files = [(f"{name}.dat", (text or "").encode()) for name, text in zip(names, texts, strict=True)]
                if nested:
                    files = [(f"{name}.jez", _zipped([file])) for name, file in zip(names, files, strict=True)]
                with system.open_output_stream(f"{root}/{names[0]}.zip", compression=None) as out:
                    out.write(_zipped(files))
                yield pa.record_batch([pa.array([len(files)], pa.int64())], names=["members"])

    documents = table(spark, folder, "documents").select("doc_id", "text")
    dealt = documents.repartition("doc_id").sortWithinPartitions("doc_id")
    dealt.mapInArrow(pack, "members long").write.format("noop").mode("overwrite").save()
    return target


def _zipped(files: list[tuple[str, bytes]]) -> bytes:
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
        for name, content in files:
            archive.writestr(name, content)
    return held.getvalue()
