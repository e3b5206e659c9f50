"""Every operator as a query over the given tables, with the same query in SQL.

Queries take a session and a folder of Parquet tables. They run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.time import time_positions
from tidelog.operators.columns import with_sanitized_columns
from tidelog.operators.dimensions import distinct_projection
from tidelog.operators.distance import TRIP_COORDINATES, great_circle_distance
from tidelog.operators.facts import first_facts
from tidelog.operators.pairing import adjacent_pairs, ordinal_pairs
from tidelog.operators.report import report_lines, vote_report
from tidelog.operators.selection import select_events
from tidelog.operators.skew import ROWS_PER_CHUNK
from tidelog.operators.words import word_count
from tidelog.plans import flows
from tidelog.plans.derived import (
    LOG_EVENTS_SQL,
    archive_files,
    catalogue_pages,
    correspondence_files,
    log_events,
    log_files,
    table,
    trips,
)
from tidelog.schemas import LOG_FIELDS
from tidelog.session import scratch_path
from tidelog.sources.listings import list_catalog_files, list_resource_links
from tidelog.sources.machine_logs import read_machine_logs
from tidelog.sources.tables import read_correspondence, read_partitioned, write_partitioned
from tidelog.sources.zips import read_archive_lines, strict
from tidelog.streaming.incremental import incremental_log_ingest

Query = Callable[[SparkSession, str], DataFrame]

LOG_FILES_GLOB = "*/*.csv"
SINCE = "2024-01-03"

# The chunked queries pair within seven teams of users, each a heavy key for chunks of so few rows: the cut-up path.
ROWS_PER_SMALL_CHUNK = 40
TEAMS = 7


def _keyed_events(spark: SparkSession, folder: str, chunked: bool) -> tuple[DataFrame, str, int]:
    """Events, the key to pair on, and the rows per chunk."""
    events = table(spark, folder, "events")
    if not chunked:
        return events, "user_id", ROWS_PER_CHUNK
    return events.withColumn("team", F.col("user_id") % TEAMS), "team", ROWS_PER_SMALL_CHUNK


def _adjacent(chunked: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        events, key, rows_per_chunk = _keyed_events(spark, folder, chunked)
        kind = F.col("event_type")
        return adjacent_pairs(
            events,
            key,
            "ts",
            kind == "click",
            kind == "purchase",
            tie_break=["event_id"],
            rows_per_chunk=rows_per_chunk,
        )

    return query


def _ordinal(chunked: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        events, key, rows_per_chunk = _keyed_events(spark, folder, chunked)
        kind = F.col("event_type")
        return ordinal_pairs(
            events.withColumn("day", F.to_date("ts")),
            key,
            ["ts", "event_id"],
            [*time_positions(events, "ts"), F.col("event_id")],
            kind == "click",
            kind == "purchase",
            on=["day"],
            carry=["event_id", "value"],
            rows_per_chunk=rows_per_chunk,
        )

    return query


def _select_events(spark: SparkSession, folder: str) -> DataFrame:
    return select_events(
        table(spark, folder, "events"),
        {"event_type": "purchase"},
        time="ts",
        since="2024-01-15",
        text="props",
        parts=['"k": 1', '"k": 7'],
    )


def _first_facts(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("message", F.concat_ws(": ", "event_type", "props"))
    kinds = ["signup", "purchase", "error", "view", "click"]
    return first_facts(events, "user_id", ["ts", "event_id"], "message", {f"first_{k}": (k, ":") for k in kinds})


def _vote_report(spark: SparkSession, folder: str) -> DataFrame:
    events = log_events(table(spark, folder, "events"))
    lines = events.withColumnsRenamed({"machine": "file", "event_id": "block"}).withColumn("line_id", F.lit(0))
    return vote_report(report_lines(lines, SINCE))


def _vote_durations(spark: SparkSession, folder: str) -> DataFrame:
    logs = read_machine_logs(spark, log_files(spark, folder), glob=LOG_FILES_GLOB)
    target = scratch_path(spark, "durations")
    flows.run_vote_durations(logs, target, SINCE)
    stored = spark.read.parquet(target)
    return stored.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("DataHora", "DataHora_Fim")})


def _word_count(spark: SparkSession, folder: str) -> DataFrame:
    return word_count(table(spark, folder, "documents"), "text")


def _word_count_files(spark: SparkSession, folder: str) -> DataFrame:
    source, target = scratch_path(spark, "texts"), scratch_path(spark, "words")
    table(spark, folder, "documents").select("text").write.text(source)
    flows.run_word_count(spark, source, target)
    return spark.read.schema("word string, count long").csv(target, header=True)


def _great_circle_distance(spark: SparkSession, folder: str) -> DataFrame:
    return great_circle_distance(trips(table(spark, folder, "orders")))


def _trip_distance_files(spark: SparkSession, folder: str) -> DataFrame:
    source, target = scratch_path(spark, "trips"), scratch_path(spark, "distances")
    typed = trips(table(spark, folder, "orders"))
    typed.withColumns({name: F.col(name).cast("string") for name in TRIP_COORDINATES}).write.parquet(source)
    flows.run_distance(spark, source, target)
    return spark.read.parquet(target).select("o_orderkey", "o_custkey", "distance")


def _distinct_projection(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_projection(table(spark, folder, "customer"), ["c_nationkey", "c_mktsegment"])


def _write_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    target = scratch_path(spark, "segments")
    write_partitioned(customers, target, ["c_mktsegment"])
    return read_partitioned(spark, target, customers)


def _blank_named(spark: SparkSession, folder: str) -> DataFrame:
    """All customers under awkward names, the balance as the text of a decimal, which is the same everywhere."""
    customers = table(spark, folder, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,2)").cast("string"))
    names = {"c_custkey": "cust key", "c_name": " c name ", "c_nationkey": "nation", "c_acctbal": "acct bal ", "c_mktsegment": "mkt  segment"}
    return customers.select(*[F.col(c).alias(name) for c, name in names.items()])


def _sanitize_columns(spark: SparkSession, folder: str) -> DataFrame:
    return with_sanitized_columns(_blank_named(spark, folder))


def _ingest_csv_to_parquet(spark: SparkSession, folder: str) -> DataFrame:
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "ingested")
    blanks_kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    _blank_named(spark, folder).write.csv(source, header=True, **blanks_kept)
    flows.ingest_csv_to_parquet(spark, source, target)
    return spark.read.parquet(target)


def _read_machine_logs(mode: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        logs = read_machine_logs(spark, log_files(spark, folder), mode=mode, glob=LOG_FILES_GLOB)
        return logs.select(*LOG_FIELDS, F.col("event_time").cast("timestamp_ntz").alias("event_time"))

    return query


def _read_correspondence(spark: SparkSession, folder: str) -> DataFrame:
    return read_correspondence(spark, correspondence_files(spark, folder))


def _correspondence(spark: SparkSession, folder: str) -> DataFrame:
    source, target = correspondence_files(spark, folder), scratch_path(spark, "states")
    flows.run_correspondence_files(spark, source, target)
    return read_partitioned(spark, f"{target}/parquet", read_correspondence(spark, source))


def _list_resource_links(spark: SparkSession, folder: str) -> DataFrame:
    return list_resource_links(table(spark, folder, "pages"), "e").select("page_id", "link", "file_name")


def _list_catalog_files(spark: SparkSession, folder: str) -> DataFrame:
    return list_catalog_files(catalogue_pages(table(spark, folder, "pages"))).select("page_id", "file_name")


def _expand_archives(nested: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        archives = archive_files(spark, folder, nested)
        lines = strict(read_archive_lines(spark, archives, "*.zip", ".dat", "jez" if nested else None, encoding="utf-8"))
        doc_id = F.substring_index("member", ".", 1).cast("long")
        return lines.select(doc_id.alias("doc_id"), "line_no", "line")

    return query


def _incremental_log_ingest(spark: SparkSession, folder: str) -> DataFrame:
    logs, target, progress = (scratch_path(spark, part) for part in ("drops", "taken", "progress"))
    first_days = F.col("date") < F.lit("2024-01-16").cast("date")
    for drop, days in enumerate((first_days, ~first_days)):
        log_files(spark, folder, days, f"{logs}/{drop}")
        incremental_log_ingest(
            spark,
            logs,
            target,
            progress,
            extract=lambda lines: lines.select("machine", "action", "check_code"),
            transform=lambda kept: kept,
            output_format="parquet",
            glob="*/*/*.csv",
        )
    taken = spark.read.parquet(target)
    return taken.groupBy("machine", "action").agg(
        F.count(F.lit(1)).alias("lines"), F.count("check_code").alias("codes")
    )


def queries() -> dict[str, Query]:
    return {
        "adjacent_pairs": _adjacent(chunked=False),
        "adjacent_pairs_chunked": _adjacent(chunked=True),
        "select_events": _select_events,
        "ordinal_pairs": _ordinal(chunked=False),
        "ordinal_pairs_chunked": _ordinal(chunked=True),
        "first_facts": _first_facts,
        "vote_report": _vote_report,
        "vote_durations": _vote_durations,
        "word_count": _word_count,
        "word_count_files": _word_count_files,
        "great_circle_distance": _great_circle_distance,
        "trip_distance_files": _trip_distance_files,
        "distinct_projection": _distinct_projection,
        "write_partitioned": _write_partitioned,
        "sanitize_columns": _sanitize_columns,
        "ingest_csv_to_parquet": _ingest_csv_to_parquet,
        "read_machine_logs": _read_machine_logs("strict"),
        "read_machine_logs_tolerant": _read_machine_logs("tolerant"),
        "read_correspondence": _read_correspondence,
        "correspondence": _correspondence,
        "list_resource_links": _list_resource_links,
        "list_catalog_files": _list_catalog_files,
        "expand_archives": _expand_archives(nested=False),
        "expand_nested_archives": _expand_archives(nested=True),
        "incremental_log_ingest": _incremental_log_ingest,
    }


def _adjacent_sql(key: str, name: str) -> str:
    return f"""
WITH stepped AS (
    SELECT {key} AS {name}, ts, event_type,
           lead(event_type) OVER along AS next_type,
           lead(ts) OVER along AS next_ts
    FROM events
    WHERE event_type IN ('click', 'purchase')
    WINDOW along AS (PARTITION BY {key} ORDER BY ts, event_id)
)
SELECT {name}, ts AS start_time, next_ts AS end_time, date_diff('second', ts, next_ts) AS seconds
FROM stepped
WHERE event_type = 'click' AND next_type = 'purchase'
"""


def _ordinal_sql(key: str, name: str) -> str:
    return f"""
WITH numbered AS (
    SELECT {key} AS {name}, event_id, value, event_type, CAST(ts AS DATE) AS day,
           row_number() OVER (PARTITION BY {key}, event_type ORDER BY ts, event_id) AS ordinal
    FROM events
    WHERE event_type IN ('click', 'purchase')
)
SELECT s.{name}, s.ordinal, s.day, s.event_id AS start_event_id, s.value AS start_value,
       e.event_id AS end_event_id, e.value AS end_value
FROM numbered s
JOIN numbered e ON e.{name} = s.{name} AND e.ordinal = s.ordinal AND e.day = s.day
WHERE s.event_type = 'click' AND e.event_type = 'purchase'
"""


def _first_value_sql(name: str, mark: str, separator: str) -> str:
    value = f"trim(split_part(message, '{separator}', -1))"
    return f"arg_min({value}, event_id) FILTER (contains(message, '{mark}')) AS \"{name}\""


def _vote_report_sql() -> str:
    marks = {
        "Turno da UE": ("Turno da UE", ":"),
        "Modelo de Urna": ("Modelo de Urna", ":"),
        "Fase da UE": ("Fase da UE", ":"),
        "Modo de Carga da UE": ("Modo de carga da UE", "-"),
        "Município": ("Município", ":"),
        "Zona Eleitoral": ("Zona Eleitoral", ":"),
        "Seção Eleitoral": ("Seção Eleitoral", ":"),
    }
    facts = ",\n       ".join(_first_value_sql(name, *mark) for name, mark in marks.items())
    chosen = ", ".join(f'f."{name}"' for name in marks)
    return f"""
WITH lines AS ({LOG_EVENTS_SQL}),
recent AS (SELECT * FROM lines WHERE "date" >= DATE '{SINCE}'),
numbered AS (
    SELECT machine, event_id, "date" AS day, strftime(ts, '%H:%M:%S') AS clock, message, event_type,
           row_number() OVER (PARTITION BY machine, event_type ORDER BY event_id) AS ordinal
    FROM recent
    WHERE event_type IN ('click', 'purchase') AND level = 'INFO' AND action = 'VOTA'
),
facts AS (
    SELECT machine,
       {facts}
    FROM recent GROUP BY machine
)
SELECT s.machine AS file, s.ordinal, s.day, s.clock AS start_clock, s.message AS start_message,
       e.clock AS end_clock, e.message AS end_message, {chosen}
FROM numbered s
JOIN numbered e ON e.machine = s.machine AND e.ordinal = s.ordinal AND e.day = s.day
LEFT JOIN facts f ON f.machine = s.machine
WHERE s.event_type = 'click' AND e.event_type = 'purchase'
"""


_DURATIONS_SQL = f"""
WITH lines AS ({LOG_EVENTS_SQL}),
stepped AS (
    SELECT machine, event_type, date_trunc('second', ts) AS start_time,
           lead(event_type) OVER along AS next_type,
           lead(date_trunc('second', ts)) OVER along AS end_time
    FROM lines
    WHERE action = 'VOTA' AND event_type IN ('click', 'purchase') AND ts >= TIMESTAMP '{SINCE} 00:00:00'
    WINDOW along AS (PARTITION BY machine ORDER BY date_trunc('second', ts), event_id)
)
SELECT machine AS "CodigoUrna", start_time AS "DataHora", end_time AS "DataHora_Fim",
       date_diff('second', start_time, end_time) AS "TempoSec"
FROM stepped
WHERE event_type = 'click' AND next_type = 'purchase'
"""

_WORDS_SQL = r"""
SELECT word, count(*) AS "count"
FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}'']+')) AS word FROM documents)
WHERE regexp_matches(word, '[^'']')
GROUP BY word
"""

_TRIPS_SQL = """
SELECT o_orderkey, o_custkey,
       40.6e0 + (o_orderkey % 200) / 1000.0e0 AS start_station_latitude,
       -74.05e0 + (o_orderkey % 150) / 1000.0e0 AS start_station_longitude,
       40.6e0 + (o_custkey % 200) / 1000.0e0 AS end_station_latitude,
       -74.05e0 + (o_custkey % 150) / 1000.0e0 AS end_station_longitude
FROM orders"""

_MILES_SQL = """
round(2 * 6371000.0e0 * asin(sqrt(least(1.0e0,
    pow(sin((radians(end_station_latitude) - radians(start_station_latitude)) / 2), 2)
    + cos(radians(start_station_latitude)) * cos(radians(end_station_latitude))
    * pow(sin((radians(end_station_longitude) - radians(start_station_longitude)) / 2), 2)
))) / 1609.344e0, 2) AS distance"""


def _read_logs_sql(where: str) -> str:
    return f"""
SELECT stamp, level, machine, action, message,
       CASE WHEN event_type <> 'signup' THEN check_code END AS check_code,
       date_trunc('second', ts) AS event_time
FROM ({LOG_EVENTS_SQL}) {where}
"""


_CORRESPONDENCE_SQL = """
SELECT 2024 AS "AA_ELEICAO", 452 AS "CD_PLEITO", 'S' || c_nationkey AS "SG_UF",
       CAST(c_custkey % 97 AS INTEGER) AS "CD_MUNICIPIO", 'SÃO ' || c_mktsegment AS "NM_MUNICIPIO",
       CAST(c_custkey % 7 AS INTEGER) AS "NR_ZONA", CAST(c_custkey AS INTEGER) AS "NR_URNA_ESPERADA"
FROM customer"""

_LINES_SQL = """
WITH cut AS (
    SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS lines FROM documents WHERE text <> ''
)
SELECT doc_id, unnest(generate_series(1, len(lines))) AS line_no, unnest(lines) AS line FROM cut
"""

_CATALOG_SQL = """
WITH found AS (
    SELECT page_id, regexp_extract_all(html, '<li><a href="/([^"]*)"', 1) AS links FROM pages
),
entries AS (
    SELECT page_id, unnest(generate_series(0, len(links) - 1)) AS place, unnest(links) AS link
    FROM found WHERE len(links) > 0
)
SELECT page_id, split_part(link, '/', -1) || '.zip' AS file_name FROM entries WHERE place % 2 = 0 AND place % 3 <> 2
"""


def oracle_sql() -> dict[str, str]:
    kinds = ["signup", "purchase", "error", "view", "click"]
    firsts = ", ".join(
        f"arg_min(trim(split_part(props, ':', -1)), ROW(ts, event_id)) FILTER (event_type = '{k}') AS first_{k}"
        for k in kinds
    )
    return {
        "adjacent_pairs": _adjacent_sql("user_id", "user_id"),
        "adjacent_pairs_chunked": _adjacent_sql(f"user_id % {TEAMS}", "team"),
        "select_events": """
            SELECT * FROM events
            WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15 00:00:00'
              AND (contains(props, '"k": 1') OR contains(props, '"k": 7'))""",
        "ordinal_pairs": _ordinal_sql("user_id", "user_id"),
        "ordinal_pairs_chunked": _ordinal_sql(f"user_id % {TEAMS}", "team"),
        "first_facts": f"SELECT user_id, {firsts} FROM events GROUP BY user_id",
        "vote_report": _vote_report_sql(),
        "vote_durations": _DURATIONS_SQL,
        "word_count": _WORDS_SQL,
        "word_count_files": _WORDS_SQL,
        "great_circle_distance": f"SELECT *, {_MILES_SQL} FROM ({_TRIPS_SQL})",
        "trip_distance_files": f"SELECT o_orderkey, o_custkey, {_MILES_SQL} FROM ({_TRIPS_SQL})",
        "distinct_projection": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
        "write_partitioned": "SELECT * FROM customer",
        "sanitize_columns": """
            SELECT c_custkey AS cust_key, c_name AS _c_name_, c_nationkey AS nation, c_mktsegment AS mkt__segment,
                   CAST(CAST(c_acctbal AS DECIMAL(15, 2)) AS VARCHAR) AS acct_bal_
            FROM customer""",
        "ingest_csv_to_parquet": """
            SELECT CAST(c_custkey AS VARCHAR) AS cust_key, c_name AS _c_name_,
                   CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS mkt__segment,
                   CAST(CAST(c_acctbal AS DECIMAL(15, 2)) AS VARCHAR) AS acct_bal_
            FROM customer""",
        "read_machine_logs": _read_logs_sql(""),
        "read_machine_logs_tolerant": _read_logs_sql("WHERE event_type <> 'error'"),
        "read_correspondence": f"{_CORRESPONDENCE_SQL} UNION ALL {_CORRESPONDENCE_SQL}",
        "correspondence": f"SELECT DISTINCT * FROM ({_CORRESPONDENCE_SQL})",
        "list_resource_links": r"""
            SELECT page_id, link, split_part(link, '/', -1) AS file_name
            FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)"', 1)) AS link FROM pages)
            WHERE link LIKE '%e'""",
        "list_catalog_files": _CATALOG_SQL,
        "expand_archives": _LINES_SQL,
        "expand_nested_archives": _LINES_SQL,
        "incremental_log_ingest": f"""
            SELECT machine, action, count(*) AS lines,
                   count(CASE WHEN event_type <> 'signup' THEN check_code END) AS codes
            FROM ({LOG_EVENTS_SQL}) WHERE event_type <> 'error' GROUP BY machine, action""",
    }
