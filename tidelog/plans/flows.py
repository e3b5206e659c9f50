"""Batch flows behind the command lines in ``tidelog.jobs``.

Each flow runs its transformation once. Counts and second outputs come from the files just written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.text import WORD_PATTERN
from tidelog.operators.columns import with_sanitized_columns
from tidelog.operators.dimensions import distinct_projection
from tidelog.operators.distance import great_circle_distance
from tidelog.operators.pairing import adjacent_pairs
from tidelog.operators.report import report_lines, vote_report, with_report_names
from tidelog.operators.selection import select_events
from tidelog.operators.skew import ROWS_PER_CHUNK
from tidelog.operators.words import word_count
from tidelog.schemas import CORRESPONDENCE_COLUMNS, FIRST_DAY, LOG_FIELDS, VOTE_ACTION, VOTE_END, VOTE_START
from tidelog.session import settled
from tidelog.sources.archives import archive_stem
from tidelog.sources.machine_logs import parse_log_lines, read_machine_logs, with_line_order
from tidelog.sources.tables import append_once, read_csv_untyped, typed_correspondence, write_partitioned
from tidelog.sources.zips import read_archive_lines, strict


def vote_marks(lines: DataFrame, since: str = FIRST_DAY) -> DataFrame:
    """What durations need of a log: the vote events from the first day on, without their text."""
    votes = select_events(
        lines, {"action": VOTE_ACTION}, time="event_time", since=since, text="message", parts=[VOTE_START, VOTE_END]
    )
    return with_line_order(votes).select(
        "machine",
        "event_time",
        # Ties in time follow the names of the files, then their lines.
        "file",
        "block",
        "line_id",
        F.col("message").contains(VOTE_START).alias("is_start"),
        F.col("message").contains(VOTE_END).alias("is_end"),
    )


def vote_durations(marks: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Seconds from each enabled voter to the vote recorded next on the same machine."""
    pairs = adjacent_pairs(
        marks,
        "machine",
        "event_time",
        F.col("is_start"),
        F.col("is_end"),
        tie_break=["file", "block", "line_id"],
        rows_per_chunk=rows_per_chunk,
    )
    # Published names of the result.
    return pairs.select(
        F.col("machine").alias(LOG_FIELDS["machine"]),
        F.col("start_time").alias("DataHora"),
        F.col("end_time").alias("DataHora_Fim"),
        F.col("seconds").alias("TempoSec"),
    )


def run_vote_durations(lines: DataFrame, output: str, since: str = FIRST_DAY) -> int:
    """Durations as Parquet in ``output`` and as headerless CSV below it; returns the number of rows."""
    with settled(vote_marks(lines, since)) as marks:
        vote_durations(marks).write.mode("overwrite").parquet(output)
    stored = lines.sparkSession.read.parquet(output)
    # Fixed value: published name of the CSV.
    stored.write.mode("overwrite").csv(f"{output}/csv/log_urna.csv")
    return stored.count()


def logs_from_archives(spark: SparkSession, path: str, nested_suffix: str | None = None, glob: str = "*") -> DataFrame:
    """Log lines straight out of archives, in the shape of ``read_machine_logs``.

    The archive name stands for the folder it would have been unpacked to, and the line number is
    the position in the file. With ``nested_suffix`` the logs lie in archives inside those. What
    cannot be read fails the job.
    """
    lines = strict(read_archive_lines(spark, path, glob, ".dat", nested_suffix))
    holder = F.coalesce("outer", "archive")
    named = lines.withColumn("_holder", holder).select(
        "line", F.concat_ws("/", archive_stem("_holder"), "member").alias("file"), F.col("line_no").alias("block")
    )
    return parse_log_lines(named, "line", drop_long=False)


def run_vote_report(lines: DataFrame, output: str, since: str = FIRST_DAY) -> int:
    """Ordinal vote pairs with header facts per file, as headered Latin-1 CSV."""
    with settled(report_lines(with_line_order(lines), since)) as extract:
        report = with_report_names(vote_report(extract))
        report.write.mode("overwrite").csv(output, header=True, encoding="ISO-8859-1")
    return lines.sparkSession.read.csv(output, header=True, encoding="ISO-8859-1").count()


def correspondence_from_archives(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """The machine/precinct table out of archives of semicolon CSV files."""
    return typed_correspondence(correspondence_text(spark, path, glob))


def correspondence_text(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """``correspondence_from_archives`` with every column as text.

    All files must have the same header and a record per line; other headers, quoted line breaks and damaged archives
    are errors.
    """
    lines = strict(read_archive_lines(spark, path, glob, "csv"))
    headers = [row["line"] for row in lines.where("line_no = 1").select("line").distinct().limit(2).collect()]
    if not headers:
        raise ValueError(f"no csv file in the archives {glob} below {path}")
    if len(headers) > 1:
        raise ValueError(f"csv files with different headers in the archives {glob} below {path}: {headers}")
    names = [name.strip().strip('"') for name in headers[0].split(";")]
    schema = ", ".join(f"`{name}` string" for name in names)
    broken = F.length(F.regexp_replace("line", '[^"]', "")) % 2 == 1
    place = F.concat_ws(" ", F.lit("record over several lines:"), "archive", "member", F.lit("line"), "line_no")
    line = F.when(broken, F.raise_error(place).cast("string")).otherwise(F.col("line"))
    rows = lines.where("line_no > 1 and line <> ''").select(F.from_csv(line, schema, {"sep": ";"}).alias("row"))
    return rows.select("row.*")


def run_correspondence(text: DataFrame, output: str) -> int:
    """Distinct machine/precinct rows of an all-text table, one directory per state; returns the number of rows.

    Columns get the narrowest types that hold all their values, so no value is lost.
    """
    distinct = distinct_projection(typed_correspondence(text), CORRESPONDENCE_COLUMNS)
    write_partitioned(distinct, f"{output}/parquet", ["SG_UF"])
    return text.sparkSession.read.parquet(f"{output}/parquet").count()


def run_correspondence_files(spark: SparkSession, path: str, output: str) -> int:
    """``run_correspondence`` on unpacked CSV files."""
    return run_correspondence(read_csv_untyped(spark, path, sep=";", encoding="ISO-8859-1"), output)


def ingest_csv_to_parquet(spark: SparkSession, source: str, target: str) -> None:
    """Headered CSV to Parquet under sanitized names, all text; an existing target is an error."""
    with_sanitized_columns(read_csv_untyped(spark, source)).write.mode("errorifexists").parquet(target)


def run_distance(spark: SparkSession, source: str, target: str, job_id: str | None = None) -> None:
    """Trips from Parquet with their distance, appended to the target; with a job id, once however often it runs."""
    far = great_circle_distance(spark.read.parquet(source))
    if job_id is None:
        far.write.mode("append").parquet(target)
    else:
        append_once(far, target, job_id)


def run_word_count(spark: SparkSession, source: str, target: str, pattern: str = WORD_PATTERN, line_end: str | None = None) -> None:
    """Word counts of text files as CSV with a header and quoted values, in word order.

    The files of a large result follow each other in name order; a small one is a single file.
    Files are cut at line ends and so read by many tasks. For texts whose lines are very long, ``line_end=" "`` cuts at
    blanks instead; ``pattern`` must then not match blanks.
    """
    pieces = spark.read.text(source, lineSep=line_end)
    word_count(pieces, "value", pattern).orderBy("word").write.csv(target, header=True, quoteAll=True)


def run_machine_logs_folder(spark: SparkSession, source: str, output: str) -> int:
    """``run_vote_durations`` on unpacked log files, one folder per archive."""
    return run_vote_durations(read_machine_logs(spark, source), output)
