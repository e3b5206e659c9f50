"""Tab-separated machine logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.time import parse_timestamp
from tidelog.schemas import LOG_FIELDS, LOG_SCHEMA, STAMP_FORMAT

# Never part of a log line, so a CSV scan with this separator yields whole lines.
NO_SEPARATOR = "\uffff"

PLACE = {"file": "_metadata.file_path", "block": "_metadata.file_block_start"}


def read_machine_logs(
    spark: SparkSession,
    path: str,
    mode: str = "strict",
    glob: str = "*/*.dat",
    recursive: bool = False,
    encoding: str = "ISO-8859-1",
    quote: str = "",
) -> DataFrame:
    """Log lines with their six fields, event time, file and file block.

    ``mode="strict"`` reads by schema: a long line is cut to six fields. ``mode="tolerant"`` drops
    long lines, ``mode="flagged"`` keeps them as rows with ``reject`` and ``reject_line`` (see
    ``flag_log_lines``). All pad short lines with nulls and skip blank ones. Quotes are ordinary
    characters unless ``quote`` names one (strict mode only), since messages are free text.

    ``glob`` is matched below ``path``; with ``recursive`` its last part is matched at any depth.
    """
    if mode not in ("strict", "tolerant", "flagged"):
        raise ValueError(f"unknown mode: {mode}")
    reader = spark.read.options(encoding=encoding, header=False, quote=quote, escape="")
    source, lookup = locate(path, glob, recursive)
    reader = reader.options(**lookup)
    place = [F.col(column).alias(name) for name, column in PLACE.items()]
    if mode == "strict":
        fields = reader.schema(LOG_SCHEMA).csv(source, sep="\t").select(*LOG_FIELDS, *place)
        return with_event_time(fields)
    lines = reader.schema("value string").csv(source, sep=NO_SEPARATOR).select("value", *place)
    return flag_log_lines(lines, "value") if mode == "flagged" else parse_log_lines(lines, "value", drop_long=True)


def locate(path: str, glob: str, recursive: bool) -> tuple[str, dict[str, str]]:
    """Path and reader options for the files that match the glob, or its last part at any depth."""
    if recursive:
        return path, {"recursiveFileLookup": "true", "pathGlobFilter": glob.rsplit("/", 1)[-1]}
    return f"{path.rstrip('/')}/{glob}", {}


def parse_log_lines(lines: DataFrame, line: str, drop_long: bool) -> DataFrame:
    """Six fields and event time from a column of whole lines; the other columns stay."""
    if drop_long:
        return kept_lines(flag_log_lines(lines, line))
    return _parsed(lines.where(F.length(line) > 0), line).drop(line)


def flag_log_lines(lines: DataFrame, line: str) -> DataFrame:
    """``parse_log_lines`` of every line, with ``reject``, why a line is no log line, and the text of such a line.

    Kept lines have null in both; rejected ones null in all fields. Blank lines are neither.
    """
    parts = F.size(F.split(F.col(line), "\t", -1))
    reject = F.when(parts > len(LOG_FIELDS), F.concat(parts.cast("string"), F.lit(" fields")))
    flagged = lines.where(F.length(line) > 0).withColumn("reject", reject)
    rejected = F.col("reject").isNotNull()
    found = _parsed(flagged, line)
    fields = [F.when(~rejected, F.col(name)).alias(name) for name in (*LOG_FIELDS, "event_time")]
    others = [name for name in lines.columns if name != line]
    return found.select(*fields, *others, "reject", F.when(rejected, F.col(line)).alias("reject_line"))


def kept_lines(flagged: DataFrame) -> DataFrame:
    """The log lines of ``flag_log_lines``."""
    return flagged.where("reject IS NULL").drop("reject", "reject_line")


def _parsed(lines: DataFrame, line: str) -> DataFrame:
    parts = F.split(F.col(line), "\t", -1)
    fields = [F.nullif(F.get(parts, F.lit(at)), F.lit("")).alias(name) for at, name in enumerate(LOG_FIELDS)]
    return with_event_time(lines.select(*fields, *lines.columns))


def with_event_time(fields: DataFrame) -> DataFrame:
    """Adds the parsed time stamp, null where the text is not one."""
    return fields.withColumn("event_time", parse_timestamp(F.col("stamp"), STAMP_FORMAT))


def with_line_order(lines: DataFrame) -> DataFrame:
    """Adds ``line_id``, which rises along the lines of a file block.

    ``(file, block, line_id)`` is the line order of a file, also where a file is read by many tasks.
    Add it after filters (they then still reach the scan) and before any shuffle.
    """
    return lines.withColumn("line_id", F.monotonically_increasing_id())
