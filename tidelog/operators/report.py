"""Votes of each log file, with the file's header facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.text import cut_at_first_blank
from tidelog.functions.time import parse_day
from tidelog.operators.facts import first_facts
from tidelog.operators.pairing import ordinal_pairs_apart
from tidelog.operators.selection import contains_any, select_events
from tidelog.operators.skew import ROWS_PER_CHUNK
from tidelog.schemas import DAY_FORMAT, FIRST_DAY, HEADER_FACTS, VOTE_ACTION, VOTE_END, VOTE_LEVEL, VOTE_START

REPORT_LINE_COLUMNS = ["file", "block", "line_id", "day", "clock", "level", "action", "message"]


def report_lines(lines: DataFrame, since: str = FIRST_DAY) -> DataFrame:
    """The lines a report needs: on or after the first day, with a vote event or a header fact."""
    day_text, clock = cut_at_first_blank(F.col("stamp"))
    marks = [VOTE_START, VOTE_END, *[mark for mark, _ in HEADER_FACTS.values()]]
    return (
        lines.where(contains_any("message", marks))
        .withColumn("day", parse_day(day_text, DAY_FORMAT))
        .withColumn("clock", clock)
        .where(F.col("day") >= F.lit(since))
        .select(*REPORT_LINE_COLUMNS)
    )


def vote_report(lines: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Ordinal vote pairs per file with the file's header facts; input from ``report_lines``.

    The facts have one row per file. Pairs of files in one piece already lie by file, so only the facts
    move. Pairs of a file that is cut are dealt out by their number, ``rows_per_chunk`` to a group, and its
    facts are copied for each group that there is.
    """
    votes = select_events(lines, {"level": VOTE_LEVEL, "action": VOTE_ACTION})
    light, heavy = ordinal_pairs_apart(
        votes,
        key="file",
        order=["block", "line_id"],
        positions=[F.col("block"), F.col("line_id")],
        is_start=F.col("message").contains(VOTE_START),
        is_end=F.col("message").contains(VOTE_END),
        on=["day"],
        carry=["clock", "message"],
        rows_per_chunk=rows_per_chunk,
    )
    facts = first_facts(lines, "file", ["block", "line_id"], "message", HEADER_FACTS)
    dealt = heavy.withColumn("_group", F.expr(f"(ordinal - 1) div {rows_per_chunk}"))
    copies = dealt.select("file", "_group").distinct().join(facts, "file")
    joined = light.join(facts, "file", "left").unionByName(dealt.join(copies, ["file", "_group"], "left").drop("_group"))
    return joined.select(
        "file",
        "ordinal",
        "day",
        "start_clock",
        "start_message",
        "end_clock",
        "end_message",
        *[F.col(f"`{name}`") for name in HEADER_FACTS],
    )


def with_report_names(report: DataFrame) -> DataFrame:
    """The report under its published column names, without the file."""
    # Published names of the pair columns.
    return report.select(
        F.col("ordinal").cast("int").alias("Voto ID"),
        F.col("day").alias("Data"),
        F.col("start_clock").alias("Hora Início"),
        F.col("start_message").alias("Mensagem Início"),
        F.col("end_clock").alias("Hora Fim"),
        F.col("end_message").alias("Mensagem Fim"),
        *[F.col(f"`{name}`") for name in HEADER_FACTS],
    )
