"""Taking in log files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.report import report_lines, vote_report, with_report_names
from tidelog.session import settled
from tidelog.sources.machine_logs import NO_SEPARATOR, PLACE, flag_log_lines, kept_lines, locate, parse_log_lines, with_line_order


def report_extract(lines: DataFrame) -> DataFrame:
    """The lines of whole files that a vote report needs."""
    return report_lines(lines if "line_id" in lines.columns else with_line_order(lines))


def report_of(extract: DataFrame) -> DataFrame:
    """The vote report of an extract, under its published names."""
    return with_report_names(vote_report(extract))


def incremental_log_ingest(
    spark: SparkSession,
    logs: str,
    output: str,
    progress: str,
    extract: Callable[[DataFrame], DataFrame] = report_extract,
    transform: Callable[[DataFrame], DataFrame] = report_of,
    output_format: str = "csv",
    files_per_batch: int = 10_000,
    glob: str = "*/*.dat",
    recursive: bool = False,
    encoding: str = "ISO-8859-1",
    rejects: str | None = None,
) -> StreamingQuery:
    """Processes every file not seen before, appends the results and stops.

    ``progress`` remembers the files already taken in. A file is never split over micro-batches, so
    a ``transform`` that works file by file gives the same rows however the files arrive. It gets
    the ``extract`` of the lines, stored once per micro-batch. Lines with too many fields are
    dropped, or with ``rejects`` written to that folder as Parquet (file, block, reject, reject_line); both
    outputs then come from one stored parse. Each micro-batch overwrites its own ``batch_id=…`` folders:
    a batch repeated after a failure replaces its rows instead of doubling them.
    """
    source, lookup = locate(logs, glob, recursive)
    arriving = (
        spark.readStream.schema("value string")
        .options(sep=NO_SEPARATOR, header=False, quote="", escape="", encoding=encoding)
        .options(maxFilesPerTrigger=files_per_batch, **lookup)
        .csv(source)
        .select("value", *[F.col(column).alias(name) for name, column in PLACE.items()])
    )

    def write(kept: DataFrame, batch_id: int) -> None:
        writer = transform(kept).write.mode("overwrite").format(output_format)
        if output_format == "csv":
            writer = writer.options(header=True, encoding=encoding)
        writer.save(f"{output}/batch_id={batch_id}")

    def take_in(batch: DataFrame, batch_id: int) -> None:
        if rejects is None:
            with settled(extract(parse_log_lines(batch, "value", drop_long=True))) as kept:
                write(kept, batch_id)
            return
        with settled(with_line_order(flag_log_lines(batch, "value"))) as flagged:
            write(extract(kept_lines(flagged)), batch_id)
            wrong = flagged.where("reject IS NOT NULL").select("file", "block", "reject", "reject_line")
            wrong.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")

    query = (
        arriving.writeStream.option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .foreachBatch(take_in)
        .start()
    )
    query.awaitTermination()
    return query
