"""vote_report INPUT OUTPUT STATE: new logs in INPUT/logs, appended to OUTPUT/STATE as CSV."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidelog.jobs.command import run_command
from tidelog.streaming.incremental import incremental_log_ingest


def work(spark: SparkSession, source: str, output: str, state: str) -> None:
    incremental_log_ingest(spark, f"{source}/logs", f"{output}/{state}", f"{output}/_progress/{state}")


if __name__ == "__main__":
    run_command("vote report", ["INPUT", "OUTPUT", "STATE"], work)
