"""vote_ingest INPUT OUTPUT STATE: vote durations from the archives in INPUT/unzipped.

Where there is no such folder, the unpacked logs in INPUT/logs are read. STATE is accepted for the
job's contract; the archives of one state make up one INPUT.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidelog.jobs.command import run_command
from tidelog.plans.flows import logs_from_archives, run_machine_logs_folder, run_vote_durations
from tidelog.session import exists


def work(spark: SparkSession, source: str, output: str, _state: str) -> int:
    if not exists(spark, f"{source}/unzipped"):
        return run_machine_logs_folder(spark, f"{source}/logs", output)
    return run_vote_durations(logs_from_archives(spark, f"{source}/unzipped"), output)


if __name__ == "__main__":
    run_command("vote ingest", ["INPUT", "OUTPUT", "STATE"], work)
