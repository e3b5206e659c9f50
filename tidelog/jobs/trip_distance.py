"""trip_distance INPUT OUTPUT [JOB]: adds the distance to trips in Parquet; a job of the same name adds them once."""

from __future__ import annotations

from tidelog.jobs.command import run_command
from tidelog.plans.flows import run_distance

if __name__ == "__main__":
    run_command("trip distance", ["INPUT", "OUTPUT"], run_distance, optional=["JOB"])
