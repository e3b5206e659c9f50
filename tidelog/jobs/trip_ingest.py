"""trip_ingest INPUT OUTPUT: headered CSV to Parquet."""

from __future__ import annotations

from tidelog.jobs.command import run_command
from tidelog.plans.flows import ingest_csv_to_parquet

if __name__ == "__main__":
    run_command("trip ingest", ["INPUT", "OUTPUT"], ingest_csv_to_parquet)
