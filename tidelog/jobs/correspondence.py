"""correspondence INPUT OUTPUT PARAMS: machine/precinct table of one turn.

PARAMS is TURN_STAMP. The archives CESP_<TURN>t_*_<STAMP>.zip in INPUT are read directly; where
there are none, the CSV files in INPUT/unzipped are.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidelog.jobs.command import run_command
from tidelog.plans.flows import correspondence_text, run_correspondence, run_correspondence_files
from tidelog.sources.archives import read_archives


def work(spark: SparkSession, source: str, output: str, params: str) -> int:
    turn, stamp = params.split("_")[:2]
    # Fixed value: how the published archives are named.
    glob = f"CESP_{turn}t_*_{stamp}.zip"
    if read_archives(spark, source, glob).select("archive").isEmpty():
        return run_correspondence_files(spark, f"{source}/unzipped/*.csv", output)
    return run_correspondence(correspondence_text(spark, source, glob), output)


if __name__ == "__main__":
    run_command("correspondence", ["INPUT", "OUTPUT", "PARAMS"], work)
