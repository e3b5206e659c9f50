"""Times every query on the tables in $BENCH_SF_DIR and prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times; its time is the median. The result is
computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelog.plans.catalog import queries  # noqa: E402
from tidelog.session import build_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()

    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/"))
    report = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps(report | {"sf": scale.removeprefix("sf")}))


if __name__ == "__main__":
    main()
