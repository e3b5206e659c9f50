"""What the command lines share."""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from tidelog.session import build_session

log = logging.getLogger("tidelog")


def run_command(
    app_name: str,
    names: Sequence[str],
    work: Callable[..., object],
    arguments: Sequence[str] | None = None,
    optional: Sequence[str] = (),
) -> None:
    """Checks the number of arguments, opens a session, runs ``work(spark, *arguments)``, closes it.

    A wrong number of arguments ends with a warning and exit code 1. ``optional`` names arguments that
    may follow.
    """
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    given = list(sys.argv[1:] if arguments is None else arguments)
    if not len(names) <= len(given) <= len(names) + len(optional):
        log.warning("%s needs %d arguments: %s", app_name, len(names), " ".join(names))
        sys.exit(1)
    active = SparkSession.getActiveSession()
    spark = active or build_session(app_name)
    log.info("%s started", app_name)
    result = work(spark, *given)
    log.info("%s finished%s", app_name, "" if result is None else f": {result} rows")
    if active is None:
        spark.stop()
