"""Small tables of distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def distinct_projection(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the columns; nulls count as equal.

    Runs as a two-step hash aggregate: copies disappear inside each task before the shuffle.
    """
    return frame.select(*columns).dropDuplicates()
