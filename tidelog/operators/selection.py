"""Choosing events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains_any(text: str, parts: Sequence[str]) -> Column:
    """True where the text contains at least one of the parts."""
    return reduce(or_, [F.col(text).contains(part) for part in parts])


def select_events(
    events: DataFrame,
    equal: Mapping[str, object],
    time: str | None = None,
    since: str | None = None,
    text: str | None = None,
    parts: Sequence[str] = (),
) -> DataFrame:
    """Rows with the given column values, not before ``since``, whose text contains one of ``parts``.

    All conditions are plain comparisons with literals, so the scan can take them.
    """
    conditions = [F.col(name) == F.lit(value) for name, value in equal.items()]
    if time is not None and since is not None:
        conditions.append(F.col(time) >= F.lit(since))
    if text is not None and parts:
        conditions.append(contains_any(text, parts))
    return events.where(reduce(and_, conditions)) if conditions else events
