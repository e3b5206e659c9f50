"""First reported value per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.text import after_last
from tidelog.operators.selection import contains_any


def first_facts(
    lines: DataFrame, key: str, order: Sequence[str], message: str, facts: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """One row per key with the first value of each fact.

    ``facts`` maps an output column to the text that marks its lines and the separator before the
    value. A fact a key never reports is null; a key that reports none has no row. Lines without
    any mark are dropped at the scan, and each task keeps one value per key and fact before the
    shuffle, so a key with very many lines costs no more to shuffle than any other.
    """
    marked = lines.where(contains_any(message, [mark for mark, _ in facts.values()]))
    at = F.struct(*order)
    firsts = [
        F.min_by(after_last(F.col(message), separator), F.when(F.col(message).contains(mark), at)).alias(name)
        for name, (mark, separator) in facts.items()
    ]
    return marked.groupBy(key).agg(*firsts)
