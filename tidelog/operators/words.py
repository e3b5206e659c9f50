"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.text import WORD_PATTERN, has_letter_or_digit, words


def word_count(lines: DataFrame, text: str = "value", pattern: str = WORD_PATTERN) -> DataFrame:
    """How often each lower-cased word occurs: ``word``, ``count``, in no order.

    Tasks add up their own words first, so a very frequent word shuffles one row per task.
    """
    return (
        lines.select(F.explode(words(F.col(text), pattern)).alias("word"))
        .where(has_letter_or_digit(F.col("word")))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
