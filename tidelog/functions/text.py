"""Splitting and cutting text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, combining marks and digits of any script, plus the apostrophe.
WORD_PATTERN = r"[\p{L}\p{M}\p{N}']+"

# What Python's strip() would remove and a log line can contain.
WHITESPACE = " \t\r\n\f\v\u00a0"


def words(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Lower-cased words of a text, as an array in reading order."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def has_letter_or_digit(word: Column) -> Column:
    """False for words made of apostrophes only."""
    return F.btrim(word, F.lit("'")) != ""


def after_last(text: Column, separator: str) -> Column:
    """Text after the last separator (the whole text if there is none), without outer whitespace."""
    return F.btrim(F.substring_index(text, separator, -1), F.lit(WHITESPACE))


def cut_at_first_blank(text: Column) -> tuple[Column, Column]:
    """The two sides of the first blank; the second is null if there is no blank."""
    sides = F.split(text, " ", 2)
    return F.get(sides, 0), F.get(sides, 1)
