"""Time stamps as text, as seconds and as positions on a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def parse_timestamp(text: Column, pattern: str) -> Column:
    """Time stamp, or null where the text does not fit the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_day(text: Column, pattern: str) -> Column:
    """Date, or null where the text does not fit the pattern."""
    return F.to_date(F.try_to_timestamp(text, F.lit(pattern)))


def whole_seconds(rows: DataFrame, column: str) -> Column:
    """Seconds of a time stamp since 1970; wall-clock ones where it has no time zone."""
    at = F.col(column)
    if isinstance(rows.schema[column].dataType, TimestampNTZType):
        days = F.unix_date(F.to_date(at)).cast("long")
        return days * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)
    return F.unix_seconds(at)


def seconds_between(rows: DataFrame, start: str, end: str) -> Column:
    """Whole seconds from start to end, on second boundaries."""
    return whole_seconds(rows, end) - whole_seconds(rows, start)


def time_positions(rows: DataFrame, column: str) -> list[Column]:
    """Two whole numbers that rise with the time: seconds, and microseconds of the minute."""
    microseconds = F.date_part(F.lit("SECOND"), F.col(column)) * 1_000_000
    return [whole_seconds(rows, column), microseconds.cast("long")]
