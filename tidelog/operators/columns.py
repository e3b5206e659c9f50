"""Column names."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def with_sanitized_columns(frame: DataFrame) -> DataFrame:
    """The frame under sanitized names; names that would collide in a table are an error."""
    # Fixed by the header contract: a blank becomes an underscore, other whitespace stays.
    names = [name.replace(" ", "_") for name in frame.columns]
    twice = [name for name, times in Counter(name.lower() for name in names).items() if times > 1]
    if twice:
        raise ValueError(f"column names collide once blanks are replaced: {', '.join(sorted(twice))}")
    return frame.toDF(*names)
