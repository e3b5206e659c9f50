"""Types of text columns, from all their values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A bit for each kind of value. A column's kinds are joined with "or", in any order and any number of parts.
INT, LONG, DOUBLE, DATE, TIME, BOOLEAN, TEXT = (1 << n for n in range(7))

#: The narrowest type that holds all kinds of a set; any other set is text.
TYPES = {
    "int": {INT},
    "bigint": {INT, LONG},
    "double": {INT, LONG, DOUBLE},
    "date": {DATE},
    "timestamp": {DATE, TIME},
    "boolean": {BOOLEAN},
}


def kind_of(value: Column) -> Column:
    """The kind of one value, 0 for null. A value is of a kind if its whole text is, without blanks around it."""
    fits = lambda pattern: value.rlike(f"^(?:{pattern})$")
    can = lambda kind: value.try_cast(kind).isNotNull()
    whole = F.when(can("int"), INT).when(can("bigint"), LONG).otherwise(TEXT)
    return (
        F.when(value.isNull(), 0)
        .when(fits(r"[+-]?[0-9]+"), whole)
        .when(fits(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"), DOUBLE)
        .when(fits(r"[0-9]{4}-[0-9]{2}-[0-9]{2}") & can("date"), DATE)
        .when(fits(r"[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?") & can("timestamp"), TIME)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def type_of(kinds: int) -> str:
    """The narrowest type for a set of kinds; text where there is none, or no value at all."""
    for name, held in TYPES.items():
        if kinds and not kinds & ~sum(held):
            return name
    return "string"


def narrowest_types(frame: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest type of each text column that holds every value: one pass, one row to the driver.

    Whole numbers beyond 64 bits stay text, since no number type here would keep them. A column with one value
    of another kind stays text as a whole, so nothing turns null.
    """
    names = list(columns or frame.columns)
    seen = frame.agg(*[F.bit_or(kind_of(F.col(f"`{name}`"))).alias(f"_{n}") for n, name in enumerate(names)]).first()
    return {name: type_of(kinds or 0) for name, kinds in zip(names, seen, strict=True)}


def with_types(frame: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The named columns, cast; a value that does not fit its type is an error."""
    return frame.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.items()])
