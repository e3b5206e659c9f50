"""Trip distances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.geo import great_circle_miles

# Coordinate columns of the trip table, start then end.
TRIP_COORDINATES = (
    "start_station_latitude",
    "start_station_longitude",
    "end_station_latitude",
    "end_station_longitude",
)


def great_circle_distance(trips: DataFrame, coordinates: tuple[str, str, str, str] = TRIP_COORDINATES) -> DataFrame:
    """All input columns plus ``distance``: miles with two decimals, null for unusable coordinates.

    Coordinates may be text, as an untyped CSV ingest leaves them.
    """
    degrees = [F.col(name).try_cast("double") for name in coordinates]
    return trips.withColumn("distance", F.round(great_circle_miles(*degrees), 2))
