import math

import pytest

from tidelog.operators.distance import TRIP_COORDINATES, great_circle_distance
from tidelog.plans.flows import run_distance

# Three trips and their published distances.
TRIPS = [
    (27937, 40.69102925677968, -73.99183362722397, 40.6763947, -73.99869893, 1.07),
    (15933, 40.75724567911726, -73.97805914282799, 40.74444921, -73.98303529, 0.92),
    (27084, 40.75660359, -73.9979009, 40.73314259, -73.97573881, 1.99),
]


def trips(spark, rows, as_text=False):
    cast = (lambda v: None if v is None else str(v)) if as_text else (lambda v: v)
    kind = "string" if as_text else "double"
    schema = "bikeid long, " + ", ".join(f"{name} {kind}" for name in TRIP_COORDINATES)
    return spark.createDataFrame([(r[0], *map(cast, r[1:5])) for r in rows], schema)


@pytest.mark.parametrize("as_text", [False, True])
def test_published_distances(spark, tmp_path, as_text):
    source, target = str(tmp_path / "trips"), str(tmp_path / "out")
    given = trips(spark, TRIPS, as_text)
    given.write.parquet(source)
    run_distance(spark, source, target)
    stored = spark.read.parquet(target)
    assert stored.dtypes == [*given.dtypes, ("distance", "double")]
    assert {r["bikeid"]: r["distance"] for r in stored.collect()} == {r[0]: r[5] for r in TRIPS}
    run_distance(spark, source, target)
    assert spark.read.parquet(target).count() == 2 * len(TRIPS)


def test_unusable_equal_and_opposite_points(spark):
    rows = [(1, "abc", 1, 1, 1), (2, None, 1, 1, 1), (3, 5.5, 6.5, 5.5, 6.5), (4, 0.0, 0.0, 0.0, 180.0), (5, 13.7, 20.1, -13.7, -159.9)]
    found = {r["bikeid"]: r["distance"] for r in great_circle_distance(trips(spark, rows, as_text=True)).collect()}
    half_way_round = round(math.pi * 6_371_000 / 1609.344, 2)
    assert found == {1: None, 2: None, 3: 0.0, 4: half_way_round, 5: half_way_round}
