import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidelog.plans.catalog import oracle_sql, queries

FOLDER = os.environ.get("TABLES_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    answer = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    found = sorted((tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    assert found == sorted(answer.fetchall(), key=str)
    assert found


def test_durations_do_not_depend_on_the_files(spark, tmp_path):
    """Times cut to the hour make many ties; one file or eight, and another folder, give the same pairs."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    found = []
    for name, parts in (("one", 1), ("eight", 8), ("moved/eight", 8)):
        folder = tmp_path / name
        events.repartition(parts).write.parquet(str(folder / "events.parquet"))
        rows = queries()["vote_durations"](spark, str(folder)).collect()
        found.append(sorted(map(str, rows)))
    assert found[0] == found[1] == found[2]
    views = duckdb.connect()
    views.execute("SET TimeZone = 'UTC'")
    views.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/eight/events.parquet/*.parquet')")
    assert len(found[0]) == len(views.execute(oracle_sql()["vote_durations"]).fetchall())
