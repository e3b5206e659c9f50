import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidelog.operators.pairing import adjacent_pairs, ordinal_pairs
from tidelog.operators.skew import WHOLE, split_hot_keys

SCHEMA = "id long, key string, at timestamp, kind string"
START = datetime(2024, 10, 6, 8)


def events(seed, rows, hot="hot", share=0.4, seconds=5_000, keys=40):
    """Random events; one key holds a large share, some times are equal, some keys are null."""
    rand = random.Random(seed)
    names = [None, *[f"k{n}" for n in range(keys)]]
    return [
        (
            n,
            hot if rand.random() < share else rand.choice(names),
            START + timedelta(seconds=rand.randrange(seconds)),
            rand.choice(["start", "end", "other"]),
        )
        for n in range(rows)
    ]


def by_key(rows):
    grouped = {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        grouped.setdefault(row[1], []).append(row)
    return grouped


def brute_adjacent(rows):
    found = []
    for key, own in by_key(r for r in rows if r[3] != "other").items():
        for now, then in zip(own, own[1:]):
            if now[3] == "start" and then[3] == "end":
                found.append((key, now[2], then[2], int((then[2] - now[2]).total_seconds())))
    return sorted(found, key=str)


def brute_ordinal(rows):
    found = []
    for key, own in by_key(r for r in rows if r[1] is not None).items():
        starts, ends = ([r for r in own if r[3] == kind] for kind in ("start", "end"))
        for n, (s, e) in enumerate(zip(starts, ends), 1):
            if s[2].hour == e[2].hour:
                found.append((key, n, s[2].hour, s[0], e[0]))
    return sorted(found, key=str)


def run_adjacent(frame, rows_per_chunk):
    kind = F.col("kind")
    return adjacent_pairs(frame, "key", "at", kind == "start", kind == "end", ["id"], rows_per_chunk)


def run_ordinal(frame, rows_per_chunk):
    kind = F.col("kind")
    return ordinal_pairs(
        frame.withColumn("hour", F.hour("at")),
        "key",
        ["at", "id"],
        [F.unix_micros("at"), F.col("id")],
        kind == "start",
        kind == "end",
        on=["hour"],
        carry=["id"],
        rows_per_chunk=rows_per_chunk,
    )


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("rows_per_chunk", [1_000_000, 200, 20, 3])
@pytest.mark.parametrize("hot", ["hot", None])
def test_adjacent_pairs_equal_brute_force(spark, rows_per_chunk, hot):
    rows = events(7, 6_000, hot=hot)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5, "id")
    assert result(run_adjacent(frame, rows_per_chunk)) == brute_adjacent(rows)


@pytest.mark.parametrize("rows_per_chunk", [1_000_000, 200, 20, 3])
def test_ordinal_pairs_equal_brute_force(spark, rows_per_chunk):
    rows = events(11, 6_000)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5, "id")
    assert result(run_ordinal(frame, rows_per_chunk)) == brute_ordinal(rows)


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_pairs_do_not_depend_on_partitioning(spark, conf, partitions):
    conf(spark__sql__shuffle__partitions=partitions)
    rows = events(3, 2_000)
    random.Random(1).shuffle(rows)
    for frame in (spark.createDataFrame(rows, SCHEMA).coalesce(1), spark.createDataFrame(rows, SCHEMA).repartition(16)):
        assert result(run_adjacent(frame, 30)) == brute_adjacent(rows)
        assert result(run_ordinal(frame, 30)) == brute_ordinal(rows)


def test_equal_times_and_null_times(spark):
    rows = [(n, "k", None if n < 50 else START + timedelta(seconds=n // 400), "start" if n % 2 else "end") for n in range(2_000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    plain = result(run_adjacent(frame, 1_000_000).groupBy("key").count())
    cut = result(run_adjacent(frame, 20).groupBy("key").count())
    assert plain == cut == [("k", 999)]


def test_without_a_tie_break_chunks_change_nothing(spark):
    rows = [(0, "k", START + timedelta(seconds=r[2].second), r[3]) for r in events(9, 4_000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    kind = F.col("kind")
    plain, cut = (
        result(adjacent_pairs(frame, "key", "at", kind == "start", kind == "end", rows_per_chunk=n)) for n in (10**6, 20)
    )
    assert plain == cut and plain


def test_a_key_with_a_third_of_the_rows_is_cut_into_even_chunks(spark):
    rows = spark.range(300_000, numPartitions=8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 1000) END AS key", "pmod(xxhash64(id), 1000000) AS at"
    )
    cut, chunks = split_hot_keys(rows, "key", [F.col("at")], rows_per_chunk=2_000)
    sizes = {(r["key"], r["_chunk0"], r["_chunk1"]): r["count"] for r in cut.groupBy("key", *chunks).count().collect()}
    assert sum(sizes.values()) == 300_000
    hot = [n for (key, *_), n in sizes.items() if key == "hot"]
    assert 100 < len(hot) < 400 and max(hot) < 2_000
    assert all(chunk == [WHOLE, WHOLE] for key, *chunk in sizes if key != "hot")
    assert_ordered(cut.where("key = 'hot'"), chunks, F.struct("at"))


def assert_ordered(rows, chunks, order):
    """Along the chunk numbers, every row of a chunk comes before every row of the next."""
    spans = rows.groupBy(*chunks).agg(F.min(order).alias("low"), F.max(order).alias("high")).orderBy(*chunks)
    borders = [(tuple(r["low"]), tuple(r["high"])) for r in spans.collect()]
    assert all(before[1] < after[0] for before, after in zip(borders, borders[1:]))


@pytest.mark.parametrize("base", [0, -5_000_000_000, 10**15])
def test_equal_positions_are_cut_along_the_next(spark, base):
    """A third of all rows share key and first position, most of those the second one too."""
    rows = spark.range(300_000, numPartitions=8).select(
        F.lit("k").alias("key"),
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000))).alias("a") + base,
        F.when(F.col("id") % 4 > 0, 7).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50))).alias("b"),
        "id",
    ).toDF("key", "a", "b", "id")
    cut, chunks = split_hot_keys(rows, "key", [F.col("a"), F.col("b"), F.col("id")], rows_per_chunk=1_000)
    assert cut.count() == 300_000
    assert_ordered(cut, chunks, F.struct("a", "b", "id"))
    sizes = [r["count"] for r in cut.groupBy(*chunks).count().collect()]
    assert max(sizes) < 2_000


def test_pairs_of_one_key_at_one_moment(spark):
    rows = [(n, "k", START if n % 10 < 8 else START + timedelta(microseconds=n), random.Random(n).choice(["start", "end"])) for n in range(5_000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for rows_per_chunk in (10**6, 50, 5):
        assert result(run_adjacent(frame, rows_per_chunk)) == brute_adjacent(rows)
        assert result(run_ordinal(frame, rows_per_chunk)) == brute_ordinal(rows)


@pytest.mark.parametrize("seed", range(6))
def test_chunks_keep_the_order_of_rows_that_were_not_drawn(spark, seed):
    """A few rows in hundreds are drawn: others have smaller, larger, null or single other positions."""
    rand = random.Random(seed)
    mostly = lambda value, other: value if rand.random() < 0.995 else rand.choice(other)
    first = [lambda: mostly(5, [None, -(2**62), 4, 6, 2**62]), lambda: rand.choice([3, 3, 3, rand.randrange(10**6)])][seed % 2]
    second = [lambda: mostly(rand.randrange(3), [None, -9, 9]), lambda: mostly(7, [None, 6, 8]), lambda: mostly(None, [1, 2])][seed % 3]
    rows = [(first(), second(), rand.randrange(2**50)) for _ in range(60_000)]
    frame = spark.createDataFrame(rows, "a long, b long, c long").withColumn("key", F.lit("k"))
    cut, chunks = split_hot_keys(frame, "key", [F.col("a"), F.col("b"), F.col("c")], rows_per_chunk=6_400)
    place = [F.struct(F.col(c).isNotNull(), c) for c in "abc"]
    spans = cut.groupBy(*chunks).agg(F.min(F.struct(*place)).alias("low"), F.max(F.struct(*place)).alias("high"), F.count("*").alias("n")).orderBy(*chunks).collect()
    key = lambda x: [(f[0], f[1] or 0) for f in x]
    assert all(key(x["high"]) < key(y["low"]) for x, y in zip(spans, spans[1:], strict=False))
    assert sum(s["n"] for s in spans) == 60_000
    if seed % 3 < 2:
        assert max(s["n"] for s in spans) < 6_400


def test_tenfold_rows_make_chunks_of_the_same_size(spark):
    largest = []
    for rows in (40_000, 400_000):
        frame = spark.range(rows).select(F.lit("k").alias("key"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("at"))
        cut, chunks = split_hot_keys(frame, "key", [F.col("at")], rows_per_chunk=4_000)
        sizes = [r["count"] for r in cut.groupBy(*chunks).count().collect()]
        assert sum(sizes) == rows
        largest.append(max(sizes))
    assert largest[1] < 1.5 * largest[0] and max(largest) < 4_000


def test_no_job_runs_while_a_plan_is_built(spark):
    frame = spark.createDataFrame(events(5, 500), SCHEMA)
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        built = run_adjacent(frame, 20), run_ordinal(frame, 20)
        assert not tracker.getJobIdsForGroup(group)
        for one in built:
            one.collect()
        assert tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_keys_in_one_piece_need_one_shuffle(spark):
    frame = spark.createDataFrame(events(5, 500), SCHEMA)
    plan = plan_of(run_adjacent(frame, 1_000_000))
    final = plan.split("== Initial Plan ==")[0]
    # one of the rows, one of the draw that looks for heavy keys
    assert final.count("Exchange hashpartitioning") <= 2 and "Union" not in final and final.count("Window ") == 1


def test_log_example(spark):
    at = ["05/10/2024 23:59:59", *[f"06/10/2024 08:0{t}" for t in ("0:00", "1:00", "1:10", "1:30", "2:00")], "xx"]
    kinds = ["start", "start", "start", "other", "end", "end", "start"]
    rows = spark.createDataFrame(list(zip(range(7), ["M1"] * 7, at, kinds)), "id long, key string, text string, kind string")
    frame = rows.withColumn("at", F.try_to_timestamp("text", F.lit("dd/MM/yyyy HH:mm:ss"))).where("at >= '2024-10-06'")
    assert [(r["start_time"].minute, r["end_time"].second, r["seconds"]) for r in run_adjacent(frame, 10**6).collect()] == [(1, 30, 30)]
    pairs = run_ordinal(frame, 10**6).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["start_id"], r["end_id"]) for r in pairs] == [(1, 1, 4), (2, 2, 5)]
    assert run_adjacent(frame, 10**6).dtypes == [("key", "string"), ("start_time", "timestamp"), ("end_time", "timestamp"), ("seconds", "bigint")]
