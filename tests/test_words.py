import re
from collections import Counter

from tidelog.operators.words import word_count
from tidelog.plans.flows import run_word_count

LINES = [
    "It was the baker's wife--the one who couldn't sing--that they'd heard.And yet",
    "The sailors' songs; THE sea's own. ''quoted'' ' '' '''",
    "für Ångström 42nd été l'été   tail",
    "",
]


def expected(lines):
    found = re.findall(r"[\w']+", " ".join(lines).lower().replace("́", "Ж"))
    return Counter(w.replace("Ж", "́") for w in found if w.strip("'"))


def counts(frame):
    return {r["word"]: r["count"] for r in frame.collect()}


def test_words_are_counted(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    found = counts(word_count(lines))
    assert found == expected(LINES)
    assert found["the"] == 4 and found["sailors'"] == 1 and found["couldn't"] == 1 and found["für"] == 1
    assert found["''quoted''"] == 1 and found["and"] == 1 and found["heard"] == 1


def test_same_counts_for_one_and_many_files(spark, tmp_path):
    text = spark.createDataFrame([(line,) for line in LINES * 50], "value string")
    text.coalesce(1).write.text(str(tmp_path / "one"))
    text.repartition(7).write.text(str(tmp_path / "many"))
    for name in ("one", "many"):
        run_word_count(spark, str(tmp_path / name), str(tmp_path / f"{name}-out"))
    results = [
        [tuple(r) for r in spark.read.csv(str(tmp_path / f"{name}-out"), header=True, inferSchema=True).collect()]
        for name in ("one", "many")
    ]
    assert results[0] == results[1] == sorted(expected(LINES * 50).items())


def test_one_long_line_is_read_by_many_tasks(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="65536", spark__sql__files__openCostInBytes="0")
    (tmp_path / "line.txt").write_text(" ".join(LINES * 3_000), encoding="utf-8")
    assert spark.read.text(str(tmp_path / "line.txt"), lineSep=" ").rdd.getNumPartitions() > 5
    run_word_count(spark, str(tmp_path / "line.txt"), str(tmp_path / "out"))
    found = spark.read.csv(str(tmp_path / "out"), header=True, inferSchema=True)
    assert counts(found) == expected(LINES * 3_000)


def test_output_is_quoted_and_empty_input_gives_a_header(spark, tmp_path):
    (tmp_path / "in.txt").write_text("b a b")
    run_word_count(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    written = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert written.splitlines() == ['"word","count"', '"a","1"', '"b","2"']
    (tmp_path / "empty.txt").write_text("")
    run_word_count(spark, str(tmp_path / "empty.txt"), str(tmp_path / "none"))
    written = "".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))
    assert written.splitlines() == ['"word","count"']


def test_a_very_frequent_word_is_added_up_before_the_shuffle(spark):
    lines = spark.range(200_000, numPartitions=8).selectExpr("concat('the w', id % 100) AS value")
    found = counts(word_count(lines))
    assert found["the"] == 200_000 and len(found) == 101
    plan = word_count(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("functions=[count(1)]") < plan.index("Exchange") < plan.index("functions=[partial_count(1)]")
