from pyspark.sql import functions as F

from tests.test_logs import FACT_LINES, line, write
from tidelog.schemas import VOTE_END, VOTE_START
from tidelog.streaming.incremental import incremental_log_ingest


def votes(machine, times):
    return [
        line(f"08:{m:02d}:{s}", message, machine=machine)
        for m in range(times)
        for s, message in (("00", VOTE_START), ("30", VOTE_END))
    ]


def take_in(spark, tmp_path, **options):
    target = str(tmp_path / "out")
    incremental_log_ingest(spark, str(tmp_path / "logs"), target, str(tmp_path / "progress"), **options)
    return spark.read.csv(target, header=True, encoding="ISO-8859-1")


def test_each_file_is_taken_in_once(spark, tmp_path):
    write(tmp_path / "logs" / "a" / "1.dat", [*FACT_LINES, *votes("M1", 3), line("09:00:00", VOTE_START) + "\textra\tx"])
    first = take_in(spark, tmp_path)
    assert first.count() == 3
    write(tmp_path / "logs" / "b" / "2.dat", votes("M1", 2))
    second = take_in(spark, tmp_path)
    assert second.count() == 5
    assert take_in(spark, tmp_path).count() == 5
    assert second.where(F.col("Município") == "73008").count() == 3
    assert second.where(F.col("Município").isNull()).count() == 2
    assert {r["Voto ID"] for r in second.collect()} == {"1", "2", "3"}
    assert not list((tmp_path / "logs").rglob("extract-*"))


def test_same_rows_however_the_files_are_grouped(spark, tmp_path):
    for n in range(6):
        write(tmp_path / "logs" / f"d{n}" / "x.dat", votes(f"M{n}", n))
    assert take_in(spark, tmp_path, files_per_batch=2).drop("batch_id").count() == 15
    assert len(list((tmp_path / "out").glob("batch_id=*"))) == 3


def test_files_at_any_depth(spark, tmp_path):
    write(tmp_path / "logs" / "top.dat", votes("M1", 1))
    write(tmp_path / "logs" / "a" / "b" / "deep.dat", votes("M2", 2))
    write(tmp_path / "logs" / "a" / "b" / "deep.txt", votes("M3", 4))
    assert take_in(spark, tmp_path, recursive=True).count() == 3


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    write(tmp_path / "logs" / "a" / "1.dat", votes("M1", 4))
    assert take_in(spark, tmp_path).count() == 4
    for commit in (tmp_path / "progress" / "commits").iterdir():
        commit.unlink()
    assert take_in(spark, tmp_path).count() == 4


def test_rejected_lines_are_listed_by_batch(spark, tmp_path):
    wrong = [line("09:00:00", VOTE_START) + "\textra\tx", line("09:00:01", "x") + "\ty"]
    write(tmp_path / "logs" / "a" / "1.dat", [*votes("M1", 3), wrong[0]])
    write(tmp_path / "logs" / "b" / "2.dat", [wrong[1], *votes("M2", 1)])
    rejects = str(tmp_path / "rejects")
    assert take_in(spark, tmp_path, rejects=rejects).count() == 4
    listed = spark.read.parquet(rejects)
    assert sorted(r["reject_line"] for r in listed.collect()) == sorted(wrong)
    assert {r["file"].rsplit("/", 1)[1] for r in listed.collect()} == {"1.dat", "2.dat"}
    # the same batch again replaces its rows
    for commit in (tmp_path / "progress" / "commits").iterdir():
        commit.unlink()
    assert take_in(spark, tmp_path, rejects=rejects).count() == 4 and spark.read.parquet(rejects).count() == 2
