import csv

import pytest

from tests.test_archives import zipped
from tests.test_logs import line, write
from tidelog.jobs import correspondence, vote_ingest, vote_report
from tidelog.jobs.command import run_command
from tidelog.plans.flows import ingest_csv_to_parquet, run_distance, run_word_count
from tidelog.schemas import VOTE_END, VOTE_START

VOTES = [line("08:00:00", VOTE_START), line("08:00:09", VOTE_END)]


def run(work, names, *arguments):
    run_command("test", names, work, [str(a) for a in arguments])


@pytest.mark.parametrize("arguments", [[], ["a"], ["a", "b", "c"]])
def test_wrong_arguments_end_with_code_1(arguments, caplog):
    with pytest.raises(SystemExit) as end:
        run_command("test", ["INPUT", "OUTPUT"], lambda *_: None, arguments)
    assert end.value.code == 1 and "needs 2 arguments" in caplog.text


def test_vote_ingest_from_archives(spark, tmp_path):
    (tmp_path / "unzipped").mkdir()
    (tmp_path / "unzipped" / "m1.jez").write_bytes(zipped({"logd.dat": "\n".join(VOTES)}))
    run(vote_ingest.work, ["INPUT", "OUTPUT", "STATE"], tmp_path, tmp_path / "out", "TO")
    assert [r["TempoSec"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [9]
    assert spark.read.csv(str(tmp_path / "out" / "csv" / "log_urna.csv")).count() == 1


def test_vote_ingest_from_folders(spark, tmp_path):
    write(tmp_path / "logs" / "m1" / "logd.dat", VOTES)
    run(vote_ingest.work, ["INPUT", "OUTPUT", "STATE"], tmp_path, tmp_path / "out", "TO")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


@pytest.mark.parametrize("arguments", [["a"], ["a", "b", "c", "d"]])
def test_optional_arguments(arguments):
    with pytest.raises(SystemExit):
        run_command("test", ["INPUT", "OUTPUT"], lambda *_: None, arguments, optional=["JOB"])


def test_vote_report(spark, tmp_path):
    write(tmp_path / "logs" / "m1" / "logd.dat", VOTES)
    for _ in range(2):
        run(vote_report.work, ["INPUT", "OUTPUT", "STATE"], tmp_path, tmp_path / "out", "TO")
    assert spark.read.csv(str(tmp_path / "out" / "TO"), header=True, encoding="ISO-8859-1").count() == 1


@pytest.mark.parametrize("packed", [True, False])
def test_correspondence(spark, tmp_path, packed):
    text = "AA_ELEICAO;CD_PLEITO;SG_UF;CD_MUNICIPIO;NM_MUNICIPIO;NR_ZONA;NR_URNA_ESPERADA\n" + "2024;452;TO;7;A;1;5\n" * 3
    (tmp_path / "unzipped").mkdir()
    if packed:
        (tmp_path / "CESP_1t_TO_061020241406.zip").write_bytes(zipped({"to.csv": text}))
    else:
        (tmp_path / "unzipped" / "to.csv").write_text(text)
    run(correspondence.work, ["INPUT", "OUTPUT", "PARAMS"], tmp_path, tmp_path / "out", "1_061020241406")
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / "parquet")).collect()] == [(2024, 452, 7, "A", 1, 5, "TO")]


def test_trip_pipeline_and_words(spark, tmp_path):
    names = ["start station latitude", "start station longitude", "end station latitude", "end station longitude"]
    with open(tmp_path / "trips.csv", "w", newline="") as file:
        csv.writer(file).writerows([names, ["40.75660359", "-73.9979009", "40.73314259", "-73.97573881"]])
    run(ingest_csv_to_parquet, ["INPUT", "OUTPUT"], tmp_path / "trips.csv", tmp_path / "trips.parquet")
    run(run_distance, ["INPUT", "OUTPUT"], tmp_path / "trips.parquet", tmp_path / "far.parquet")
    assert [r["distance"] for r in spark.read.parquet(str(tmp_path / "far.parquet")).collect()] == [1.99]
    for _ in range(2):
        run_command("test", ["INPUT", "OUTPUT"], run_distance, [str(tmp_path / "trips.parquet"), str(tmp_path / "far.parquet"), "job-1"], optional=["JOB"])
    assert spark.read.parquet(str(tmp_path / "far.parquet")).count() == 2
    (tmp_path / "t.txt").write_text("to be or not to be")
    run(run_word_count, ["INPUT", "OUTPUT"], tmp_path / "t.txt", tmp_path / "words")
    found = spark.read.csv(str(tmp_path / "words"), header=True).collect()
    assert [(r["word"], r["count"]) for r in found] == [("be", "2"), ("not", "1"), ("or", "1"), ("to", "2")]
