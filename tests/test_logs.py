import pytest
from pyspark.sql import functions as F

from tidelog.operators.facts import first_facts
from tidelog.operators.report import REPORT_LINE_COLUMNS, report_lines, vote_report, with_report_names
from tidelog.operators.selection import select_events
from tidelog.plans.flows import run_vote_durations, run_vote_report, vote_durations, vote_marks
from tidelog.schemas import HEADER_FACTS, VOTE_END, VOTE_START
from tidelog.sources.machine_logs import read_machine_logs, with_line_order
from tests.conftest import plan_of


def line(time, message, level="INFO", machine="M1", action="VOTA", code="A1", day="06/10/2024"):
    return "\t".join([f"{day} {time}", level, machine, action, message, code])


def write(path, lines, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((end.join(lines) + end).encode("iso-8859-1"))


FACT_LINES = [
    line("07:00:00", "Turno da UE: 1º turno", action="LOGD"),
    line("07:00:01", "Modelo de Urna: UE2020", action="LOGD"),
    line("07:00:02", "Fase da UE: Oficial", action="LOGD"),
    line("07:00:03", "Modo de carga da UE - Normal", action="LOGD"),
    line("07:00:04", "Município: 73008 ", action="LOGD"),
    line("07:00:05", "Zona Eleitoral: 0007", action="LOGD"),
    line("07:00:06", "Turno da UE: 2º turno", action="LOGD"),
]

VOTES = [
    line("23:59:59", VOTE_START, day="05/10/2024"),
    line("08:00:00", VOTE_START),
    line("08:01:00", VOTE_START),
    line("08:01:10", "Tecla indevida"),
    line("08:01:30", VOTE_END),
    line("08:02:00", VOTE_END),
    "\t".join(["xx", "INFO", "M1", "VOTA", VOTE_START, "A1"]),
]


@pytest.fixture
def logs(tmp_path):
    root = tmp_path / "logs"
    write(root / "a" / "one.dat", [*FACT_LINES, *VOTES])
    write(root / "b" / "two.dat", [line("09:00:00", VOTE_START, "ALERTA", "M2"), line("09:00:10", VOTE_END, machine="M2")])
    write(root / "top.dat", [line("10:00:00", VOTE_START, machine="M3")])
    write(root / "b" / "deep" / "deep.dat", [line("10:00:00", VOTE_START, machine="M4")])
    write(root / "b" / "notes.txt", ["no log"])
    return str(root)


def test_default_glob_and_recursion(spark, logs):
    found = read_machine_logs(spark, logs)
    assert {r[0] for r in found.select("machine").distinct().collect()} == {"M1", "M2"}
    everywhere = read_machine_logs(spark, logs, recursive=True)
    assert {r[0] for r in everywhere.select("machine").distinct().collect()} == {"M1", "M2", "M3", "M4"}
    assert found.where("message LIKE 'Município%'").count() == 1
    assert found.where("stamp = 'xx'").select("event_time").collect()[0][0] is None


AWKWARD = [
    line("08:00:00", '"open quote'),
    line("08:00:01", 'mid "quote" and \\ slash'),
    "06/10/2024 08:00:02\tINFO\tM1",
    line("08:00:03", "seven") + "\textra",
    line("08:00:04", "empty seventh") + "\t",
    "",
    line("08:00:05", "", code=""),
    line("08:00:06", "  São José  "),
]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_awkward_lines(spark, tmp_path, end):
    write(tmp_path / "x" / "f.dat", AWKWARD, end)
    strict = read_machine_logs(spark, str(tmp_path)).orderBy("stamp").collect()
    tolerant = read_machine_logs(spark, str(tmp_path), mode="tolerant").orderBy("stamp").collect()
    seconds = lambda rows: [int(r["stamp"][-1]) for r in rows]
    assert seconds(strict) == [0, 1, 2, 3, 4, 5, 6]
    assert seconds(tolerant) == [0, 1, 2, 5, 6]
    assert [r.asDict() for r in strict if int(r["stamp"][-1]) not in (3, 4)] == [r.asDict() for r in tolerant]
    short, blank = tolerant[2], tolerant[3]
    assert (short["machine"], short["action"], short["check_code"]) == ("M1", None, None)
    assert (blank["message"], blank["check_code"]) == (None, None)
    assert [r["message"] for r in tolerant[:2]] == ['"open quote', 'mid "quote" and \\ slash']
    assert tolerant[4]["message"] == "  São José  " and strict[3]["check_code"] == "A1"


def test_quotes_can_be_honoured(spark, tmp_path):
    write(tmp_path / "x" / "f.dat", [line("08:00:00", '"quoted\ttab"')])
    assert read_machine_logs(spark, str(tmp_path), quote='"').collect()[0]["message"] == "quoted\ttab"
    assert read_machine_logs(spark, str(tmp_path)).collect()[0]["message"] == '"quoted'


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown mode"):
        read_machine_logs(spark, "x", mode="loose")


def test_line_order_over_many_splits(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="4096", spark__sql__files__openCostInBytes="0")
    write(tmp_path / "x" / "f.dat", [line("08:00:00", f"{n:05d}") for n in range(3_000)])
    for mode in ("strict", "tolerant"):
        lines = with_line_order(read_machine_logs(spark, str(tmp_path), mode=mode))
        assert lines.rdd.getNumPartitions() > 10
        ordered = lines.repartition(3).orderBy("file", "block", "line_id").collect()
        assert [int(r["message"]) for r in ordered] == list(range(3_000))


def test_durations(spark, logs, tmp_path):
    target = str(tmp_path / "out")
    assert run_vote_durations(read_machine_logs(spark, logs), target) == 2
    stored = spark.read.parquet(target)
    assert stored.dtypes == [("CodigoUrna", "string"), ("DataHora", "timestamp"), ("DataHora_Fim", "timestamp"), ("TempoSec", "bigint")]
    assert {(r["CodigoUrna"], str(r["DataHora"].time()), r["TempoSec"]) for r in stored.collect()} == {("M1", "08:01:00", 30), ("M2", "09:00:00", 10)}
    assert spark.read.csv(f"{target}/csv/log_urna.csv").count() == 2
    assert run_vote_durations(read_machine_logs(spark, logs), target) == 2


def test_one_machine_in_two_files_and_equal_seconds(spark, tmp_path):
    write(tmp_path / "a" / "1.dat", [line("08:00:00", VOTE_START), line("08:00:00", VOTE_END), line("08:05:00", VOTE_START)])
    write(tmp_path / "b" / "2.dat", [line("08:06:00", VOTE_END)])
    found = vote_durations(vote_marks(read_machine_logs(spark, str(tmp_path)))).collect()
    assert sorted(r["TempoSec"] for r in found) == [0, 60]


def test_filters_reach_the_csv_scan(spark, logs):
    plan = plan_of(vote_marks(read_machine_logs(spark, logs)))
    scan = plan[plan.index("FileScan csv") :]
    assert "EqualTo(action,VOTA)" in scan.replace(" ", "") and "check_code" not in scan


def test_select_events_without_conditions_is_the_frame(spark):
    frame = spark.range(3)
    assert select_events(frame, {}) is frame


def test_facts(spark, logs):
    lines = report_lines(with_line_order(read_machine_logs(spark, logs, mode="tolerant")))
    found = first_facts(lines, "file", ["block", "line_id"], "message", HEADER_FACTS).collect()
    assert len(found) == 1
    assert found[0].asDict() | {"file": ""} == {
        "file": "",
        "Turno da UE": "1º turno",
        "Modelo de Urna": "UE2020",
        "Fase da UE": "Oficial",
        "Modo de Carga da UE": "Normal",
        "Município": "73008",
        "Zona Eleitoral": "0007",
        "Seção Eleitoral": None,
    }


def test_report(spark, logs, tmp_path):
    lines = read_machine_logs(spark, logs, mode="tolerant")
    report = with_report_names(vote_report(report_lines(with_line_order(lines)))).orderBy("Voto ID")
    assert report.dtypes[:6] == [
        ("Voto ID", "int"),
        ("Data", "date"),
        ("Hora Início", "string"),
        ("Mensagem Início", "string"),
        ("Hora Fim", "string"),
        ("Mensagem Fim", "string"),
    ]
    assert report.columns[6:] == list(HEADER_FACTS)
    assert [(r["Voto ID"], r["Hora Início"], r["Hora Fim"], r["Município"]) for r in report.collect()] == [
        (1, "08:00:00", "08:01:30", "73008"),
        (2, "08:01:00", "08:02:00", "73008"),
    ]
    assert run_vote_report(lines, str(tmp_path / "report")) == 2
    raw = b"".join(p.read_bytes() for p in (tmp_path / "report").glob("part-*"))
    assert "Município".encode("iso-8859-1") in raw


def test_null_message_is_no_match(spark):
    lines = spark.createDataFrame(
        [("f", 0, n, "06/10/2024 08:00:00", "INFO", "VOTA", m) for n, m in enumerate([None, VOTE_START, None, VOTE_END])],
        "file string, block long, line_id long, stamp string, level string, action string, message string",
    )
    assert vote_report(report_lines(lines)).count() == 1


def test_a_file_with_a_third_of_the_lines(spark, conf):
    """The file is cut into chunks for numbering, and its pairs are dealt out for the join with the facts."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    lines = spark.range(120_000, numPartitions=8).select(
        F.when(F.col("id") % 6 < 2, "hot").otherwise(F.concat(F.lit("f"), (F.col("id") / 6).cast("int") % 300)).alias("file"),
        F.col("id").alias("block"),
        F.lit(0).alias("line_id"),
        F.lit("06/10/2024 08:00:00").alias("stamp"),
        F.lit("INFO").alias("level"),
        F.lit("VOTA").alias("action"),
        F.when(F.col("id") < 3_000, F.concat(F.lit("Turno da UE: "), "id"))
        .when(F.col("id") % 2 == 0, F.concat(F.lit(VOTE_START), F.xxhash64("id")))
        .otherwise(VOTE_END)
        .alias("message"),
    )
    extract = report_lines(lines)
    assert extract.columns == REPORT_LINE_COLUMNS
    report = vote_report(extract, rows_per_chunk=1_000)
    assert report.where("file = 'hot'").count() == 39_000 // 2
    assert report.where("file = 'hot'").agg(F.max("ordinal"), F.countDistinct("ordinal")).collect()[0][:] == (19_500, 19_500)
    assert report.where("start_message IS NULL OR `Turno da UE` IS NULL").count() == 0
    # facts are copied for the file that is cut, one copy for as many pairs as a chunk has rows
    final = plan_of(report).split("== Initial Plan ==")[0]
    assert "_chunk" in final and "_group" in final
    plain = vote_report(extract)
    assert "_group" not in plan_of(plain).split("== Initial Plan ==")[0]
    assert sorted(map(str, plain.collect())) == sorted(map(str, report.collect()))


def test_every_line_is_kept_or_rejected(spark, tmp_path):
    write(tmp_path / "x" / "f.dat", AWKWARD)
    flagged = read_machine_logs(spark, str(tmp_path), mode="flagged").collect()
    assert len(flagged) == sum(1 for text in AWKWARD if text)
    rejected = [r for r in flagged if r["reject"]]
    assert [(r["reject"], r["reject_line"]) for r in rejected] == [("7 fields", text) for text in AWKWARD if text.count("\t") > 5]
    assert all(r[name] is None for r in rejected for name in ("stamp", "machine", "message", "event_time"))
    kept = sorted(str(r["stamp"]) for r in flagged if not r["reject"])
    assert kept == sorted(str(r["stamp"]) for r in read_machine_logs(spark, str(tmp_path), mode="tolerant").collect())
