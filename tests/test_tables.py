import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidelog.operators.dimensions import distinct_projection
from tidelog.plans.flows import run_correspondence_files
from tidelog.schemas import CORRESPONDENCE_COLUMNS
from tidelog.sources.tables import append_once, read_correspondence, read_partitioned, write_partitioned
from tidelog.sources.types import narrowest_types, with_types

HEADER = "DT_GERACAO;AA_ELEICAO;CD_PLEITO;SG_UF;CD_MUNICIPIO;NM_MUNICIPIO;NR_ZONA;NR_URNA_ESPERADA"
PALMAS = '"01/10";2024;452;"TO";73008;"PALMAS";7;1001'
SAO_PAULO = "02/10;2024;452;SP;71072;SÃO PAULO;1;1002"
NO_ZONE = "02/10;2024;452;SP;71072;SÃO PAULO;;1003"
BAD_CODE = "02/10;2024;x;TO;1;A;1;1"


def files(tmp_path):
    (tmp_path / "1.csv").write_bytes("\n".join([HEADER, PALMAS, PALMAS, SAO_PAULO, NO_ZONE]).encode("iso-8859-1"))
    (tmp_path / "2.csv").write_bytes("\n".join([HEADER, PALMAS, NO_ZONE, BAD_CODE]).encode("iso-8859-1"))
    return str(tmp_path / "*.csv")


def test_correspondence(spark, tmp_path):
    source, target = files(tmp_path), str(tmp_path / "out")
    table = read_correspondence(spark, source)
    # one value that is no number keeps its column text
    assert [kind for _, kind in table.dtypes] == ["int", "string", "string", "int", "string", "int", "int"]
    assert run_correspondence_files(spark, source, target) == 4
    assert sorted(p.name for p in (tmp_path / "out" / "parquet").glob("SG_UF=*")) == ["SG_UF=SP", "SG_UF=TO"]
    assert spark.read.parquet(f"{target}/parquet").columns[-1] == "SG_UF"
    stored = read_partitioned(spark, f"{target}/parquet", table)
    assert stored.columns == CORRESPONDENCE_COLUMNS
    assert sorted(map(str, stored.collect())) == sorted(map(str, table.distinct().collect()))
    assert stored.where("NM_MUNICIPIO = 'SÃO PAULO'").count() == 2
    assert stored.where("CD_PLEITO IS NULL").count() == 0 and stored.where("CD_PLEITO = 'x'").count() == 1


def test_types_on_clean_files_are_those_that_spark_infers(spark, tmp_path):
    rows = [
        "i;l;d;e;day;at;yes;t;none;plus",
        "1;3000000000;1.5;1e3;2024-10-06;2024-10-06 08:00:00;true;x;;+5",
        "-2;5;2;.5;2024-10-07;2024-10-06T08:00:01.5;FALSE;1;;-007",
        ";;;;;;;;;",
    ]
    (tmp_path / "1.csv").write_text("\n".join(rows))
    options = {"sep": ";", "header": True}
    inferred = spark.read.csv(str(tmp_path / "1.csv"), inferSchema=True, **options)
    raw = spark.read.csv(str(tmp_path / "1.csv"), **options)
    types = narrowest_types(raw)
    assert types == dict(inferred.dtypes)
    assert sorted(map(str, with_types(raw, types).collect())) == sorted(map(str, inferred.collect()))


def test_one_unclean_value_keeps_its_column_text(spark):
    rows = [(str(n), str(n), "2024-10-06", "99999999999999999999") for n in range(1000)] + [("x", " 7", "2024-13-06", "1")]
    raw = spark.createDataFrame(rows, "a string, b string, c string, d string").repartition(7)
    assert set(narrowest_types(raw).values()) == {"string"}
    typed = with_types(raw, narrowest_types(raw))
    assert sorted(map(tuple, typed.collect())) == sorted(rows)
    assert narrowest_types(raw.limit(0)) == dict.fromkeys("abcd", "string")


def test_a_job_appends_once(spark, tmp_path):
    target, frame = str(tmp_path / "t"), spark.range(100).repartition(3)
    frame.write.parquet(target)
    for job in ("a", "b", "a", "a"):
        append_once(frame, target, job)
    assert spark.read.parquet(target).count() == 300
    # cut off after some files were renamed, then run again with other files
    (tmp_path / "t" / "_jobs" / "b").unlink()
    append_once(frame.coalesce(1), target, "b")
    assert spark.read.parquet(target).count() == 300
    append_once(frame, str(tmp_path / "new"), "a-1.x")
    assert spark.read.parquet(str(tmp_path / "new")).count() == 100
    with pytest.raises(ValueError, match="job id"):
        append_once(frame, target, "../x")


def test_distinct_counts_nulls_as_equal(spark):
    frame = spark.createDataFrame([(1, None, 5), (1, None, 6), (2, "a", 7)], "a int, b string, c int")
    assert distinct_projection(frame, ["a", "b"]).count() == 2
    plan = plan_of(distinct_projection(frame, ["a", "b"])).split("== Initial Plan ==")[0]
    assert plan.count("HashAggregate") == 2


def test_keys_that_look_like_numbers_come_back_as_text(spark, tmp_path):
    frame = spark.createDataFrame([("01", 1), ("2", 2), (None, 3)], "k string, v int")
    write_partitioned(frame, str(tmp_path / "t"), ["k"])
    stored = read_partitioned(spark, str(tmp_path / "t"), frame)
    assert stored.dtypes == frame.dtypes
    assert sorted(map(str, stored.collect())) == sorted(map(str, frame.collect()))
    assert stored.where("k = '01'").count() == 1
    assert "PartitionFilters: [isnotnull(k" in plan_of(stored.where("k = '01'"))


def test_a_key_with_most_rows_is_written_by_many_tasks(spark, conf, tmp_path):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="200k")
    frame = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 10 < 4, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 10)).alias("k"),
        F.xxhash64("id").alias("v"),
    )
    write_partitioned(frame, str(tmp_path / "t"), ["k"])
    parts = {d.name: len(list(d.glob("part-*"))) for d in (tmp_path / "t").glob("k=*")}
    assert parts["k=hot"] >= 3 and all(n <= 8 for n in parts.values())
    assert spark.read.parquet(str(tmp_path / "t")).count() == 300_000


def test_rows_that_differ_in_values_that_do_not_fit_all_stay(spark, tmp_path):
    rows = [f"x;2024;1;TO;7;A;1;{machine}" for machine in ("x1", "x2", "3000000001", "5", "05")]
    (tmp_path / "1.csv").write_text("\n".join([HEADER, *rows]))
    assert run_correspondence_files(spark, str(tmp_path / "1.csv"), str(tmp_path / "out")) == 5
    stored = spark.read.parquet(str(tmp_path / "out" / "parquet"))
    assert sorted(r.NR_URNA_ESPERADA for r in stored.collect()) == ["05", "3000000001", "5", "x1", "x2"]
