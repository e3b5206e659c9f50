"""What the physical plans must show: pushed filters, pruned columns, no shuffle more than needed."""

import os

import pytest

from tests.conftest import plan_of
from tidelog.plans.catalog import queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def final_plan(spark, name):
    return plan_of(queries()[name](spark, FOLDER)).split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("adjacent_pairs", 1),
        ("select_events", 0),
        ("ordinal_pairs", 1),
        ("first_facts", 1),
        ("word_count", 1),
        ("great_circle_distance", 0),
        ("distinct_projection", 1),
        ("sanitize_columns", 0),
        ("list_resource_links", 0),
        ("list_catalog_files", 0),
        ("expand_archives", 0),
        ("expand_nested_archives", 0),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    plan = final_plan(spark, name)
    assert plan.count("Exchange hashpartitioning") == shuffles
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("adjacent_pairs", "Or(EqualTo(event_type,click),EqualTo(event_type,purchase))"),
        ("select_events", "GreaterThanOrEqual(ts,2024-01-15T00:00)"),
        ("ordinal_pairs", "EqualTo(event_type,click)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    execution = queries()[name](spark, FOLDER)._jdf.queryExecution()
    assert pushed in execution.explainString(_formatted(spark)).replace(", ", ",")


def _formatted(spark):
    return spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")


@pytest.mark.parametrize(
    ("name", "unread"),
    [
        ("adjacent_pairs", ["value", "props"]),
        ("word_count", ["doc_id", "lang", "source", "n_chars"]),
        ("great_circle_distance", ["o_totalprice", "o_orderpriority"]),
        ("distinct_projection", ["c_custkey", "c_name", "c_acctbal"]),
        ("list_resource_links", ["url"]),
    ],
)
def test_columns_are_pruned(spark, name, unread):
    schema = final_plan(spark, name).split("ReadSchema: struct<")[1].split(">")[0]
    assert not [column for column in unread if f"{column}:" in schema]


@pytest.mark.parametrize("name", ["adjacent_pairs_chunked", "ordinal_pairs_chunked"])
def test_chunked_queries_are_cut(spark, name):
    assert "_chunk0" in queries()[name](spark, FOLDER)._jdf.queryExecution().toString()


def test_ordinal_pairs_at_scale(spark, conf):
    """Without broadcasts, as for large tables: one scan, one shuffle and no join."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    plan = final_plan(spark, "ordinal_pairs")
    assert plan.count("Exchange ") == 1 and plan.count("FileScan parquet") == 1 and "Join" not in plan
    # pairs, facts, and the copies of the facts
    assert final_plan(spark, "vote_report").count("Exchange ") <= 4
