import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def plan_of(frame) -> str:
    """The final physical plan, after adaptive execution."""
    frame.write.format("noop").mode("overwrite").save()
    execution = frame._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()
