import os

import pytest

from tidelog.session import scratch_path, settled, shared_folder


def stored(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return {name for name in os.listdir(folder) if name.startswith("extract-")}


def test_paths_are_fresh_and_below_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_folder(spark).rstrip("/") + "/x-")


def test_an_extract_lives_as_long_as_its_block(spark):
    before = stored(spark)
    with settled(spark.range(5)) as extract:
        assert extract.count() == 5 and len(stored(spark) - before) == 1
    assert stored(spark) == before


def test_an_extract_is_removed_after_an_error(spark):
    before = stored(spark)
    with pytest.raises(RuntimeError), settled(spark.range(5)):
        raise RuntimeError
    with pytest.raises(Exception, match="zero"), settled(spark.range(5).selectExpr("1 / (id - id) AS x")):
        pass
    assert stored(spark) == before
