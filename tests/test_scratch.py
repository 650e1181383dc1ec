from pathlib import Path
from types import SimpleNamespace

import pytest

from candlewick.sources import scratch
from candlewick.sources.scratch import materialise, new_folder, shared_folder


def session(master, setting=None, app="app-1"):
    conf = SimpleNamespace(get=lambda key, default=None: setting or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=app))


def test_the_setting_wins():
    assert shared_folder(session("spark://host:7077", "hdfs://shared/x/")) == "hdfs://shared/x"
    assert new_folder(session("local[2]", "/shared"), "a") != new_folder(session("local[2]", "/shared"), "a")


def test_only_a_local_session_gets_a_temporary_folder():
    first = shared_folder(session("local[2]"))
    assert first == shared_folder(session("local[2]")) != shared_folder(session("local[2]", app="app-2"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_materialise_keeps_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "cast(id AS decimal(20,8)) AS price", "timestamp '2024-01-01' AS t")
    copy = materialise(df, "copy")
    assert copy.dtypes == df.dtypes and copy.count() == 5
    assert "FileScan" in copy._jdf.queryExecution().executedPlan().toString()


def test_passing_tables_go_and_kept_ones_stay(spark):
    folder = lambda df: Path(scratch.folder_of(df))
    with scratch.passing(spark) as keep:
        first = scratch.materialise(spark.range(3), "first")
        with scratch.passing(spark) as inner:
            second = scratch.materialise(first.selectExpr("id + 1 AS id"), "second")
            third = inner(scratch.materialise(second, "third"))
        assert not folder(second).exists() and folder(third).exists()
        last = keep(scratch.materialise(third.selectExpr("id + 1 AS id"), "last"))
    assert not folder(first).exists() and not folder(third).exists()
    assert sorted(r.id for r in last.collect()) == [2, 3, 4]
    scratch.discard(last)
    assert not folder(last).exists()
    scratch.discard(spark.range(3))  # written by nobody
