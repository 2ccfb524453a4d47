"""Where tables that are read more than once are written."""

import os
from types import SimpleNamespace

import pytest

from lapsewise.sources import workspace
from lapsewise.sources.workspace import materialise, new_path, shared_dir


def session(master, configured=None, checkpoint=None):
    context = SimpleNamespace(master=master, applicationId=f"test-{master}", getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: configured or default), sparkContext=context)


def test_configured_folder_wins():
    assert shared_dir(session("yarn", "hdfs://x/shared/", "hdfs://y")) == "hdfs://x/shared"
    assert shared_dir(session("yarn", None, "hdfs://y/ck")) == "hdfs://y/ck"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077"))


def test_local_mode_falls_back_to_a_temporary_folder():
    path = shared_dir(session("local[2]"))
    assert os.path.isdir(path) and shared_dir(session("local[2]")) == path


def test_written_tables_cut_the_lineage(spark):
    df = materialise(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().executedPlan().toString()
    assert new_path(spark, "x") != new_path(spark, "x")


def test_release_drops_the_applications_tables(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "owned_dir", lambda _: str(tmp_path / "own"))
    materialise(spark.range(3))
    assert os.listdir(tmp_path) == ["own"]
    workspace.release(spark)
    assert os.listdir(tmp_path) == []
