from types import SimpleNamespace

import pytest

from tractscope.session import new_table_path, shared_folder, write_once


def session(named=None, set_folder=None, master="local[2]"):
    """Stands in for a Spark session with the given settings."""
    state = {"folder": set_folder}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["folder"],
        setCheckpointDir=lambda folder: state.update(folder=folder),
    )
    conf = SimpleNamespace(get=lambda key, default: named or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_folder(session(named="hdfs:/shared/")) == "hdfs:/shared"
    assert shared_folder(session(set_folder="s3:/shared", master="yarn")) == "s3:/shared"


def test_a_cluster_without_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(master="yarn"))


def test_a_local_session_makes_one_and_keeps_it():
    local = session()
    assert shared_folder(local) == shared_folder(local) != ""


def test_written_table(spark):
    assert new_table_path(spark, "a") != new_table_path(spark, "a")
    frame = spark.range(10).selectExpr("id", "cast(null as string) as text")
    table = write_once(frame, "test")
    assert table.dtypes == frame.dtypes and table.count() == 10
