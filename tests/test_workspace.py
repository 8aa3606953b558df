from __future__ import annotations

import pytest

from peneira import workspace


class Session:
    def __init__(self, **values: str) -> None:
        values = {name.replace("__", "."): value for name, value in values.items()}
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: values.get(name, default))})


def test_the_cluster_names_the_folder():
    session = Session(spark__checkpoint__dir="hdfs:///shared/", spark__master="yarn", spark__app__id="app-1")
    path = workspace.new_folder(session, "raw")
    assert path.startswith("hdfs:///shared/peneira/app-1/raw-")
    assert path != workspace.new_folder(session, "raw")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.new_folder(Session(spark__master="yarn"), "raw")


def test_a_local_session_gets_a_temporary_folder():
    assert workspace.new_folder(Session(spark__master="local[2]"), "raw").count("peneira") >= 2


def test_folders_can_be_dropped(spark):
    path = workspace.new_folder(spark, "drop")
    spark.range(3).write.parquet(path)
    other = Session(spark__checkpoint__dir=workspace.shared_root(spark), spark__app__id="another-application")
    other.sparkContext = spark.sparkContext
    spark.range(3).write.parquet(workspace.new_folder(other, "drop"))
    assert workspace.drop_folders(other) is True
    assert workspace.drop_folders(other) is False
    assert spark.read.parquet(path).count() == 3  # that of this application stays
