from __future__ import annotations

from types import SimpleNamespace

import pytest

from statloom.session import scratch_path, shared_folder


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, conf):
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_the_named_folder_is_used():
    spark = session("spark://host", {"spark.checkpoint.dir": "hdfs://shared/ck/"})
    assert shared_folder(spark) == "hdfs://shared/ck/"
    assert spark.sparkContext.folder == "hdfs://shared/ck/"
    assert scratch_path(spark, "x").startswith("hdfs://shared/ck/x-")


@pytest.mark.parametrize("master", ["spark://host", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_a_folder(master):
    with pytest.raises(RuntimeError):
        shared_folder(session(master, {}))


def test_a_local_session_keeps_one_temporary_folder():
    spark = session("local[2]", {})
    assert shared_folder(spark) == shared_folder(spark)


def test_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
