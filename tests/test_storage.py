"""Where intermediate tables may live, and that a job can delete its own."""

import os

import pytest

from storyloom import session
from storyloom.operators.materialize import mark, materialize, release


def test_only_local_masters_may_use_a_scratch_folder():
    assert session.is_local_master("local") and session.is_local_master("local[8]")
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://h:7077", "k8s://https://h"):
        assert not session.is_local_master(master)


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Ctx(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_release_deletes_the_tables_of_a_run(spark):
    since = mark()
    t = materialize(spark.range(10), "probe")
    path = t.inputFiles()[0].replace("file://", "")
    assert t.count() == 10 and os.path.exists(path)
    assert release(spark, since) == 1
    assert not os.path.exists(path)
