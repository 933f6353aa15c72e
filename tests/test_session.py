"""Scratch folders: only where all executors see them, and gone afterwards."""

import os
from types import SimpleNamespace

import pytest

from skewkit import session


class _Fake:
    def __init__(self, master, conf=None):
        self.values = dict(conf or {})
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
        self.conf = SimpleNamespace(get=lambda k, d=None: self.values.get(k, d), set=self.values.__setitem__)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_no_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Fake(master))
    assert session.ensure_checkpoint_dir(_Fake(master, {"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_private_folder_in_local_mode(master):
    assert os.path.isdir(session.ensure_checkpoint_dir(_Fake(master)))


def test_staged_copies_are_removed_on_request(spark):
    kept, gone = session.scratch_path(spark, "kept"), session.scratch_path(spark, "gone")
    for path in (kept, gone):
        spark.range(5).write.parquet(path)
    others = session.staged_paths(spark) - {gone}
    assert session.release_scratch(spark, keep=others) == [gone]
    assert os.path.isdir(kept) and not os.path.exists(gone)
