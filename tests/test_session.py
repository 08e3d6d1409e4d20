"""The shared folder: required off local masters."""

from types import SimpleNamespace

import pytest

from adsift.session import shared_dir


class FakeContext:
    def __init__(self, master, setting=None):
        self.master, self.setting, self.folder = master, setting, None

    def getConf(self):
        return SimpleNamespace(get=lambda key, default=None: self.setting or default)

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=FakeContext(master)))
    own = FakeContext(master, "hdfs://ns/shared/")
    assert shared_dir(SimpleNamespace(sparkContext=own)) == "hdfs://ns/shared"
    assert own.folder == "hdfs://ns/shared/"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_session_gets_a_private_folder(master):
    context = FakeContext(master)
    assert shared_dir(SimpleNamespace(sparkContext=context)) == context.folder.rstrip("/")
