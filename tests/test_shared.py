from __future__ import annotations

from types import SimpleNamespace

import pytest

from harbor.sources.shared import shared_folder


def session(master, folder=None, checkpoints=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoints)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_comes_first():
    assert shared_folder(session("yarn", "hdfs:///shared/", "hdfs:///other")) == "hdfs:///shared"
    assert shared_folder(session("yarn", None, "hdfs:///other")) == "hdfs:///other"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_must_name_one(master):
    with pytest.raises(ValueError):
        shared_folder(session(master))


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_master_may_do_without(master):
    assert shared_folder(session(master))
