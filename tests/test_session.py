from __future__ import annotations

from types import SimpleNamespace

import pytest

from hybridframe.plans.session import shared_folder


def session(master: str, folder: str | None):
    conf = SimpleNamespace(get=lambda key, default: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError):
        shared_folder(session("spark://host:7077", None))
    with pytest.raises(RuntimeError):
        shared_folder(session("local-cluster[2,1,1024]", None))
    assert shared_folder(session("spark://host:7077", "hdfs:///tmp/")).startswith("hdfs:///tmp/hybridframe-")
    assert shared_folder(session("local[2]", None)) != shared_folder(session("local[2]", None))
