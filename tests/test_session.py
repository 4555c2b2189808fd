"""Where scratch output goes."""

from types import SimpleNamespace

import pytest

from indtables.session import ensure_checkpoint_dir, path_exists


def fake(master, setting=None, current=None):
    calls = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=calls.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=sc), calls


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,512]"])
def test_a_cluster_has_to_name_the_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake(master)[0])
    assert ensure_checkpoint_dir(fake(master, "s3a://lake/ckpt/")[0]) == "s3a://lake/ckpt"
    assert ensure_checkpoint_dir(fake(master, None, "hdfs:///c")[0]) == "hdfs:///c"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_session_gets_its_own(master):
    spark, calls = fake(master)
    assert calls == [] and ensure_checkpoint_dir(spark) == calls[0]


def test_path_exists(spark, scratch):
    assert path_exists(spark, scratch) and not path_exists(spark, f"{scratch}/none")
