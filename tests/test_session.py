from types import SimpleNamespace

import pytest

from linetally.session import checkpoint_folder, checkpointed, shared_folder
from linetally.sources import files


def fake(master, named=None):
    conf = SimpleNamespace(get=lambda name, default: named or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_named_folder_wins():
    assert shared_folder(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(fake("local[4]", "/shared")) == "/shared"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake("local-cluster[2,1,1024]"))


def test_checkpoints_go_to_the_named_folder(spark):
    rows = checkpointed(spark.range(10))
    named = spark.conf.get("spark.checkpoint.dir")
    assert rows.count() == 10
    assert named in spark.sparkContext.getCheckpointDir()
    assert "Range" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_checkpoint_folder_is_removed_after_use(spark):
    before = spark.sparkContext.getCheckpointDir()
    with checkpoint_folder(spark) as folder:
        assert checkpointed(spark.range(5)).count() == 5
        assert files.exists(spark, folder)
    assert not files.exists(spark, folder)
    assert checkpointed(spark.range(5)).count() == 5
    assert before is None or spark.sparkContext.getCheckpointDir().startswith(before.rsplit("/", 1)[0])
