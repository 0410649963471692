"""The written intermediates go to the shared folder the session names."""

from types import SimpleNamespace

import pytest

from ledgerlight.plans.lineage import shared_dir


def test_cluster_without_shared_folder_is_an_error():
    context = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(sparkContext=context, conf={}))


def test_shared_folder_is_the_one_set(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
