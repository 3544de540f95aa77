from pathlib import Path
from types import SimpleNamespace

import pytest

from vecindad.session import SETTINGS, shared_dir


def stub(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if folder else default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_dir(spark):
    own = shared_dir(spark)
    assert Path(own).is_dir() and shared_dir(spark) == own
    assert shared_dir(stub("yarn", "hdfs://x/checkpoints/")) == "hdfs://x/checkpoints"
    with pytest.raises(ValueError, match="shared folder"):
        shared_dir(stub("yarn"))


def test_settings_apply(spark):
    assert {key: spark.conf.get(key) for key in SETTINGS} == SETTINGS
