"""Session settings that loads depend on."""

import pytest

from salesflow import session


def test_off_a_local_master_a_shared_folder_is_required():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf({"spark.master": "yarn"}), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_scratch_paths_are_unique(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
