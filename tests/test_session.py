import os

import pytest

from arenaflow.operators.sizing import materialize_at, remove_folder
from arenaflow.session import ensure_checkpoint_dir, hadoop_path, may_use_own_folder, scratch_dir


@pytest.mark.parametrize(
    "master, own", [("local", True), ("local[8]", True), ("local[*]", True), ("local-cluster[2,1,1024]", False), ("yarn", False), ("spark://h:7077", False)]
)
def test_only_a_local_session_makes_its_own_folder(master, own):
    assert may_use_own_folder(master) is own


class _Unset:
    """A session on a cluster whose spark.checkpoint.dir is not set."""

    class conf:  # noqa: N801
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:  # noqa: N801
        master = "yarn"
        getConf = staticmethod(lambda: _Unset.conf)


def test_unset_folder_on_a_cluster_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Unset)


def test_paths_are_qualified_on_the_default_file_system(spark):
    assert ensure_checkpoint_dir(spark).startswith("file:")
    path = scratch_dir(spark, "qualified")
    assert path.startswith("file:") and os.path.isdir(path.removeprefix("file:"))
    fs, found = hadoop_path(spark, path)
    assert fs.exists(found)


def test_materialized_folder_is_removed(spark):
    df, path = materialize_at(spark.range(3), "gone")
    assert df.count() == 3
    remove_folder(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
