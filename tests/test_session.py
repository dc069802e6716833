"""Scratch tables: shared folder or an error, and gone after release."""

import os
from types import SimpleNamespace

import pytest

from airq import session


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_is_an_error(master):
    none = SimpleNamespace(get=lambda *a: None)
    fake = SimpleNamespace(conf=none, sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(fake)


def test_release_deletes_what_was_written(spark):
    df = session.materialize(spark.range(5), "gone")
    folder = session.session_folder(spark)
    path = folder.removeprefix("file://").removeprefix("file:")
    assert df.count() == 5 and os.listdir(path)
    session.release(spark)
    assert not os.path.exists(path)
    assert session.session_folder(spark) != folder
