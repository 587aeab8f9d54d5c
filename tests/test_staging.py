"""Staged tables: where they go, and that they can be removed."""

import os

import pytest

from samplecraft.plans import staging


class Session:
    """Just the settings that the folder depends on."""

    def __init__(self, master, folder=None):
        self.values = {staging.CHECKPOINT_DIR: folder} if folder else {}
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


def test_a_shared_folder_has_to_be_named():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session("local[4]"))
    assert staging.shared_folder(Session("local[4]", "/shared/")) == "/shared"


def test_only_a_local_session_gets_a_folder_of_its_own():
    cluster = staging.set_local_folder(Session("spark://host:7077"))
    assert cluster.values == {}
    named = staging.set_local_folder(Session("local[2]", "/shared"))
    assert named.values == {staging.CHECKPOINT_DIR: "/shared"}
    local = staging.set_local_folder(Session("local[2]"))
    assert os.path.isdir(staging.shared_folder(local))


def test_staged_tables_can_be_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(tmp_path))
    table = staging.staged(spark.range(5), "numbers")
    assert table.count() == 5
    assert staging.remove_staged(spark)
    assert not staging.remove_staged(spark)
    assert list(tmp_path.joinpath("samplecraft").iterdir()) == []
