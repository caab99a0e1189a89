"""Checkpoint folder rules: use the session's setting; a scratch folder only in local mode."""

import pytest

from stagegate.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current, self.set_to = master, current, None

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.set_to = self.current = path


class _Session:
    def __init__(self, conf_value, master, current=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(master, current)


def test_configured_folder_is_used():
    s = _Session("hdfs://shared/ckpt", "yarn")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.set_to == "hdfs://shared/ckpt"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session(None, "spark://master:7077"))


def test_local_mode_gets_a_scratch_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    s = _Session(None, "local[4]")
    path = ensure_checkpoint_dir(s)
    assert path.startswith(str(tmp_path)) and s.sparkContext.set_to == path


def test_existing_context_folder_is_kept():
    s = _Session(None, "yarn", current="hdfs://already/set")
    assert ensure_checkpoint_dir(s) == "hdfs://already/set" and s.sparkContext.set_to is None


def test_shared_folder_is_new_and_below_one_root(spark):
    from stagegate.session import shared_folder

    a, b = shared_folder(spark, "t"), shared_folder(spark, "t")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
    spark.range(2).write.parquet(a)
    assert spark.read.parquet(a).count() == 2
