import pytest

from tallyframe.storage import new_shared_path, refuse_existing, shared_folder


class _Session:
    """As much of a session as the folder depends on."""

    def __init__(self, setting, context_folder, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master = master
        self.getCheckpointDir = lambda: context_folder


def test_the_setting_comes_first_then_the_context():
    assert shared_folder(_Session("hdfs://a/b/", "x", "yarn")) == "hdfs://a/b"
    assert shared_folder(_Session(None, "hdfs://c/d", "yarn")) == "hdfs://c/d"


def test_only_one_process_may_have_a_temporary_folder():
    assert "tallyframe-" in new_shared_path(_Session(None, None, "local[4]"), "x")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(_Session(None, None, master))


def test_existing_paths_are_refused(spark, tmp_path):
    refuse_existing(spark, str(tmp_path / "new"))
    with pytest.raises(FileExistsError):
        refuse_existing(spark, str(tmp_path))
