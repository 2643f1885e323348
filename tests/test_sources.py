import tempfile

import pytest

from txmill.sources import s3a_settings, scratch_path


def test_s3a_settings_need_all_three_values():
    assert s3a_settings("https://e", "key", None) == {}
    assert s3a_settings("", "key", "secret") == {}
    settings = s3a_settings("https://e", "key", "secret")
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "https://e"
    assert settings["spark.hadoop.fs.s3a.access.key"] == "key"
    assert settings["spark.hadoop.fs.s3a.secret.key"] == "secret"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


class FakeSession:
    def __init__(self, master, conf, session=()):
        self.sparkContext = self
        self.master = master
        self._conf = conf
        self.conf = dict(session)

    def getConf(self):
        return self._conf


def test_scratch_lies_in_the_shared_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert one.startswith(f"{root}/t-") and one != two


def test_scratch_refuses_local_folders_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession("yarn", {}), "t")
    assert scratch_path(FakeSession("local[2]", {}), "t").startswith(tempfile.gettempdir())
    assert scratch_path(
        FakeSession("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"}), "t"
    ).startswith("hdfs:///shared/t-")
    late = FakeSession("yarn", {}, {"spark.checkpoint.dir": "hdfs:///late"})
    assert scratch_path(late, "t").startswith("hdfs:///late/t-")
