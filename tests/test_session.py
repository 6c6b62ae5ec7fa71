from types import SimpleNamespace

import pytest

from lamina import session


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def fake(master, **conf):
    return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))


def test_the_named_folder_is_used():
    spark = fake("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://x/y/"})
    assert session.shared_folder(spark) == "hdfs://x/y"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))


def test_a_local_master_gets_a_folder_once():
    spark = fake("local[4]")
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_staged_tables_are_released(spark):
    staging = session.Staging(spark)
    written = staging.write(spark.range(5), "test")
    assert written.count() == 5 and len(staging.paths) == 1
    path = staging.paths[0]
    staging.release()
    assert staging.paths == []
    with pytest.raises(Exception):
        spark.read.parquet(path)
