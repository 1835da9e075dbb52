"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from clinflat.session import shared_dir, stage, text_bytes


def fake(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_configured_folder_is_used():
    assert shared_dir(fake("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"


@pytest.mark.parametrize("folder", ["file:///mnt/shared", "/mnt/shared"])
def test_mounted_folder_is_used_on_a_cluster(folder):
    assert shared_dir(fake("spark://host:7077", folder)) == folder


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake("yarn"))


def test_local_session_keeps_one_folder():
    assert shared_dir(fake("local[2]")) == shared_dir(fake("local[2]"))


def test_text_bytes_counts_every_row(spark):
    df = spark.createDataFrame([("ab", 1), (None, 22)], "a string, b int")
    assert text_bytes(df) == 2 * 16 + 2 + 1 + 2
    assert text_bytes(df.limit(0)) == 0


def test_tables_are_staged_in_a_mounted_folder_of_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert sorted(r.id for r in stage(spark.range(5), "numbers").collect()) == [0, 1, 2, 3, 4]
