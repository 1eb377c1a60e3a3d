"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from voltdrift.driver.queries import scratch
from voltdrift.session import make_folder, materialize, remove_folder


def fake(master, checkpoint=None, context_folder=None):
    conf = {"spark.master": master, "spark.checkpoint.dir": checkpoint}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key) or default),
        sparkContext=SimpleNamespace(
            applicationId="app-1", getCheckpointDir=lambda: context_folder
        ),
    )


def test_configured_folder_is_used():
    assert scratch(fake("yarn", "hdfs:///shared/")).startswith("hdfs:///shared/app-1/")
    assert scratch(fake("local[2]", "/shared")).startswith("/shared/app-1/")
    assert scratch(fake("yarn", None, "s3://b/c")).startswith("s3://b/c/app-1/")


def test_cluster_without_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(fake("spark://host:7077"))


def test_materialized_rows_are_read_from_files(spark, tmp_path):
    df = materialize(spark.range(10).selectExpr("id", "rand() AS x"), str(tmp_path))
    assert df.orderBy("id").collect() == df.orderBy("id").collect()
    assert all(str(tmp_path) in f for f in df.inputFiles())


def test_folders(spark, tmp_path):
    folder = tmp_path / "a" / "b"
    make_folder(spark, str(folder))
    assert folder.is_dir()
    remove_folder(spark, str(folder))
    remove_folder(spark, str(folder))
    assert not folder.exists()
