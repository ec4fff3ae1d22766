from types import SimpleNamespace

import pytest

from tenura.sources import workspace


def test_stored_table_is_read_back_and_released(spark, monkeypatch, tmp_path):
    application = spark.sparkContext.applicationId
    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(tmp_path))
    stored = workspace.store(spark.range(10), "t")
    assert stored.count() == 10
    assert len(list(tmp_path.rglob("*.parquet"))) > 0
    assert workspace.release(spark)
    assert list(tmp_path.iterdir()) == []
    assert not workspace.exists(spark, f"{tmp_path}/tenura-{application}")


def session_of(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_folder_named_by_the_cluster_is_used():
    named = session_of("spark://host:7077", "hdfs:///work/")
    assert workspace.shared_folder(named) == "hdfs:///work"
    assert workspace.new_path(named, "t").startswith("hdfs:///work/tenura-app-1/t-")


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(session_of("yarn"))
    with pytest.raises(ValueError, match="own disk"):
        workspace.shared_folder(session_of("yarn", "file:///work"))
    assert workspace.shared_folder(session_of("local-cluster[3,2,1024]", "file:///work")) == "file:///work"


def test_a_table_is_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "numbers")
    with pytest.raises(FileNotFoundError):
        workspace.read_table(spark, path)
    first = workspace.replace_table(spark.range(5), path)
    second = workspace.replace_table(workspace.read_table(spark, path).selectExpr("id + 10 AS id"), path)
    assert sorted(r[0] for r in second.collect()) == [10, 11, 12, 13, 14]
    assert first.count() == 5  # a reader that has begun keeps its version
    third = workspace.replace_table(spark.range(2).selectExpr("id", "'x' AS name"), path)
    assert third.columns == ["id", "name"]
    assert workspace.read_table(spark, path).count() == 2
    assert len([p for p in (tmp_path / "numbers").iterdir() if p.is_dir()]) == 2


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "kept")
    workspace.replace_table(spark.range(3), path)
    broken = workspace.read_table(spark, path).selectExpr("raise_error('stop') AS id")
    with pytest.raises(Exception, match="stop"):
        workspace.replace_table(broken, path)
    assert workspace.read_table(spark, path).count() == 3
