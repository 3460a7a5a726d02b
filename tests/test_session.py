import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from tallyward import session


def fake(named=None, set_later=None, master="local[2]"):
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: set_later)
    settings = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "file:/shared/warehouse/"}
    conf = SimpleNamespace(get=lambda key, default=None: settings[key] or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used(spark):
    assert session.work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.work_root(fake("hdfs://shared/work/")) == "hdfs://shared/work"
    assert session.work_root(fake(set_later="s3://bucket/w", master="yarn")) == "s3://bucket/w"


def test_only_a_local_master_may_do_without():
    assert session.work_root(fake()) == "file:/shared/warehouse/_work"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(fake(master="spark://host"))


def test_written_tables_start_a_new_plan(spark):
    df = session.materialise(spark.range(10).selectExpr("id", "id % 3 as k"), "test")
    assert df.count() == 10 and [f.name for f in df.schema] == ["id", "k"]
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "Range" not in plan


def test_only_own_tables_are_discarded(spark, tmp_path):
    kept = session.materialise(spark.range(3), "kept")
    gone = session.materialise(spark.range(3), "gone")
    spark.range(3).write.parquet(str(tmp_path / "input"))
    for df in (gone, spark.read.parquet(str(tmp_path / "input"))):
        session.discard(df)
    assert kept.count() == 3 and spark.read.parquet(str(tmp_path / "input")).count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        gone.count()


def test_all_tables_of_a_plan_are_discarded(spark):
    kept, left, right = (session.materialise(spark.range(3), label) for label in ("kept", "left", "right"))
    session.discard(left.join(right, "id"))
    assert kept.count() == 3
    for gone in (left, right):
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
            gone.count()


def test_shuffle_files_go_with_their_job(spark):
    """At the end of the job, not when the driver's memory is collected; the setting is as before."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffled():
        return {p for folder in folders for p in Path(str(folder)).rglob("shuffle_*")}

    before, setting = shuffled(), spark.conf.get(session._SHUFFLES_GO)
    rows = spark.range(1000).repartition(3, "id")
    written = session.materialise(rows, "dealt")
    for _ in range(50):  # executors delete them a little later
        if not (new := shuffled() - before):
            break
        time.sleep(0.1)
    assert not new and spark.conf.get(session._SHUFFLES_GO) == setting
    assert written.count() == rows.count() == 1000


def test_work_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "work_folder", lambda _: str(tmp_path / "work"))
    session.materialise(spark.range(3), "gone")
    assert any((tmp_path / "work").iterdir())
    session.clear_work(spark)
    assert not (tmp_path / "work").exists()


def test_few_splits_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(0, 100, 1, 9).write.parquet(str(tmp_path / "many"))
    assert session.use_all_cores(spark.read.parquet(str(tmp_path / "one"))).rdd.getNumPartitions() == 4
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        many = spark.read.parquet(str(tmp_path / "many"))
        assert session.use_all_cores(many) is many
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
