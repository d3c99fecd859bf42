from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from basketry.contracts import struct
from basketry.sources import paths, snapshots
from basketry.sources.snapshots import (
    latest_snapshot,
    preview,
    read_snapshot,
    snapshot_label,
    snapshot_label_of,
    summary_frame,
    write_snapshot,
)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_latest_is_the_greatest_label_as_text(spark, tmp_path):
    for label in ("2026-04-01", "2026-04-10", "2026-04-9", "2025-12-31"):
        (tmp_path / f"ingestion_date={label}").mkdir()
    (tmp_path / "zzz").mkdir()
    (tmp_path / "ingestion_date=9999").write_text("a file, not a snapshot")
    assert latest_snapshot(spark, str(tmp_path)) == "2026-04-9"


def test_missing_root_and_no_snapshot(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="directory not found"):
        latest_snapshot(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError, match="no ingestion_date="):
        latest_snapshot(spark, str(tmp_path))


def test_empty_newest_snapshot_is_an_error_and_not_skipped(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(spark.range(3), root, "2026-04-02")
    (tmp_path / "ingestion_date=2026-04-09").mkdir()
    assert latest_snapshot(spark, root) == "2026-04-09"
    with pytest.raises(FileNotFoundError, match="no data files"):
        read_snapshot(spark, root)
    assert ids(read_snapshot(spark, root, "2026-04-02")) == [0, 1, 2]


def test_label():
    assert snapshot_label("ingestion_date=2026-04-02") == "2026-04-02"
    assert snapshot_label("/a/ingestion_date=2026-04-02/part.parquet") == "2026-04-02"
    for wrong in ("/a/b", "my_ingestion_date=1", "ingestion_date="):
        with pytest.raises(ValueError, match="not a snapshot path"):
            snapshot_label(wrong)


def test_label_column(make):
    df = make("p string", ("/a/ingestion_date=x/f",), ("/a/b",), (None,))
    assert [r.l for r in df.select(snapshot_label_of(F.col("p")).alias("l")).collect()] == [
        "x",
        None,
        None,
    ]


def test_overwrite_replaces_one_snapshot(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(spark.range(5), root, "2026-04-01")
    write_snapshot(spark.range(9), root, "2026-04-02")
    for _ in range(2):
        summary = write_snapshot(spark.range(2), root, "2026-04-02")
        assert (summary.label, summary.rows) == ("2026-04-02", 2)
    assert ids(read_snapshot(spark, root, "2026-04-02")) == [0, 1]
    assert ids(read_snapshot(spark, root, "2026-04-01")) == [0, 1, 2, 3, 4]
    assert read_snapshot(spark, root).columns == ["id"]


def test_result_without_rows_replaces_the_old_one(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(spark.range(5), root, "d")
    assert write_snapshot(spark.range(5).where("id > 9"), root, "d").rows == 0
    empty = read_snapshot(spark, root)
    assert empty.columns == ["id"]
    assert empty.count() == 0


def test_order_of_rows_is_kept_on_disk(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(20000).withColumn("k", F.xxhash64("id") % 1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_snapshot(df.orderBy(F.desc("k")), root, "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "ingestion_date=d").glob("*.parquet"))
    assert len(files) > 1
    keys = [r.k for f in files for r in spark.read.parquet(str(f)).collect()]
    assert keys == sorted(keys, reverse=True)


def test_failed_write_keeps_the_old_snapshot(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(spark.range(5), root, "d")
    bad = spark.range(5).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_snapshot(bad, root, "d")
    assert ids(read_snapshot(spark, root)) == [0, 1, 2, 3, 4]


def test_contract_selects_by_name_and_fails_on_a_missing_column(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(spark.range(2).select("id", F.lit(1).alias("x")), root, "d")
    assert read_snapshot(spark, root, contract=struct("x int")).columns == ["x"]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        read_snapshot(spark, root, contract=struct("y int"))


def test_preview_and_summary(spark, tmp_path):
    summary = write_snapshot(spark.range(50), f"{tmp_path}/table_a", "d")
    assert preview(spark, summary).count() == 20
    assert preview(spark, summary, 30).count() == 30
    assert [tuple(r) for r in summary_frame(spark, [summary]).collect()] == [("table_a", "d", 50)]


def test_write_is_one_job(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-write", "one write")
    try:
        snapshots.write_snapshot(spark.range(100), str(tmp_path), "d")
        assert len(tracker.getJobIdsForGroup("one-write")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def session(spark, master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key.split(".")[1], default)),
        sparkContext=SimpleNamespace(master=master),
        _jvm=spark._jvm,
        _jsc=spark._jsc,
    )


def test_work_folder_is_the_shared_one(spark, tmp_path):
    cluster = session(spark, "yarn", checkpoint=f"{tmp_path}/shared/")
    one, two = (paths.work_folder(cluster, "x") for _ in range(2))
    assert one != two
    assert all(f.startswith(f"{tmp_path}/shared/x-") and paths.exists(spark, f) for f in (one, two))


def test_a_cluster_must_name_the_shared_folder(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        paths.work_folder(session(spark, "yarn"), "x")
    assert paths.exists(spark, paths.work_folder(session(spark, "local[4]"), "x"))


def test_work_folders_go_and_nothing_else(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paths, "_MADE", [])
    cluster = session(spark, "yarn", checkpoint=f"{tmp_path}/shared")
    made = paths.work_folder(cluster, "x")
    (tmp_path / "shared" / "kept").mkdir()
    paths.remove_work_folders()
    assert not paths.exists(spark, made) and (tmp_path / "shared" / "kept").exists()
