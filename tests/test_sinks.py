from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from campuslake.sinks import (
    cluster_by,
    compact,
    publish,
    publish_snapshot,
    read_snapshot,
    retain_snapshots,
    snapshot_history,
    table_detail,
)
from campuslake.sinks.catalog import register_table
from campuslake.sinks.snapshots import versions
from campuslake.sinks.storage import scratch_folder
from campuslake.sources import read_path_sql, read_table

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def frame(spark):
    """Two thirds of the rows in one program, some without a program."""
    return spark.range(3_000, numPartitions=6).selectExpr(
        "id",
        "case when id % 3 < 2 then '1' when id % 30 = 2 then null else concat('p', id % 4) end as program_id",
        "id % 11 as level",
    )


def _same(left, right):
    return left.count() == right.count() and left.exceptAll(right.select(*left.columns)).isEmpty()


def test_publish_counts_what_it_writes(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert publish(frame, path) == 3_000
    assert publish(frame.where("id < 10"), path) == 10
    assert spark.read.parquet(path).count() == 10


def test_publish_of_nothing(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert publish(frame.where("id < 0"), path) == 0
    assert spark.read.parquet(path).schema.names == frame.columns
    assert publish(frame.where("id < 0"), str(tmp_path / "p"), partition_by=["program_id"]) == 0


def test_partition_values_and_order_survive(spark, frame, tmp_path, plan):
    path = str(tmp_path / "t")
    assert publish(frame, path, partition_by=["program_id"]) == 3_000
    back = read_table(spark, path, schema=frame.schema)
    assert back.columns == frame.columns and back.schema["program_id"].dataType.typeName() == "string"
    assert _same(frame, back)
    assert back.where("program_id is null").count() == 100
    filtered = back.where("program_id = '1'")
    assert "PartitionFilters: [isnotnull(program_id" in plan(filtered)
    assert filtered.count() == 2_000


def test_partitioned_publish_without_adaptive_execution_adds_no_shuffle(spark, frame, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert publish(frame, str(tmp_path / "t"), partition_by=["program_id"]) == 3_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_program_is_written_by_several_tasks(spark, tmp_path):
    keep = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(keep)
    spark.conf.set(keep, "64KB")
    try:
        hot = spark.range(200_000, numPartitions=8).selectExpr("id", "sha2(cast(id as string), 256) as s", "'P' as program_id")
        path = str(tmp_path / "t")
        publish(hot, path, partition_by=["program_id"])
        assert table_detail(spark, path).first().num_files > 4
    finally:
        spark.conf.set(keep, before)


def test_overwrite_replaces_the_schema(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish(frame, path)
    publish(frame.select(F.col("id").cast("string").alias("id"), F.lit(1).alias("more")), path)
    assert spark.read.parquet(path).dtypes == [("id", "string"), ("more", "int")]


def test_catalog_table_with_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish(frame, path, partition_by=["program_id"])
    for _ in range(2):  # IF NOT EXISTS
        register_table(spark, "gold_frame", path, schema=frame.schema, partition_by=["program_id"])
    try:
        assert spark.sql("select count(*) from gold_frame where program_id = '1'").first()[0] == 2_000
        assert spark.table("gold_frame").schema["program_id"].dataType.typeName() == "string"
    finally:
        spark.sql("drop table gold_frame")
    assert read_path_sql(spark, path).count() == 3_000


def test_snapshots(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    wider = frame.withColumn("more", F.lit("x"))
    assert publish_snapshot(frame, path, DAY) == 0
    assert publish_snapshot(wider.where("id < 5"), path, DAY + timedelta(days=6)) == 1
    assert publish_snapshot(wider, path, DAY + timedelta(days=9)) == 2
    assert _same(frame, read_snapshot(spark, path, 0))
    assert read_snapshot(spark, path, 0).columns == frame.columns
    assert read_snapshot(spark, path).columns == wider.columns
    history = {r.version: r for r in snapshot_history(spark, path).collect()}
    assert {v: r.num_rows for v, r in history.items()} == {0: 3_000, 1: 5, 2: 3_000}
    assert versions(spark, path)[1] == DAY + timedelta(days=6)


def test_retention_keeps_a_week_and_always_the_newest(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for days in (0, 6, 9):
        publish_snapshot(frame, path, DAY + timedelta(days=days))
    assert retain_snapshots(spark, path, now=DAY + timedelta(days=7)) == []
    assert retain_snapshots(spark, path, now=DAY + timedelta(days=10)) == [0]
    assert retain_snapshots(spark, path, now=DAY + timedelta(days=400)) == [1]
    assert list(versions(spark, path)) == [2]
    assert publish_snapshot(frame, path, DAY) == 3
    assert _same(frame, read_snapshot(spark, path))


def test_a_failed_publication_is_never_read(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish_snapshot(frame, path, DAY)
    failing = frame.where("id < 7").withColumn("x", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        publish_snapshot(failing, path, DAY + timedelta(days=1))
    (tmp_path / "t" / "_version=1" / f"_published_at={int(DAY.timestamp()) + 86400}").mkdir(parents=True, exist_ok=True)
    assert list(versions(spark, path)) == [0]
    assert _same(frame, read_snapshot(spark, path))
    assert [r.version for r in snapshot_history(spark, path).collect()] == [0]
    assert publish_snapshot(frame, path, DAY + timedelta(days=2)) == 2
    assert retain_snapshots(spark, path, now=DAY + timedelta(days=30)) == [0, 1]
    assert list(versions(spark, path)) == [2]


def test_compaction_keeps_the_rows_in_fewer_files(spark, frame, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    publish(frame.repartition(12), source)
    assert compact(spark, source, target) == 3_000
    assert table_detail(spark, target).first().num_files < table_detail(spark, source).first().num_files
    assert _same(frame, read_table(spark, target, schema=frame.schema))


def test_compaction_of_a_partitioned_table_keeps_its_layout(spark, frame, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    frame.write.partitionBy("program_id").parquet(source)
    assert compact(spark, source, target, frame.schema, ["program_id"]) == 3_000
    assert table_detail(spark, target).first().num_files < table_detail(spark, source).first().num_files
    assert _same(frame, read_table(spark, target, schema=frame.schema).where("true"))


def test_clustering_cuts_a_hot_value_into_several_files(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish(cluster_by(frame, ["program_id"], ["id"], pieces=6), path)
    back = spark.read.parquet(path)
    assert _same(frame, back)
    spread = back.groupBy("_metadata.file_path").agg(F.min("program_id"), F.max("program_id"), F.count("*").alias("n"))
    sizes = [r.n for r in spread.collect()]
    assert len(sizes) >= 5 and max(sizes) < 1_500  # one program holds 2000 rows
    only = back.where("program_id = 'p2'").select("_metadata.file_path").distinct().count()
    assert only < len(sizes)


def test_detail(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish(frame.coalesce(2), path)
    got = table_detail(spark, path).first()
    assert (got.format, got.num_files, got.num_rows) == ("parquet", 2, 3_000)
    assert got.size_in_bytes == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one.startswith(shared) and one != other


def test_compaction_refuses_what_would_lose_data(spark, frame, tmp_path):
    source = str(tmp_path / "s")
    publish(frame.withColumn("program_id", F.lit("007")), source, partition_by=["program_id"])
    for target in (source, f"{source}/inner", str(tmp_path)):
        with pytest.raises(ValueError):
            compact(spark, source, target)
    with pytest.raises(ValueError):
        compact(spark, source, str(tmp_path / "t"), partition_by=["program_id"])
    assert compact(spark, source, str(tmp_path / "t"), frame.schema, ["program_id"]) == 3_000
    back = read_table(spark, str(tmp_path / "t"), schema=frame.schema)
    assert [r[0] for r in back.select("program_id").distinct().collect()] == ["007"]


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        scratch_folder(Session(), "x")
    Session.conf = Conf({"spark.master": "local[4]"})
    assert "campuslake" in scratch_folder(Session(), "x")


def test_table_detail_counts_files(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    publish(frame, path)
    files = spark.read.parquet(path).select("_metadata.file_path").distinct().count()
    assert table_detail(spark, path).first()["num_files"] == files


def test_working_folders_can_be_cleared(spark):
    from campuslake.plans import workload
    from campuslake.sinks.storage import list_files, list_folders

    folder = scratch_folder(spark, "t")
    root, own = folder.rsplit("/", 2)[:2]
    spark.range(3).write.parquet(folder)
    spark.range(3).write.mode("overwrite").parquet(f"{root}/of-another-application")
    spark.sql("CREATE DATABASE campuslake_left_over")
    for _ in range(2):
        workload.clean_up(spark)
        assert list_files(spark, folder) == [] and own not in list_folders(spark, root)
        assert list_folders(spark, root) == ["of-another-application"]
        assert not spark.catalog.databaseExists("campuslake_left_over")
