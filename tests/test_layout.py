"""Clustering on several columns, and compaction of small files only."""

from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from campuslake.sinks import cluster_by, cluster_zorder, compact_bins, publish
from campuslake.sinks import bins as bins_module
from campuslake.sinks.clustering import morton, range_boundaries, range_rank
from campuslake.sinks.storage import list_files
from campuslake.sources import read_table


@pytest.fixture(scope="module")
def grid(spark):
    """Two independent columns, one of them text with NULLs, and a key."""
    return spark.range(20_000, numPartitions=5).selectExpr(
        "id",
        "pmod(xxhash64(id), 1000) as a",
        "case when id % 50 = 0 then null else lpad(cast(pmod(xxhash64(id, 1), 1000) as string), 4, '0') end as b",
    )


def _kept(folder: str, column: str, value) -> int:
    """Files that a filter for ``value`` has to read, by their statistics."""
    kept = 0
    for path in glob.glob(f"{folder}/part-*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        kept += any(s.min <= value <= s.max for s in stats)
    return kept


def test_filters_on_either_column_skip_files(spark, grid, tmp_path):
    lexical, curve = str(tmp_path / "lexical"), str(tmp_path / "curve")
    publish(cluster_by(grid, ["a", "b"], ["id"], pieces=16), lexical)
    publish(cluster_zorder(grid, ["a", "b"], ["id"], pieces=16), curve)
    assert read_table(spark, curve).exceptAll(grid).isEmpty() and read_table(spark, curve).count() == 20_000
    read = {f: [(_kept(f, "a", v), _kept(f, "b", f"{v:04d}")) for v in range(5, 1000, 90)] for f in (lexical, curve)}
    second = min(b for _, b in read[lexical])
    assert second == 16  # the second column of a plain sort skips nothing
    assert max(max(pair) for pair in read[curve]) <= 10
    assert sum(map(sum, read[curve])) / 2 / len(read[curve]) < 7


def test_ranks_and_curve(spark, grid):
    cuts = range_boundaries(grid, ["a", "b"], ["id"], 8)
    assert all(len(c) == 7 and c == sorted(c) for c in cuts.values())
    assert cuts == range_boundaries(grid.repartition(9), ["a", "b"], ["id"], 8)
    shares = grid.groupBy(range_rank("a", cuts["a"]).alias("r")).count().collect()
    assert sorted(r["r"] for r in shares) == list(range(8)) and all(1_800 < r["count"] < 3_200 for r in shares)
    rows = grid.select("a", "b", range_rank("a", cuts["a"]).alias("x"), range_rank("b", cuts["b"]).alias("y"))
    for r in rows.limit(300).collect():
        assert r["x"] == sum(c <= r["a"] for c in cuts["a"])
        assert r["y"] == (0 if r["b"] is None else sum(c <= r["b"] for c in cuts["b"]))
    for r in rows.select("x", "y", morton([F.col("x"), F.col("y")], 3).alias("z")).distinct().collect():
        assert r["z"] == sum(((r["x"] >> b & 1) << (2 * b + 1)) | ((r["y"] >> b & 1) << (2 * b)) for b in range(3))


def test_hot_empty_and_crowded_columns(spark, grid, tmp_path):
    hot = grid.select("id", F.lit(7).alias("a"), F.lit(None).cast("string").alias("b"))
    folder = str(tmp_path / "hot")
    publish(cluster_zorder(hot, ["a", "b"], ["id"], pieces=8), folder)
    rows = [pq.ParquetFile(p).metadata.num_rows for p in glob.glob(f"{folder}/part-*.parquet")]
    assert sum(rows) == 20_000 and max(rows) < 5_000
    assert cluster_zorder(grid.where("false"), ["a", "b"]).count() == 0
    with pytest.raises(ValueError, match="do not fit"):
        cluster_zorder(grid, ["a", "b"], bits=32)


def _lay(spark, folder: str) -> None:
    """Per program one large file and several small ones; program ``c d`` has a single small file."""
    big = spark.range(30_000).selectExpr("id", "sha2(cast(id as string), 256) as text", "'a' as program_id")
    big.coalesce(1).write.partitionBy("program_id").parquet(folder)
    small = "id", "cast(id as string) as text"
    spark.range(60).selectExpr(*small, "case when id % 2 = 0 then 'a' else 'b:x' end as program_id").repartition(
        6, "id"
    ).write.mode("append").partitionBy("program_id").parquet(folder)
    spark.range(5).selectExpr(*small, "'c d' as program_id").coalesce(1).write.mode("append").partitionBy("program_id").parquet(folder)


SCHEMA = "id long, text string, program_id string"


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _sizes(folder: str) -> dict:
    return {os.path.relpath(f, folder): os.path.getsize(f) for f in glob.glob(f"{folder}/program_id=*/part-*")}


def test_small_files_are_merged_and_others_left(spark, tmp_path):
    folder = str(tmp_path / "t")
    _lay(spark, folder)
    before, rows = _sizes(folder), sorted(map(tuple, read_table(spark, folder, schema=_schema(spark)).collect()))
    large = {f for f, size in before.items() if size > 100_000}
    single = {f for f in before if f.startswith("program_id=c d")}
    gone = compact_bins(spark, folder, _schema(spark), ["program_id"], small_bytes=100_000, target_bytes=1_000_000)
    after = _sizes(folder)
    assert len(large) == 1 and len(single) == 1
    assert set(gone) == set(before) - large - single
    assert {f: after[f] for f in large | single} == {f: before[f] for f in large | single}
    assert len(set(after) - set(before)) == 2  # one for each program that had several
    assert sorted(map(tuple, read_table(spark, folder, schema=_schema(spark)).collect())) == rows
    assert not [f for f in os.listdir(folder) if f.startswith("_compact")]
    # Nothing is left to do.
    assert compact_bins(spark, folder, _schema(spark), ["program_id"], small_bytes=100, target_bytes=1_000_000) == []


def test_bins_are_bounded(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(4_000).selectExpr("id", "sha2(cast(id as string), 256) as text", "'p' as program_id").repartition(40, "id").write.parquet(folder)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{folder}/part-*")]
    target = 5 * max(sizes)
    schema = read_table(spark, folder).schema
    bins = bins_module.file_bins(read_table(spark, folder, schema=schema), max(sizes) + 1, target)
    packed = bins.groupBy("bin").agg(F.sum("bytes").alias("bytes"), F.count("file").alias("n")).collect()
    assert sum(r["n"] for r in packed) in (len(sizes), len(sizes) - 1)
    assert all(r["bytes"] < target + max(sizes) for r in packed) and len(packed) >= sum(sizes) // target - 1
    compact_bins(spark, folder, schema, small_bytes=max(sizes) + 1, target_bytes=target)
    assert read_table(spark, folder).count() == 4_000
    assert len(glob.glob(f"{folder}/part-*")) <= len(packed) + 1


@pytest.mark.parametrize("moves", [0, 1, 3, 7, 9, 13])
def test_a_broken_compaction_is_put_right(spark, tmp_path, monkeypatch, moves):
    folder = str(tmp_path / "t")
    _lay(spark, folder)
    rows = sorted(map(tuple, read_table(spark, folder, schema=_schema(spark)).collect()))
    done, move = [], bins_module.move_file

    def failing(*args):
        if len(done) == moves:
            raise OSError("lost")
        done.append(args)
        move(*args)

    monkeypatch.setattr(bins_module, "move_file", failing)
    with pytest.raises(OSError, match="lost"):
        compact_bins(spark, folder, _schema(spark), ["program_id"], small_bytes=100_000)
    monkeypatch.undo()
    seen = list(map(tuple, read_table(spark, folder, schema=_schema(spark)).collect()))
    assert len(seen) == len(set(seen)) and set(seen) <= set(rows)
    bins_module.recover_compaction(spark, folder)
    assert sorted(map(tuple, read_table(spark, folder, schema=_schema(spark)).collect())) == rows
    compact_bins(spark, folder, _schema(spark), ["program_id"], small_bytes=100_000)
    assert sorted(map(tuple, read_table(spark, folder, schema=_schema(spark)).collect())) == rows
    assert len(_sizes(folder)) == 4 and list_files(spark, f"{folder}/missing") == []


def test_only_small_files_are_read(spark, tmp_path, plan):
    folder = str(tmp_path / "t")
    _lay(spark, folder)
    small = read_table(spark, folder, schema=_schema(spark)).where(F.col("_metadata.file_size") < 100_000)
    small.collect()
    metrics = small._jdf.queryExecution().executedPlan()
    while not metrics.metrics().contains("numFiles"):
        metrics = metrics.children().head()
    assert metrics.metrics().apply("numFiles").value() == len([s for s in _sizes(folder).values() if s < 100_000])
