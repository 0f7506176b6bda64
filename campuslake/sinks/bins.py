"""Compaction of the small files of a table, in place; large files stay as they are."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.tables import read_table
from .layout import TARGET_FILE_BYTES
from .storage import delete_folder, is_complete, list_files, list_folders, move_file

STAGING = "_compact-"
BIN = "_bin"


def file_bins(table: DataFrame, small_bytes: int, target_bytes: int) -> DataFrame:
    """(folder, file, bytes, bin) of the files below ``small_bytes`` that have others to go with.

    The files of a folder are laid end to end, smallest first, and cut every ``target_bytes``; a
    bin holds less than ``target_bytes`` and one more file. Nothing but file listings is read.
    """
    files = table.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).where(F.col("bytes") < small_bytes).distinct()
    folder = F.regexp_replace("file", "/[^/]*$", "").alias("folder")
    along = Window.partitionBy("folder").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(along), F.lit(0))
    placed = files.select(folder, "file", "bytes").withColumn("bin", F.floor(start / target_bytes))
    others = Window.partitionBy("folder", "bin")
    return placed.withColumn("n", F.count(F.lit(1)).over(others)).where("n > 1").drop("n")


def recover_compaction(spark: SparkSession, path: str) -> int:
    """Undo what a compaction that was broken off left half done; returns the files put back.

    A bin's old files go aside before its new one comes in, so where the new one is still in the
    staging folder the old ones are put back, and elsewhere the bin is finished.
    """
    back = 0
    for staging in (f"{path}/{n}" for n in list_folders(spark, path) if n.startswith(STAGING)):
        waiting = {f.split("/", 1)[0] for f in list_files(spark, f"{staging}/new") if f.startswith(f"{BIN}=")}
        for old in list_files(spark, f"{staging}/old"):
            number, rest = old.split("/", 1)
            if number in waiting:
                move_file(spark, f"{staging}/old/{old}", f"{path}/{rest}")
                back += 1
        delete_folder(spark, staging)
    return back


def compact_bins(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    small_bytes: int | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> list[str]:
    """Merge the small files of each partition into files of about ``target_bytes``; names of the old ones.

    Files of ``small_bytes`` (half the target by default) and more are neither read nor moved. Only
    rows of small files are shuffled, each bin to one task that writes one file. New files are
    written aside and come in by renames, bin by bin, so rows are never seen twice; a query that
    listed the old files before may fail and has to be run again. What is broken off is put right
    by the next call. The driver holds a row per small file, as it does to plan any scan of them.
    """
    recover_compaction(spark, path)
    small_bytes = small_bytes or target_bytes // 2
    table = read_table(spark, path, schema=schema)
    bins = file_bins(table, small_bytes, target_bytes).orderBy("folder", "bin", "file").collect()
    if not bins:
        return []
    numbers = {}
    for row in bins:
        numbers.setdefault((row["folder"], row["bin"]), len(numbers))
    placed = spark.createDataFrame([(r["file"], numbers[r["folder"], r["bin"]]) for r in bins], f"_file string, {BIN} int")
    small = table.where(F.col("_metadata.file_size") < small_bytes).select("*", F.col("_metadata.file_path").alias("_file"))
    rows = small.join(placed, "_file").drop("_file").repartitionById(len(numbers), F.col(BIN))
    staging = f"{path}/{STAGING}{uuid.uuid4().hex}"
    rows.write.partitionBy(BIN, *partition_by).parquet(f"{staging}/new")
    if not is_complete(spark, f"{staging}/new"):
        raise RuntimeError(f"{staging} was not written to its end")

    root = _plain(bins[0]["folder"], path)
    old: dict[int, list[str]] = {}
    for row in bins:
        name = unquote(urlparse(row["file"]).path)[len(root) :].lstrip("/")
        old.setdefault(numbers[row["folder"], row["bin"]], []).append(name)
    new: dict[int, list[str]] = {}
    for name in list_files(spark, f"{staging}/new"):
        if name.startswith(f"{BIN}="):
            number, rest = name.split("/", 1)
            new.setdefault(int(number.partition("=")[2]), []).append(rest)
    for number, names in old.items():
        for name in names:
            move_file(spark, f"{path}/{name}", f"{staging}/old/{BIN}={number}/{name}")
        for name in new[number]:
            move_file(spark, f"{staging}/new/{BIN}={number}/{name}", f"{path}/{name}")
    delete_folder(spark, staging)
    return sorted(name for names in old.values() for name in names)


def _plain(folder: str, path: str) -> str:
    """The table's root as it begins the plain paths of its files."""
    whole = unquote(urlparse(folder).path)
    root = (urlparse(path).path if "://" in path or path.startswith("file:") else path).rstrip("/")
    if not f"{whole}/".startswith(f"{root}/"):
        raise ValueError(f"{folder} does not lie in {path}")
    return root
