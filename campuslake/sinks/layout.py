"""File layout of a table: compaction, clustering and a summary of its files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.tables import read_table
from .publish import publish
from .storage import overlapping

TARGET_FILE_BYTES = 256 * 1024 * 1024


def _files(df: DataFrame) -> DataFrame:
    """One row per file of ``df`` with its size and rows; no data column is read."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))


def table_detail(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row: format, number of files, bytes and rows."""
    return _files(spark.read.format(fmt).load(path)).agg(
        F.lit(fmt).alias("format"),
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_in_bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("num_rows"),
    )


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType | None = None,
    partition_by: Sequence[str] = (),
    target_bytes: int | None = None,
) -> int:
    """Copy a table to a new folder in fewer, larger files; returns the row count.

    Unpartitioned tables only merge input splits, without a shuffle; partitioned ones are
    rebalanced by partition value. Writing to a new folder leaves the old files readable and
    makes a failed run harmless; so a target inside the source, or around it, is refused. A
    partitioned table needs its ``schema``, since partition values are only text in folder names;
    the size of its files follows ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    if overlapping(spark, source, target):
        raise ValueError(f"cannot compact {source} into {target}: one lies in the other")
    if partition_by and schema is None:
        raise ValueError("a partitioned table is compacted with its schema")
    if partition_by and target_bytes is not None:
        raise ValueError("target_bytes is for tables without partitions")
    table = read_table(spark, source, schema=schema)
    if not partition_by:
        size = table_detail(spark, source).first()["size_in_bytes"]
        table = table.coalesce(max(1, -(-size // (target_bytes or TARGET_FILE_BYTES))))
    return publish(table, target, partition_by=partition_by)
