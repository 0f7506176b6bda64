"""Named SQL tables over published folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Register a folder as table ``name``, or bring the table up to date with the folder.

    Call it after each publication: new partitions come in, gone ones go, and a changed schema or
    place replaces the entry (the files are external and stay).
    """
    if schema is not None and fmt != "delta" and spark.catalog.tableExists(name):
        order = [f for f in schema if f.name not in partition_by] + [schema[c] for c in partition_by]
        if [(f.name, f.dataType) for f in spark.table(name).schema] != [(f.name, f.dataType) for f in order]:
            spark.sql(f"DROP TABLE {name}")
    columns = layout = ""
    if schema is not None and fmt != "delta":
        columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ")"
        if partition_by:
            layout = "PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING {fmt} {layout} LOCATION '{path}'")
    if partition_by and fmt != "delta":
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def register_tables(
    spark: SparkSession,
    root: str,
    schemas: dict[str, StructType],
    partitions: dict[str, Sequence[str]] | None = None,
    fmt: str = "parquet",
    prefix: str = "gold_",
) -> list[str]:
    """Register every table of ``schemas`` found under ``root`` as ``prefix`` + name."""
    partitions = partitions or {}
    for name, schema in schemas.items():
        register_table(spark, prefix + name, f"{root}/{name}", fmt, schema, partitions.get(name, ()))
    return [prefix + name for name in schemas]


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """``SHOW TABLES`` of a database, as (table_name)."""
    return spark.sql(f"SHOW TABLES IN {database}").where(~F.col("isTemporary")).select(
        F.col("tableName").alias("table_name")
    )
