"""Tables stored as folders of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Read a table folder.

    Give the table's ``schema`` when it is known: no footer is read to infer it, columns come
    back in its order, and partition values keep their type (Spark would otherwise read a
    program called ``1`` from a folder name as an integer).
    """
    if schema is None:
        return spark.read.format(fmt).load(path)
    if fmt == "delta":  # the table's own log holds the schema
        return spark.read.format(fmt).load(path).select(*schema.names)
    return spark.read.format(fmt).schema(schema).load(path).select(*schema.names)


def read_path_sql(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``SELECT * FROM fmt.`path```: address a table by its folder in SQL."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")
