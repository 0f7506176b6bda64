"""Headered UTF-8 CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import TABLES, Table


#: Holds the whole line where a value does not fit its type or cells are missing or left over.
CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str, table: str | Table, infer: bool = False, keep_malformed: bool = False
) -> DataFrame:
    """Read a headered CSV file or folder with the declared types of ``table``.

    Declared types save the inference pass over the whole input and keep a single malformed
    value from changing a column's type (it becomes NULL). Columns are matched by header
    name: the header's order wins, undeclared columns are kept as text, and a file of the
    folder whose header differs is an error. ``infer=True`` infers the types instead.
    ``keep_malformed=True`` adds the text of malformed lines as ``_corrupt_record``.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    declared = TABLES[table] if isinstance(table, str) else table
    header = reader.csv(path).columns
    types = ", ".join(f"`{name}` {declared.columns.get(name, 'string')}" for name in header)
    if keep_malformed:
        types += f", `{CORRUPT}` string"
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(types).option("mode", "PERMISSIVE").option("enforceSchema", False).csv(path)
