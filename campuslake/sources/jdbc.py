"""Database tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: Equal parts that a key range is counted in before it is cut.
HISTOGRAM_CELLS = 1000


@dataclass(frozen=True)
class Split:
    """How to cut a table into parallel range queries on a numeric or date column.

    The bounds only place the cuts; rows outside them are read by the first and last query.
    """

    column: str
    lower: int | str
    upper: int | str
    partitions: int


@dataclass(frozen=True)
class Database:
    """Connection settings; credentials are arguments, never constants."""

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def jdbc_options(database: Database, table: str, split: Split | None = None) -> dict[str, str]:
    """Reader options for ``table``, with range splits when given."""
    options = {"url": database.url, "dbtable": table, "fetchsize": "10000", **database.options}
    for name, value in (("driver", database.driver), ("user", database.user), ("password", database.password)):
        if value is not None:
            options[name] = value
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, database: Database, table: str, split: Split | None = None
) -> DataFrame:
    """Read a whole table; without ``split`` one task reads all of it, so give one for large tables."""
    return spark.read.format("jdbc").options(**jdbc_options(database, table, split)).load()


def histogram_query(table: str, column: str, lower: int, upper: int, cells: int = HISTOGRAM_CELLS) -> str:
    """SQL that counts the rows of equal parts of a key range: the one aggregate that cuts are made from.

    It runs in the database and returns ``cells`` rows at most, and one for keys that are NULL.
    """
    width = max(1, -(-(upper - lower + 1) // cells))
    cell = f"FLOOR(({column} - {lower}) / {width})"
    return f"(SELECT {cell} AS cell, COUNT(*) AS n FROM {table} GROUP BY {cell}) histogram"


def equal_depth_bounds(
    counts: dict[int, int], lower: int, upper: int, partitions: int, cells: int = HISTOGRAM_CELLS
) -> list[int]:
    """Keys that cut a range into ``partitions`` of about equally many rows, from counts per cell.

    Where equal steps of a skewed key would give one query most of the rows, these give each its
    share, to within the rows of one cell. Fewer cuts are returned where cells hold several shares.
    """
    width = max(1, -(-(upper - lower + 1) // cells))
    total, passed, taken, bounds = sum(counts.values()), 0, 0, []
    for cell in sorted(counts):
        shares = passed * partitions // total
        if shares > taken:
            bounds.append(lower + cell * width)
            taken = shares
        passed += counts[cell]
    return bounds


def range_predicates(column: str, bounds: list[int]) -> list[str]:
    """One condition per query; together they meet every row once, rows without a key in the first."""
    if not bounds:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *middle, f"{column} >= {bounds[-1]}"]


def read_jdbc_balanced(
    spark: SparkSession, database: Database, table: str, column: str, partitions: int
) -> DataFrame:
    """Read a whole table by ``partitions`` queries of about equal size on a whole-number key.

    Two small queries come first: the ends of the key range, and counts of its parts. No bounds
    have to be known, and gaps and crowds in the key do not matter.
    """

    def ask(sql: str) -> DataFrame:
        return spark.read.format("jdbc").options(**jdbc_options(database, sql)).load()

    ends = ask(f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) ends").first()
    bounds: list[int] = []
    if ends[0] is not None and partitions > 1:
        lower, upper = int(ends[0]), int(ends[1])
        rows = ask(histogram_query(table, column, lower, upper)).collect()
        bounds = equal_depth_bounds({int(c): int(n) for c, n in rows if c is not None}, lower, upper, partitions)
    options = jdbc_options(database, table)
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(database.url, table, predicates=range_predicates(column, bounds), properties=properties)
