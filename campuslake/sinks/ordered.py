"""Tables whose order survives storage: files in the order of their numbers, rows in order within them.

A stored table has no order of its own; Spark reads its files in any sequence. Here each row keeps
the number of its file and its place in it, from which its position in the whole follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .publish import publish

FILE, PLACE, POSITION = "_file", "_place", "position"
#: monotonically_increasing_id() counts the rows of a task in its lower bits.
TASK_BITS = 33


class OrderError(RuntimeError):
    """The ranges of the files of an ordered table do not ascend."""


def publish_sorted(df: DataFrame, path: str, order: Sequence[str | Column], pieces: int | None = None) -> int:
    """Write ``df`` sorted by ``order``, which should end in a key, and return its row count.

    Rows are cut into ranges, as many as there are shuffle partitions unless ``pieces`` says
    otherwise; a value that holds much of the table is cut by the columns after it.
    """
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(pieces, *columns).sortWithinPartitions(*columns)
    number = F.monotonically_increasing_id()
    return publish(
        ranged.select(
            "*",
            F.shiftright(number, TASK_BITS).cast("int").alias(FILE),
            number.bitwiseAND(F.lit((1 << TASK_BITS) - 1)).alias(PLACE),
        ),
        path,
    )


def read_sorted(spark: SparkSession, path: str) -> DataFrame:
    """The table with the ``position`` of each row, from 1; order by it to have the rows in order.

    Files are counted from their footers and one column; there are as many counts as files.
    """
    table = spark.read.parquet(path)
    counts = table.groupBy(FILE).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(FILE, before.alias("_before"))
    return table.join(starts, FILE).withColumn(POSITION, F.col("_before") + F.col(PLACE) + 1).drop(FILE, PLACE, "_before")


def check_sorted(spark: SparkSession, path: str, order: Sequence[str], descending: Sequence[str] = ()) -> int:
    """Check that the ranges of the files ascend one after another; returns the number of files.

    ``order`` names stored columns; those in ``descending`` are sorted downwards. What is compared
    are the first and the last row of each file, and its rows with its places, so a file that lost
    or gained rows shows as well as one out of order.
    """
    table = spark.read.parquet(path)
    keys = [F.col(c) for c in order]
    ends = table.groupBy(FILE).agg(
        F.min_by(F.struct(*keys), PLACE).alias("first"),
        F.max_by(F.struct(*keys), PLACE).alias("last"),
        F.count(F.lit(1)).alias("rows"),
        (F.max(PLACE) + 1).alias("places"),
    )
    def rises(before: str, after: str) -> Column:
        """Whether one row may stand before another; NULLs come first upwards and last downwards."""
        result = F.lit(True)
        for name in reversed(order):
            low, high = F.col(f"{before}.{name}"), F.col(f"{after}.{name}")
            if name in descending:
                low, high = high, low
            smaller = F.coalesce(low < high, low.isNull() & high.isNotNull())
            result = smaller | (low.eqNullSafe(high) & result)
        return result

    paired = ends.withColumn("before", F.lag("last").over(Window.orderBy(FILE)))
    follows = F.col("before").isNull() | rises("before", "first")
    wrong = ~(follows & rises("first", "last") & (F.col("rows") == F.col("places")))
    found = paired.agg(F.count(F.lit(1)).alias("files"), F.count_if(wrong).alias("wrong")).first()
    if found["wrong"]:
        raise OrderError(f"{found['wrong']} of {found['files']} files of {path} are not where they belong")
    return found["files"]
