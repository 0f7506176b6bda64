"""Write tables as full refreshes and count what was written in the same job."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

CONCURRENT_WRITES = 4


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by partition value before a partitioned write.

    Rebalancing gives each value few, evenly sized files: adaptive execution splits a value
    that holds much of the table over many tasks and merges small ones. Without adaptive
    execution such a value would end up in one task, so the rows then stay where they are.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    return df.hint("rebalance", *partition_by) if partition_by and adaptive else df


def publish(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> int:
    """Write ``df`` to ``path`` and return its row count.

    The count is observed by the tasks that write the files, so there is no second job, and
    a task that is run again after a lost executor is counted once. An overwrite also
    replaces the table's schema.
    """
    counted = Observation()
    rows = balanced(df, partition_by).observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.format(fmt).mode(mode)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return counted.get["rows"]


def publish_all(
    tables: dict[str, DataFrame],
    root: str,
    fmt: str = "parquet",
    partitions: dict[str, Sequence[str]] | None = None,
) -> dict[str, int]:
    """Publish independent tables under ``root`` a few at a time; row count per table.

    Several jobs in flight keep a cluster busy while the last tasks of one table finish.
    """
    partitions = partitions or {}

    def write(name: str) -> int:
        return publish(tables[name], f"{root}/{name}", fmt, partitions.get(name, ()))

    sessions = {df.sparkSession for df in tables.values()}
    job = inheritable_thread_target(sessions.pop())(write) if sessions else write
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        jobs = {name: pool.submit(job, name) for name in tables}
        return {name: job.result() for name, job in jobs.items()}
