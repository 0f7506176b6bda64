"""Dated runs: all tables of a run lie under one folder, and readers only ever see whole runs.

A run writes ``root/run=<start>/<stage>/<table>`` and touches nothing else, so a run that fails
leaves its own folder behind and every reader where it was. Once all tables are there the registered
names are pointed at them, which moves no data. Which runs are whole is told by the markers that
Spark leaves beside each table; there is no log to keep in step.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.tables import read_table
from .storage import delete_folder, is_complete, list_folders

RUN = "run="
STAMP = "%Y%m%dT%H%M%SZ"
RETENTION = timedelta(hours=168)

#: The tables of a run by stage.
Layout = Mapping[str, Sequence[str]]


def run_folder(root: str, started: datetime) -> str:
    """Where the run that started then lies; runs of one lake start in different seconds."""
    return f"{root}/{RUN}{started.astimezone(timezone.utc).strftime(STAMP)}"


def _started(name: str) -> datetime | None:
    try:
        return datetime.strptime(name.removeprefix(RUN), STAMP).replace(tzinfo=timezone.utc)
    except ValueError:
        return None


def all_runs(spark: SparkSession, root: str) -> list[datetime]:
    """Every run that was begun, oldest first."""
    names = [n for n in list_folders(spark, root) if n.startswith(RUN)]
    return sorted(filter(None, map(_started, names)))


def complete_runs(spark: SparkSession, root: str, layout: Layout) -> list[datetime]:
    """Runs whose tables have all been written, oldest first."""

    def whole(started: datetime) -> bool:
        folder = run_folder(root, started)
        return all(is_complete(spark, f"{folder}/{stage}/{name}") for stage, names in layout.items() for name in names)

    return [started for started in all_runs(spark, root) if whole(started)]


def run_as_of(spark: SparkSession, root: str, layout: Layout, moment: datetime | None = None) -> datetime:
    """The newest complete run that had started by ``moment``; the newest of all by default."""
    known = [r for r in complete_runs(spark, root, layout) if moment is None or r <= moment]
    if not known:
        raise LookupError(f"no complete run in {root}" + (f" by {moment:%Y-%m-%d %H:%M:%S %Z}" if moment else ""))
    return known[-1]


def read_run(
    spark: SparkSession,
    root: str,
    layout: Layout,
    moment: datetime | None = None,
    fmt: str = "parquet",
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, dict[str, DataFrame]]:
    """All tables of one run by stage and name, so that what is read together was built together."""
    folder = run_folder(root, run_as_of(spark, root, layout, moment))
    schemas = schemas or {}
    return {
        stage: {name: read_table(spark, f"{folder}/{stage}/{name}", fmt, schemas.get(name)) for name in names}
        for stage, names in layout.items()
    }


def run_history(spark: SparkSession, root: str, layout: Layout) -> DataFrame:
    """(started_at, stage, table_name, num_rows) of every complete run.

    One scan over the files of all runs, of which only the footers are read. Tables without rows
    may have no file and count 0.
    """
    runs = complete_runs(spark, root, layout)
    rows = [(r, r.strftime(STAMP), stage, name) for r in runs for stage, names in layout.items() for name in names]
    tables = spark.createDataFrame(rows, "started_at timestamp, run string, stage string, table_name string")
    if not runs:
        return tables.select("started_at", "stage", "table_name", F.lit(0).cast("long").alias("num_rows"))
    files = spark.read.option("recursiveFileLookup", True).parquet(*[run_folder(root, r) for r in runs])
    path = F.regexp_extract_all("_metadata.file_path", F.lit(f"/{RUN}([^/]+)/([^/]+)/([^/]+)"), F.lit(0))
    place = F.split(F.element_at(path, -1), "/")
    counted = files.groupBy(
        F.substring(place[1], len(RUN) + 1, 32).alias("run"), place[2].alias("stage"), place[3].alias("table_name")
    ).agg(F.count(F.lit(1)).alias("n"))
    return tables.join(counted, ["run", "stage", "table_name"], "left").select(
        "started_at", "stage", "table_name", F.coalesce("n", F.lit(0)).alias("num_rows")
    )


def retain_runs(
    spark: SparkSession, root: str, layout: Layout, now: datetime | None = None, keep: timedelta = RETENTION
) -> list[datetime]:
    """Delete runs that started before ``now - keep``, failed ones too, and return them.

    The newest complete run always stays: registered names point at it.
    """
    oldest = (now or datetime.now(timezone.utc)) - keep
    newest = max(complete_runs(spark, root, layout), default=None)
    expired = [r for r in all_runs(spark, root) if r < oldest and r != newest]
    for started in expired:
        delete_folder(spark, run_folder(root, started))
    return expired


@contextmanager
def _partitions_from_folders(spark: SparkSession) -> Iterator[None]:
    """Tables created here find their partitions in their folder instead of in a list in the catalog."""
    name = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _place(spark: SparkSession, name: str, path: str, fmt: str, schema: StructType, partition_by: Sequence[str]) -> None:
    """Create an external table; its partitions follow its location."""
    columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ")" if fmt != "delta" else ""
    layout = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by and columns else ""
    with _partitions_from_folders(spark):
        spark.sql(f"CREATE TABLE {name} {columns} USING {fmt} {layout} LOCATION '{path}'")


def _fits(spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str]) -> bool:
    """Whether a registered table has these columns and finds its partitions in its folder."""
    order = [f for f in schema if f.name not in partition_by] + [schema[c] for c in partition_by]
    if [(f.name, f.dataType) for f in spark.table(name).schema] != [(f.name, f.dataType) for f in order]:
        return False
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Partition Provider'")
    return described.isEmpty()


def repoint(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, StructType],
    partitions: Mapping[str, Sequence[str]] | None = None,
    fmt: str = "parquet",
    prefix: str = "gold_",
) -> list[str]:
    """Point ``prefix`` + name at ``folder``/name for all tables at once; returns the names.

    Only locations change, one statement after another, after everything that could fail for want
    of data has been done. New names, and names whose columns changed, are created in place of
    that. Queries that have been planned keep reading the files they were planned on.
    """
    partitions = partitions or {}
    moved, created = [], []
    for name in schemas:
        table = prefix + name
        known = spark.catalog.tableExists(table)
        fits = known and (fmt == "delta" or _fits(spark, table, schemas[name], partitions.get(name, ())))
        (moved if fits else created).append((table, name, known))
    for table, name, _ in moved:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}/{name}'")
    for table, name, known in created:
        if known:
            spark.sql(f"DROP TABLE {table}")  # external: the files stay
        _place(spark, table, f"{folder}/{name}", fmt, schemas[name], partitions.get(name, ()))
    for name in schemas:
        spark.catalog.refreshTable(prefix + name)
    return [prefix + name for name in schemas]
