"""Versioned tables: every publication is a new ``_version=N`` folder next to the old ones.

A version is written once and never changed, so a reader keeps seeing the version it started
with, and a failed publication leaves the earlier ones intact and is never read itself. One
writer at a time.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .publish import publish
from .storage import delete_folder, is_complete, list_folders

VERSION = "_version"
PUBLISHED = "_published_at"
RETENTION = timedelta(hours=168)


def _numbers(names: list[str], column: str) -> list[int]:
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))



def _folder(path: str, number: int, moment: int) -> str:
    return f"{path}/{VERSION}={number}/{PUBLISHED}={moment}"


def _stamps(spark: SparkSession, path: str) -> dict[int, int]:
    """Publication second of every version folder, complete or not."""
    stamps = {}
    for number in _numbers(list_folders(spark, path), VERSION):
        moments = _numbers(list_folders(spark, f"{path}/{VERSION}={number}"), PUBLISHED)
        stamps[number] = moments[-1] if moments else 0
    return stamps


def versions(spark: SparkSession, path: str) -> dict[int, datetime]:
    """Completely published versions of a table and when each was published."""
    return {
        number: datetime.fromtimestamp(moment, timezone.utc)
        for number, moment in _stamps(spark, path).items()
        if is_complete(spark, _folder(path, number, moment))
    }


def publish_snapshot(df: DataFrame, path: str, published_at: datetime | None = None) -> int:
    """Write ``df`` as the next version of the table and return the version number."""
    spark = df.sparkSession
    taken = _numbers(list_folders(spark, path), VERSION)
    number = taken[-1] + 1 if taken else 0
    moment = int((published_at or datetime.now(timezone.utc)).timestamp())
    publish(df, _folder(path, number, moment), mode="errorifexists")
    return number


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the table with its own schema; the newest by default."""
    known = versions(spark, path)
    number = max(known, default=None) if version is None else version
    if number not in known:
        raise LookupError(f"no complete version {'' if version is None else version} in {path}")
    return spark.read.parquet(_folder(path, number, int(known[number].timestamp())))


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """Versions with their publication time and row count, which reads file footers only."""
    return (
        spark.read.parquet(path)
        .where(F.col(VERSION).isin(list(versions(spark, path))))
        .groupBy(F.col(VERSION).cast("int").alias("version"), F.col(PUBLISHED).cast("long").alias("moment"))
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .select("version", F.timestamp_seconds("moment").alias("published_at"), "num_rows")
    )


def retain_snapshots(
    spark: SparkSession, path: str, now: datetime | None = None, keep: timedelta = RETENTION
) -> list[int]:
    """Delete versions published before ``now - keep`` and return their numbers.

    The newest complete version always stays; older leftovers of failed publications go as
    well. Whole folders are deleted, so no data is rewritten.
    """
    oldest = ((now or datetime.now(timezone.utc)) - keep).timestamp()
    newest = max(versions(spark, path), default=None)
    expired = [n for n, moment in _stamps(spark, path).items() if moment < oldest and n != newest]
    for number in expired:
        delete_folder(spark, f"{path}/{VERSION}={number}")
    return expired
