"""Folder operations on whatever file system a path belongs to, and a scratch area."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none when it does not exist."""
    fs, folder = _resolve(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of all files below ``path``, at any depth, from there; none when it does not exist."""
    fs, folder = _resolve(spark, path)
    if not fs.exists(folder):
        return []
    root = fs.makeQualified(folder).toUri().getPath().rstrip("/")
    found, names = fs.listFiles(folder, True), []
    while found.hasNext():
        names.append(found.next().getPath().toUri().getPath()[len(root) + 1 :])
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith("."))


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, into a folder that is made where it is missing."""
    fs, old = _resolve(spark, source)
    _, new = _resolve(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote the folder committed (Spark leaves a marker file then)."""
    fs, marker = _resolve(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and everything in it."""
    fs, folder = _resolve(spark, path)
    fs.delete(folder, True)


def overlapping(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two folders are the same or one lies in the other."""
    resolved = [str(fs.makeQualified(folder).toString()).rstrip("/") + "/" for fs, folder in (_resolve(spark, one), _resolve(spark, other))]
    return resolved[0].startswith(resolved[1]) or resolved[1].startswith(resolved[0])


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="campuslake-")


def _scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = _local_scratch()
    return f"{shared.rstrip('/')}/campuslake/{spark.conf.get('spark.app.id', 'application')}"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name for working tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``; only where
    that is unset and everything runs on this machine, as in tests, is it a local folder.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's working tables.

    Results that were built on them and have not been read or written yet cannot be any more, so
    whoever runs many jobs in one application calls this between them.
    """
    delete_folder(spark, _scratch_root(spark))
