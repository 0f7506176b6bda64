"""Shared plumbing: per-row annotation in Arrow batches, and tables that cut lineage."""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sinks.storage import scratch_folder

#: Bytes of text that one vectorised step works on. A single longer text is one step.
STEP_BYTES = 1 << 20

_SHIPPED: set[str] = set()

Task = Callable[[pa.Array], dict]


@cache
def _archive() -> str:
    package = Path(__file__).resolve().parent.parent
    return shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="campuslake-")) / package.name), "zip", package.parent, package.name
    )


def ship(spark: SparkSession) -> None:
    """Hand the package to executors that could not import it; Spark serves the archive to them."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        context.addPyFile(_archive())


#: Has Spark remove the shuffle files of a plan that has ended, not only once the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str, release: bool = False, **options) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Later passes then read files instead of running the plan again, and an executor that is
    lost costs no more than the step at hand. With ``release`` the shuffle files go once ``df`` is written.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, f"llm-{label}")
    before = spark.conf.get(RELEASE, "false")
    try:
        spark.conf.set(RELEASE, "true" if release else before)
        df.write.parquet(path, **options)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a shared folder's address names, for tasks, and the path in it."""
    return pafs.FileSystem.from_uri(path if re.match(r"[a-zA-Z][\w+.-]*:/", path) else f"file://{path}")


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string or binary column that hold about ``limit`` bytes each, nulls as empty."""
    wide = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    filled = pc.fill_null(column.cast(wide), b"" if wide == pa.large_binary() else "")
    if not len(filled):
        return
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    start = 0
    while start < len(filled):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, filled.slice(start, stop - start)
        start = stop


def annotate(
    df: DataFrame,
    make: Callable[[], Task],
    result: StructType,
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` as (row, found): the kept columns as one struct, and what ``make()`` finds in the text.

    ``make`` is called once per Spark task and returns a function from a slice of texts (nulls
    as empty) to one list or array per field of ``result``. Packing the row keeps columns of
    any name or type apart from the results.
    """
    keep = list(df.columns if keep is None else keep)
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").cast("string").alias("text")
    )
    types = empty_arrow(df.sparkSession, result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = make()
        for batch in batches:
            for start, texts in steps(batch.column(1)):
                found = task(texts)
                fields = [pa.array(found[f.name], type=f.type) for f in types]
                rows = batch.column(0).slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.StructArray.from_arrays(fields, fields=list(types))], names=["row", "found"]
                )

    return packed.mapInArrow(run, StructType([packed.schema["row"], StructField("found", result)]))


def empty_arrow(spark, schema: StructType) -> pa.Schema:
    """The Arrow schema that Spark uses for ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def arrow_map(df: DataFrame, task: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a task from one batch to some dicts of columns."""
    struct = StructType.fromDDL(schema)
    types = empty_arrow(df.sparkSession, struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in task(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in types], schema=types
                )

    return df.mapInArrow(run, struct)
