"""Benchmark decontamination: multi-pattern search for benchmark windows in documents.

Words are the maximal runs of letters A-Z (lower-cased), digits and non-ASCII characters. A
pattern is a window of ``size`` consecutive words of a benchmark text; a shorter text is one
pattern. The search works on words: for every block of the last two words under the search
position a table tells how far the position may move without missing a pattern. Where it may
not move, the bucket of that block holds the patterns that end with it, and these are compared
word by word.

Patterns lie in the shared folder in blocks of about ``block_windows``. A task holds some documents,
loads one block after another and searches them for each, so however large the benchmark is, a
task has one block in memory, the driver none, and nothing is shuffled or left out.

Defined results: a null or empty text has no words; benchmark rows without words are ignored,
a null item_id counts as the empty string, rows that share an item_id are one item; an empty
benchmark hits nothing; repeated documents each get their own row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..sinks.storage import scratch_folder
from .common import arrow_map, empty_arrow, file_system, steps

WINDOW = 10
BLOCK_WINDOWS = 200_000
#: Bytes of text that a task holds while it goes through the blocks.
HELD_BYTES = 64 << 20
#: Benchmark words of one pattern are joined by a byte that no word contains.
GLUE = " "


def _fold_table() -> bytes:
    """Byte table: lower-cases A-Z and turns every other ASCII byte outside 0-9 and a-z into a space."""
    keep = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
    return bytes(b + 32 if 65 <= b <= 90 else b if b in keep else 32 for b in range(256))


FOLD = _fold_table()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Search:
    """Shift and bucket tables for patterns that all have ``m`` words."""

    def __init__(self, m: int, patterns: list[tuple[list[bytes], list[str]]]):
        self.m, self.block = m, min(2, m)
        self.far = m - self.block + 1
        self.shifts: dict = {}
        self.buckets: dict = {}
        for words, items in patterns:
            for end in range(self.block, m + 1):
                key = self._key(words, end)
                self.shifts[key] = min(self.shifts.get(key, self.far), m - end)
            self.buckets.setdefault(self._key(words, m), []).append((words, items))

    def _key(self, words: list[bytes], end: int):
        return (words[end - 2], words[end - 1]) if self.block == 2 else words[end - 1]

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        m, far, shift_of, buckets = self.m, self.far, self.shifts.get, self.buckets
        last, n, pairs = m - 1, len(words), self.block == 2
        while last < n:
            key = (words[last - 1], words[last]) if pairs else words[last]
            shift = shift_of(key, far)
            if shift:
                last += shift
                continue
            start = last - m + 1
            here = words[start : last + 1]
            for pattern, items in buckets[key]:
                if pattern == here:
                    yield start, items
            last += 1


def _searches(rows: list[tuple[str, list[str]]]) -> list[Search]:
    by_length: dict[int, list] = {}
    for window, items in rows:
        words = window.encode().split()
        by_length.setdefault(len(words), []).append((words, items))
    return [Search(m, patterns) for m, patterns in sorted(by_length.items())]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """Distinct windows of the benchmark with the items they occur in: (window, items)."""

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for start, texts in steps(batch.column(1)):
            items = batch.column(0).slice(start, len(texts)).to_pylist()
            found: dict[str, list] = {"item": [], "window": []}
            for name, body in zip(items, texts.to_pylist()):
                words = words_of(body.encode())
                cuts = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
                distinct = {GLUE.join(w.decode() for w in c) for c in cuts}
                found["window"] += distinct
                found["item"] += [name] * len(distinct)
            yield found

    source = benchmark.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text}`").cast("string").alias("text")
    )
    cuts = arrow_map(source, cut, "item string, window string")
    return cuts.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField(
            "hits", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))
        ),
        StructField("items", ArrayType(StringType())),
    ]
)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    text: str = "text",
    keep: list[str] | None = None,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Documents as (row, found): found.n_words, found.hits (merged word spans) and found.items."""
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    folder = scratch_folder(spark, "llm-windows")
    benchmark_windows(benchmark, size).write.parquet(f"{folder}/all")
    windows = spark.read.schema("window string, items array<string>").parquet(f"{folder}/all")
    n_blocks = -(-windows.count() // block_windows)
    blocked = windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(max(1, n_blocks))).cast("int"))
    blocked.repartition("block").write.partitionBy("block").parquet(f"{folder}/blocks")
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").cast("string").alias("text")
    )
    schema = StructType([packed.schema["row"], StructField("found", FOUND)])
    types = empty_arrow(spark, schema)

    def searched(held: list[tuple[pa.Array, pa.Array]]) -> Iterator[pa.RecordBatch]:
        bodies = [texts.cast(pa.large_binary()) for _, texts in held]
        spans: list[list] = [[[] for _ in range(len(b))] for b in bodies]
        items: list[list] = [[set() for _ in range(len(b))] for b in bodies]
        counts = [[0] * len(b) for b in bodies]
        for number in range(max(1, n_blocks)):
            searches = _load(f"{folder}/blocks/block={number}") if n_blocks else []
            for part, own in enumerate(bodies):
                for i, body in enumerate(own):
                    words = words_of(body.as_py())
                    counts[part][i] = len(words)
                    for search in searches:
                        for at, names in search.occurrences(words):
                            spans[part][i].append((at, at + search.m))
                            items[part][i].update(names)
        for part, (rows, _) in enumerate(held):
            found = [
                {"n_words": n, "hits": [{"start": a, "end": b} for a, b in _merged(s)], "items": sorted(names)}
                for n, s, names in zip(counts[part], spans[part], items[part])
            ]
            yield pa.RecordBatch.from_arrays([rows, pa.array(found, type=types.field("found").type)], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held = [], 0
        for batch in batches:
            for start, texts in steps(batch.column(1)):
                held.append((batch.column(0).slice(start, len(texts)), texts))
                size_held += texts.nbytes
                if size_held > HELD_BYTES:
                    yield from searched(held)
                    held, size_held = [], 0
        if held:
            yield from searched(held)

    return packed.mapInArrow(run, schema)


@lru_cache(maxsize=1)
def _load(path: str) -> list[Search]:
    """The tables for one block; where there is only one, the process keeps it."""
    files, base = file_system(path)
    table = pq.read_table(base, filesystem=files, columns=["window", "items"], partitioning=None)
    return _searches(list(zip(table.column("window").to_pylist(), table.column("items").to_pylist())))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """The documents, with all their columns, in which no benchmark window occurs."""
    found = find_contamination(docs, benchmark, size, text)
    return found.where(F.size("found.hits") == 0).select("row.*")
