"""Token-id files and a minimal perfect hash index over them.

Writing: documents are range-partitioned by key, so that shards in order hold ascending keys.
Each task encodes its documents and streams their ids to one shard file: nothing but the ids of
one document after another, as little-endian unsigned integers of two bytes where the
vocabulary allows and four otherwise. A shard is written under a name of its own for every
attempt and only files named in the manifest count, so a repeated or speculative task leaves an
unread file behind and never half a shard.

Index: keys are dealt into buckets of bounded size by hash. Within a bucket a minimal perfect
hash (hash and displace: small groups of keys, largest first, each with the first seed that
sends its keys to free slots) gives every key a slot of its own; at the slot stand a 32-bit
fingerprint of the key and the shard, offset and length. A lookup reads one bucket row, hashes
twice and compares the fingerprint: constant time per key.

Defined results: a null or empty text is just the end id; repeated keys are numbered, and the
index holds each (key, number); a null key comes first.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.storage import scratch_folder
from . import wordsplit
from .common import arrow_map, file_system, materialize, steps
from .textarrays import mix

END_ID = 2
#: Keys of one index bucket on average, and of one displaced group.
BUCKET_KEYS = 20_000
GROUP_KEYS = 4
NULL_KEY = np.uint64(0xA0761D6478BD642F)
#: Pieces of text whose ids a task remembers before it forgets those it has not met for as many.
REMEMBERED = 250_000
#: Marks for pieces that were met once, by their hashes.
MARKS = 1 << 22


class Ids(dict):
    """Packed ids of what white space separates; the tokenizer encodes such pieces independently.

    A new piece falls into its words, which are looked up in turn: much of what is new is a known
    word with other punctuation behind it. Most pieces never come back, so a piece or word is
    remembered when it is met for the second time. Of these, those met often stay and as many as
    ``REMEMBERED`` others are kept twice over at most.
    """

    def __init__(self, path: str, dtype: str):
        self.encode, self.letter = wordsplit.encoder(path), np.dtype(dtype).char
        self.older: dict[bytes, bytes] = {}
        self.met = bytearray(MARKS)

    def __missing__(self, piece: bytes) -> bytes:
        found = self.older.get(piece)
        if found is None:
            words = wordsplit.words(piece)
            if len(words) > 1:
                found = b"".join([self[word] for word in words])
            else:
                ids = self.encode(piece)
                found = pack(f"<{len(ids)}{self.letter}", *ids)
            mark = hash(piece) % MARKS
            if not self.met[mark]:
                self.met[mark] = 1
                return found
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
            self.met = bytearray(MARKS)
        self[piece] = found
        return found


class WordEncoder:
    """Encodes texts piece by piece."""

    def __init__(self, path: str, dtype: str):
        self.known = Ids(path, dtype)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        find = self.known.__getitem__
        return [b"".join(map(find, wordsplit.pieces(t))) for t in texts]


@cache
def _encoder(path: str, dtype: str) -> WordEncoder:
    return WordEncoder(path, dtype)


def id_type(vocabulary: str) -> str:
    return "<u2" if wordsplit.load(vocabulary).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def write_ids(docs: DataFrame, vocabulary: str, folder: str, text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write shard files to ``folder``; (key, number, shard, file, offset, n_tokens, start) per document.

    ``docs`` has the key in ``doc_id``. ``offset`` counts ids within the shard, ``start`` over all.
    """
    dtype = id_type(vocabulary)
    source = docs.select(F.col("doc_id").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    # Rows of one key may be split over shards by their text.
    ranged = source.repartitionByRange(F.col("key").asc_nulls_first(), F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text"), "text")
    ddl = "key long, shard int, file string, offset long, n_tokens long, place long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary, dtype)
        end = np.array([end_id], dtype).tobytes()
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.ids"
        files, base = file_system(folder)
        sink, written = None, 0
        held: list[pa.RecordBatch] = []
        places = Places()
        for batch in batches:
            for start, texts in steps(batch.column(1)):
                if sink is None:
                    files.create_dir(base, recursive=True)
                    sink = files.open_output_stream(f"{base}/{name}")
                bodies = [ids + end for ids in encode(texts.cast(pa.large_binary()).to_pylist())]
                sink.write(b"".join(bodies))
                counts = np.fromiter(map(len, bodies), np.int64, len(bodies)) // len(end)
                offsets = written + np.cumsum(counts) - counts
                written += int(counts.sum())
                n = len(bodies)
                held.append(
                    pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(start, n), pa.array([shard] * n, pa.int32()), pa.array([name] * n),
                            pa.array(offsets), pa.array(counts), pa.array(places(batch.column(0).slice(start, n))),
                        ],
                        names=["key", "shard", "file", "offset", "n_tokens", "place"],
                    )
                )
        if sink is not None:
            sink.close()
        # Rows leave only when their file is complete.
        yield from held

    manifest = materialize(ordered.mapInArrow(run, ddl), "manifest")
    # One row per shard, as many as there are tasks.
    shards = manifest.groupBy("shard").agg(
        F.sum("n_tokens").alias("size"),
        F.min_by("key", "offset").alias("first"),
        F.max_by("key", "offset").alias("last"),
        (F.max_by("place", "offset") + 1).alias("last_rows"),
    )
    bases = docs.sparkSession.createDataFrame(
        shard_bases(sorted(shards.collect(), key=lambda r: r["shard"])), "shard int, base long, first long, carried long"
    )
    number = F.col("place") + F.when(F.col("key").eqNullSafe(F.col("first")), F.col("carried")).otherwise(0)
    return manifest.join(F.broadcast(bases), "shard").select(
        "key", number.cast("int").alias("number"), "shard", "file", "offset", "n_tokens", (F.col("base") + F.col("offset")).alias("start")
    )


class Places:
    """How many rows of its key stand before each row of sorted keys, over several batches."""

    def __init__(self):
        self.key, self.count = object(), 0

    def __call__(self, keys: pa.Array) -> np.ndarray:
        n = len(keys)
        if not n:
            return np.zeros(0, np.int64)
        null = keys.is_null().to_numpy(zero_copy_only=False)
        plain = pc.fill_null(keys, 0).to_numpy()
        fresh = np.ones(n, bool)
        fresh[1:] = (plain[1:] != plain[:-1]) | (null[1:] != null[:-1])
        out = np.arange(n) - np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        if keys[0].as_py() == self.key:
            stop = int(np.argmax(fresh[1:])) + 1 if fresh[1:].any() else n
            out[:stop] += self.count
        self.key, self.count = keys[-1].as_py(), int(out[-1]) + 1
        return out


def shard_bases(shards: list) -> list[tuple]:
    """(shard, ids before it, its first key, rows of that key before it), in order of shards."""
    out, base, last, rows = [], 0, object(), 0
    for shard in shards:
        carried = rows if shard["first"] == last else 0
        out.append((shard["shard"], base, shard["first"], carried))
        base += shard["size"]
        rows = shard["last_rows"] + (carried if shard["first"] == shard["last"] else 0)
        last = shard["last"]
    return out


def key_hash(keys: pa.ChunkedArray, numbers: np.ndarray) -> np.ndarray:
    """Hashes of (key, number); a null key differs from every other in a bit of its own."""
    plain = pc.fill_null(keys, 0).to_numpy().astype(np.int64).view(np.uint64)
    null = pc.is_null(keys).to_numpy(zero_copy_only=False)
    return mix(mix(mix(plain) + null.astype(np.uint64) * NULL_KEY) + numbers.astype(np.uint64))


def build_hash(hashes: np.ndarray) -> np.ndarray:
    """Seeds of a minimal perfect hash for distinct 64-bit hashes, one per group of keys."""
    n = len(hashes)
    n_groups = max(1, -(-n // GROUP_KEYS))
    group = (hashes % np.uint64(n_groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    ends = np.searchsorted(group[order], np.arange(n_groups + 1))
    seeds = np.zeros(n_groups, np.uint32)
    taken = np.zeros(n, bool)
    tries = np.arange(256, dtype=np.uint64)
    for g in np.argsort(-np.diff(ends), kind="stable"):
        own = hashes[order[ends[g] : ends[g + 1]]]
        if not len(own):
            break
        seed = 0
        while True:
            slots = _slots(own[None, :], (tries + np.uint64(seed))[:, None], n)
            good = ~taken[slots].any(axis=1)
            if len(own) > 1:
                ordered = np.sort(slots, axis=1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            hit = int(np.argmax(good))
            if good[hit]:
                seeds[g] = seed + hit
                taken[slots[hit]] = True
                break
            seed += len(tries)
    return seeds


def _slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    return (mix(hashes + (seeds + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


def find_slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """The slot of each hash: two hash computations and one read of a seed."""
    return _slots(hashes, seeds[(hashes % np.uint64(len(seeds))).astype(np.int64)].astype(np.uint64), n)


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


def bucket(n_buckets: int):
    """The bucket of a key, the same for index rows and lookups."""
    return F.pmod(F.xxhash64("key", "number"), F.lit(n_buckets)).cast("int")


INDEX = "bucket int, n long, seeds binary, prints binary, files array<string>, file binary, offsets binary, lengths binary, starts binary"


def build_index(manifest: DataFrame, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """One row per bucket with its perfect hash and what stands at each slot; and the number of buckets."""
    n_buckets = max(1, -(-manifest.count() // bucket_keys))

    def build(table: pa.Table) -> pa.Table:
        hashes = key_hash(table.column("key"), table.column("number").to_numpy())
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two keys have one hash")
        seeds = build_hash(hashes)
        n = len(hashes)
        at = find_slots(hashes, seeds, n)
        rows = np.empty(n, np.int64)
        rows[at] = np.arange(n)
        names, codes = np.unique(np.array(table.column("file").to_pylist()), return_inverse=True)

        def placed(values: np.ndarray, kind: str) -> bytes:
            return values[rows].astype(kind).tobytes()

        return pa.table(
            {
                "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
                "n": [n],
                "seeds": [seeds.tobytes()],
                "prints": [placed(fingerprints(hashes), "<u4")],
                "files": [names.tolist()],
                "file": [placed(codes, "<u4")],
                "offsets": [placed(table.column("offset").to_numpy(), "<u8")],
                "lengths": [placed(table.column("n_tokens").to_numpy(), "<u8")],
                "starts": [placed(table.column("start").to_numpy(), "<u8")],
            }
        )

    dealt = manifest.withColumn("bucket", bucket(n_buckets))
    return materialize(dealt.groupBy("bucket").applyInArrow(build, INDEX), "index"), n_buckets


FOUND = "key long, number int, file string, offset long, n_tokens long, start long"


def look_up(wanted: DataFrame, index: DataFrame, n_buckets: int) -> DataFrame:
    """Where the documents (key, number) of ``wanted`` stand; keys that are not indexed are left out."""

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        types = pa.schema(
            [("key", pa.int64()), ("number", pa.int32()), ("file", pa.string()), ("offset", pa.int64()),
             ("n_tokens", pa.int64()), ("start", pa.int64())]
        )
        if not left.num_rows or not right.num_rows:
            return types.empty_table()
        row = right.slice(0, 1).to_pylist()[0]
        hashes = key_hash(left.column("key"), left.column("number").to_numpy())
        at = find_slots(hashes, np.frombuffer(row["seeds"], np.uint32), row["n"])
        known = np.frombuffer(row["prints"], "<u4")[at] == fingerprints(hashes)
        left, at = left.filter(pa.array(known)), at[known]
        names = np.array(row["files"])[np.frombuffer(row["file"], "<u4")[at]]
        values = [np.frombuffer(row[c], "<u8")[at].astype(np.int64) for c in ("offsets", "lengths", "starts")]
        return pa.table([left.column("key"), left.column("number"), pa.array(names.tolist(), pa.string()), *map(pa.array, values)], schema=types)

    keyed = wanted.select("key", F.col("number").cast("int").alias("number")).withColumn("bucket", bucket(n_buckets))
    return keyed.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, FOUND)


def read_ids(found: DataFrame, folder: str, dtype: str) -> DataFrame:
    """(key, number, start, n_tokens, ids_crc32) read from the shard files at the found places.

    Places are sorted by file and offset, so each task reads forward in few files.
    """
    width = np.dtype(dtype).itemsize
    ordered = found.repartition("file").sortWithinPartitions("file", "offset")

    def read(batch: pa.RecordBatch) -> Iterator[dict]:
        files, base = file_system(folder)
        names, offsets, counts = (batch.column(i).to_pylist() for i in (2, 3, 4))
        sums, name, source = [], None, None
        for file, offset, count in zip(names, offsets, counts):
            if file != name:
                name, source = file, files.open_input_file(f"{base}/{file}")
            source.seek(offset * width)
            ids = np.frombuffer(source.read(count * width), dtype)
            if len(ids) != count:
                raise ValueError(f"{file} ends early")
            sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
        yield {"key": batch.column(0), "number": batch.column(1), "start": batch.column(5), "n_tokens": batch.column(4), "ids_crc32": sums}

    return arrow_map(ordered, read, "key long, number int, start long, n_tokens long, ids_crc32 long")


def write_and_read_back(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents, index them, then look every one up and read it from its shard."""
    folder = scratch_folder(spark, "llm-ids")
    manifest = materialize(write_ids(docs, vocabulary, folder), "places")
    index, n_buckets = build_index(manifest)
    found = look_up(manifest.select("key", "number"), index, n_buckets)
    return read_ids(found, folder, id_type(vocabulary))
