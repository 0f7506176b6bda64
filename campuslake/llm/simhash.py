"""SimHash near-duplicates, searched with BK-trees.

A text's fingerprint has 64 bits: bit b is set where over half of the hashes of its shingles have
it. Fingerprints link at ``RADIUS`` or fewer differing bits; what reaches each other by links is a
component.

1. Every distinct fingerprint stands for its documents.
2. Fingerprints are dealt to shards by blocks of bits: of ``RADIUS + 1`` blocks two linked
   fingerprints agree in one at least, so they meet in its shard. A shard of more than
   ``SHARD_CODES`` is dealt again by the bits that its members may still differ in, as often as
   needed: with r bits left a shard holds 2**r distinct fingerprints at most, so this ends, and no
   shard is capped or cut.
3. Each shard is a BK-tree: a child hangs under its parent by their integer Hamming distance. A
   search at distance x from a node goes on below the edges from x - radius to x + radius only.
   The trees of a batch are built and searched together, one step of depth at a time.
4. A shard hands on a spanning forest of its links, never their pairs; components follow.

Defined results: a null text, an empty one and one without words have fingerprint zero and link
like any other; texts with fewer words than a shingle are one shingle; texts are hashed in steps,
so a very long one takes its own size in memory and no more; repeated rows keep one row each, a
null doc_id stays null and names a component only if no member has one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_join
from .common import arrow_map, materialize
from .components import components

WORDS = 4
SEED = 42
RADIUS = 4
SHARD_CODES = 1024
#: Shingles hashed, and pairs of a query and a node followed, at a time.
STEP = 1 << 16
FOLLOWED = 1 << 21

U64 = np.uint64


def shingle_hashes(text: str, words: int = WORDS, step: int = STEP) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of a text, repeats included, in arrays of ``step`` at most."""
    parts = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if 0 < len(parts) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: max(0, len(parts) - words + 1)], ends[words - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), step):
        cuts = zip(starts[at : at + step].tolist(), ends[at : at + step].tolist())
        yield np.array([digest(joined[a:b], SEED) for a, b in cuts], U64)


def fingerprint(text: str | None) -> int:
    """The bits that over half of the shingle hashes have."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text or ""):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, code): the fingerprint of each document, as the signed long with its bits."""

    def task(batch: pa.RecordBatch) -> Iterator[dict]:
        codes = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), U64, len(batch))
        yield {"doc_id": batch.column(0), "code": codes.view(np.int64)}

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(slim, task, "doc_id long, code long")


def blocks_of(fixed: int, parts: int) -> list[int]:
    """``parts`` masks that share out the bits not in ``fixed``; some are empty if bits are few."""
    free = [b for b in range(64) if not fixed >> b & 1]
    cuts = [len(free) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:])]


def _deal(shards: DataFrame, radius: int) -> DataFrame:
    """(fixed, key, code) for every shard that the members of a shard may meet in.

    ``fixed`` says which bits the members of a shard agree in, ``key`` what these are.
    """

    def task(batch: pa.RecordBatch) -> Iterator[dict]:
        fixed, codes = (batch.column(k).to_numpy().view(U64) for k in (0, 1))
        for mask in np.unique(fixed):
            own = codes[fixed == mask]
            for block in blocks_of(int(mask), radius + 1):
                agreed = U64(int(mask) | block)
                fixed_now = np.full(len(own), agreed)
                columns = {"fixed": fixed_now, "key": own & agreed, "code": own}
                yield {name: values.view(np.int64) for name, values in columns.items()}

    return arrow_map(shards.select("fixed", "code"), task, "fixed long, key long, code long")


def small_shards(codes: DataFrame, radius: int = RADIUS, most: int = SHARD_CODES) -> DataFrame:
    """(fixed, key, codes): shards of two to ``most`` fingerprints; every linked pair meets in one."""
    if most < 1 << radius:
        raise ValueError("shards of so few fingerprints may not come apart")
    left = codes.select(F.lit(0).cast("long").alias("fixed"), "code")
    done = []
    while True:
        dealt = _deal(left, radius)
        # Two ways may lead to one shard; its fingerprints count once.
        dealt = materialize(dealt.distinct() if done else dealt, "shards")
        sizes = dealt.groupBy("fixed", "key").agg(F.count(F.lit(1)).alias("size"))
        large = materialize(sizes.where(F.col("size") > most).select("fixed", "key"), "large-shards")
        done.append(dealt.join(large, ["fixed", "key"], "left_anti"))
        if not large.limit(1).count():
            break
        left = dealt.join(large, ["fixed", "key"], "left_semi")
    shards = done[0]
    for more in done[1:]:
        shards = shards.unionByName(more)
    # In order, so that a shard gives the same links each time.
    gathered = shards.groupBy("fixed", "key").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return gathered.where(F.size("codes") > 1).select("codes")


class Forest:
    """BK-trees of several shards: ``codes`` in order of shards, shard s from ``bounds[s]`` on."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray):
        n = len(codes)
        self.codes = codes
        parent = np.full(n, -1)
        edge = np.zeros(n, np.int64)
        self.root = np.repeat(bounds[:-1], np.diff(bounds))
        # Codes without a place yet, each at the node that it hangs under somewhere.
        waiting = np.flatnonzero(self.root != np.arange(n))
        at = self.root[waiting]
        while len(waiting):
            away = np.bitwise_count(codes[waiting] ^ codes[at]).astype(np.int64)
            branch, first, of = np.unique(at * 65 + away, return_index=True, return_inverse=True)
            child = waiting[first]
            parent[child], edge[child] = at[first], away[first]
            rest = np.ones(len(waiting), bool)
            rest[first] = False
            waiting, at = waiting[rest], child[of[rest]]
        inner = np.flatnonzero(parent >= 0)
        order = np.argsort(parent[inner] * 65 + edge[inner], kind="stable")
        #: Children by (parent, edge).
        self.child = inner[order]
        self.branch = (parent * 65 + edge)[self.child]

    def within(self, radius: int, step: int = FOLLOWED) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(code, earlier code of its shard) at ``radius`` bits or fewer, as places, in several parts."""
        n = len(self.codes)
        size = np.bincount(self.root, minlength=n)[self.root]
        step_of = np.cumsum(size) // step
        for start, stop in _runs(step_of):
            query = np.arange(start, stop)
            node = self.root[start:stop]
            while len(query):
                away = np.bitwise_count(self.codes[query] ^ self.codes[node]).astype(np.int64)
                near = (away <= radius) & (node < query)
                if near.any():
                    yield query[near], node[near]
                low = np.searchsorted(self.branch, node * 65 + np.maximum(away - radius, 0), "left")
                high = np.searchsorted(self.branch, node * 65 + np.minimum(away + radius, 64), "right")
                many = high - low
                query = np.repeat(query, many)
                node = self.child[np.repeat(low - np.cumsum(many) + many, many) + np.arange(len(query))]


def _runs(steps: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(steps)) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(steps)])


def spanning(forest: Forest, radius: int) -> np.ndarray:
    """For each code the place of the first code that it reaches by links within its shard."""
    label = np.arange(len(forest.codes))
    for a, b in forest.within(radius):
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            high, low = np.maximum(x, y)[open_], np.minimum(x, y)[open_]
            np.minimum.at(label, high, low)
            while not np.array_equal(label, label[label]):
                label = label[label]
    return label


def shard_links(shards: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a spanning forest of the links within each shard (codes)."""

    def task(batch: pa.RecordBatch) -> Iterator[dict]:
        lists = batch.column(0)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        codes = lists.values.to_numpy().view(U64)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        for start, stop in _runs(bounds[1:] // STEP):
            own = codes[bounds[start] : bounds[stop]]
            forest = Forest(own, bounds[start : stop + 1] - bounds[start])
            label = spanning(forest, radius)
            tied = np.flatnonzero(label != np.arange(len(label)))
            yield {"a": own[tied].view(np.int64), "b": own[label[tied]].view(np.int64)}

    return arrow_map(shards.select("codes"), task, "a long, b long").distinct()


def linked_components(docs: DataFrame, radius: int = RADIUS, most: int = SHARD_CODES) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text)."""
    known = materialize(fingerprints(docs), "fingerprints")
    # The smallest doc_id of a fingerprint; min passes over nulls.
    heads = materialize(known.groupBy("code").agg(F.min("doc_id").alias("head")), "codes")
    roots = components(shard_links(small_shards(heads, radius, most), radius))
    placed = heads.join(roots, heads["code"] == roots["node"], "left").select(
        "code", "head", F.coalesce("root", "code").alias("part")
    )
    placed = materialize(placed, "parts")
    named = placed.groupBy("part").agg(F.min("head").alias("component_id"))
    ids = split_join(placed, named, "part", "code").select("code", "component_id")
    # Copies of one text share a code, so the rows of a frequent code are spread by their ids.
    return split_join(known, ids, "code", "doc_id").select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id"
    )
