"""The trie of conversation prefixes, from sorted sequences, common prefixes and range minima.

``rebuild`` gives each conversation the opening turns of another one. ``prefix_nodes`` then finds
every distinct sequence of first turns with its members and what holds for its subtree.

1. A turn is known by 128 bits of the SHA-256 of its role and text, a conversation by the array of
   these. Texts stay where they are; only their lengths go along.
2. Conversations are sorted by array, dealt by ranges of (array, conv_id), so that any number of
   equal conversations spreads over tasks. Each task reads its range in runs of bounded size and
   takes the common prefix of each conversation with the one before, across runs as well.
3. Every prefix of every conversation is a candidate. In a sparse table of range minima over the
   common prefixes it binary-searches its left and its right extent, each by itself; all
   candidates of a run do so together. The one whose left extent is itself stands for the node.
4. What a node needs is a sum or a minimum over the interval of its members: with ``lcp`` for the
   common prefix with the conversation before, a conversation brings new nodes at the depths
   above ``lcp``, and a leaf ends at the last conversation before one that shares less than all of
   it. So prefix sums give whole subtrees, and parts of a node from different runs add up by the
   node's key. Where a range begins, its task could not see its neighbour; two conversations per
   range make good for that.

Defined results: a null role or text is empty, a null turn comes first, rows that share a turn are
ordered by role and id and repeated rows are turns of their own; rows without conv_id belong to
no conversation; no rows give no nodes; other columns are ignored. Texts of any length take the
memory of a row. A conversation is one array of 24 bytes per turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import split_join
from .common import empty_arrow, materialize

#: A run ends after so many conversations or turns.
RUN_CONVERSATIONS = 1 << 16
RUN_TURNS = 1 << 18
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): of each conversation the (id, chars) of its turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps ("ab", "c") apart from ("a", "bc").
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    brief = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("id"),
        F.length(text).cast("long").alias("chars"),
    ).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "id")
    numbered = brief.select("conv_id", F.struct(F.row_number().over(order).alias("no"), "id", "chars").alias("t"))
    listed = numbered.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["id"], t["chars"])).alias("turns"))


def rebuild(known: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Each conversation with its first ``head`` (``most`` at most) turns replaced by those of ``base``.

    ``base`` and ``head`` are expressions over ``conv_id``. All turns of a base with fewer are
    taken, and none where there is no such conversation.
    """
    wanted = known.withColumn("base", base).withColumn("head", head)
    # Only bases are asked for their openings, which are short whatever the conversation.
    opening = known.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("opening"))
    first = F.slice(F.coalesce("opening", F.slice("turns", 1, 0)), 1, F.col("head"))
    own = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns") - F.col("head"), F.lit(0)))
    return wanted.join(opening, "base", "left").select("conv_id", F.concat(first, own).alias("turns"))


class Minima:
    """Range minima by a sparse table: row k has the minima of 2**k values from each place on."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def extents(self, place: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last conversation that share the first ``depth`` turns with the one at ``place``.

        ``values[i]`` is the common prefix of conversations i - 1 and i. Each side is searched by
        itself: a step of 2**k is taken where the minimum of the values passed is no less.
        """
        n = len(self.rows[0])
        left, right = place.copy(), place.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row, width = self.rows[k], 1 << k
            # values[left - width + 1 .. left], and values[right + 1 .. right + width]
            can = left - width >= 0
            take = can & (row[np.where(can, left - width + 1, 0)] >= depth)
            left = np.where(take, left - width, left)
            can = right + width < n
            take = can & (row[np.where(can, right + 1, 0)] >= depth)
            right = np.where(take, right + width, right)
        return left, right


COUNTS = "key binary, parent binary, depth long, conv_id long, n_convs long, saved long, leaves long"
FOUND = f"kind string, {COUNTS}, ends string, part long, turns array<struct<id: binary, chars: long>>"


def node_keys(ids: list[bytes], chain: list[bytes], shared: int) -> list[bytes]:
    """Keys of the prefixes of a conversation; the first ``shared`` turns have those of ``chain``."""
    keys = chain[: shared + 1] or [bytes(16)]
    for turn in ids[len(keys) - 1 :]:
        keys.append(hashlib.blake2b(keys[-1] + turn, digest_size=16).digest())
    return keys


def common(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class Run:
    """Consecutive conversations of one task, and the common prefixes at both ends (-1: unknown or none)."""

    def __init__(self):
        self.convs: list[int] = []
        self.ids: list[list[bytes]] = []
        self.chars: list[list[int]] = []
        self.lcp: list[int] = []
        self.n_turns = 0

    def add(self, conv: int, ids: list[bytes], chars: list[int], lcp: int) -> None:
        self.convs.append(conv)
        self.ids.append(ids)
        self.chars.append(chars)
        self.lcp.append(lcp)
        self.n_turns += len(ids)

    def full(self) -> bool:
        return len(self.convs) >= RUN_CONVERSATIONS or self.n_turns >= RUN_TURNS

    def nodes(self, after: int, chain: list[bytes]) -> tuple[dict, dict, list[bytes]]:
        """Columns of the run's nodes and ends, and the keys of its last conversation."""
        n = len(self.convs)
        convs = np.array(self.convs, np.int64)
        lens = np.array([len(x) for x in self.ids], np.int64)
        lcp = np.array(self.lcp, np.int64)
        following = np.append(lcp[1:], after)
        # Characters before each depth, conversation after conversation, with one place for the root.
        start = np.zeros(n + 1, np.int64)
        np.cumsum(lens + 1, out=start[1:])
        cum = np.concatenate([np.cumsum([0, *c]) for c in self.chars])
        total = cum[start[1:] - 1]
        new = total - cum[start[:-1] + np.maximum(lcp, 0)]
        running = [np.concatenate([[0], np.cumsum(x)]) for x in (total, new, following < lens)]

        place = np.repeat(np.arange(n), lens + 1)
        depth = np.arange(len(place)) - start[place]
        inner = lcp.copy()
        inner[0] = -1
        left, right = Minima(inner).extents(place, depth)
        own = left == place
        place, depth, left, right = place[own], depth[own], left[own], right[own]
        lowest = _minima_of(convs, left, right)
        members = right - left + 1
        before = cum[start[place] + np.maximum(depth - 1, 0)]
        totals, news, leaves = (x[right + 1] - x[left] for x in running)
        # The first conversation of a node brings all depths from the node on, unless the run before has it.
        fresh = depth > lcp[place]
        news = np.where(fresh, news - new[place] + total[place] - before, news)
        saved = totals - members * before - news

        keys: list[bytes] = []
        ends: list[bytes] = []
        mine = place.tolist()
        depths = depth.tolist()
        at, parents = 0, []
        for i in range(n):
            chain = node_keys(self.ids[i], chain, self.lcp[i] if self.lcp[i] >= 0 else 0)
            ends.append(chain[-1])
            while at < len(mine) and mine[at] == i:
                d = depths[at]
                keys.append(chain[d])
                parents.append(chain[d - 1] if d else None)
                at += 1
        node = {
            "kind": ["node"] * len(keys), "key": keys, "parent": parents, "depth": depth, "conv_id": lowest,
            "n_convs": members, "saved": saved, "leaves": leaves,
        }
        # Conversations that end at one node stand together, their ids ascending.
        first = [i for i in range(n) if not i or ends[i] != ends[i - 1]]
        groups = zip(first, [*first[1:], n])
        end = {
            "kind": ["end"] * len(first), "key": [ends[i] for i in first], "conv_id": convs[first],
            "ends": [",".join(map(str, self.convs[a:z])) for a, z in groups],
        }
        return node, end, chain


def _minima_of(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest of ``values[left .. right]``, by a sparse table as well."""
    out = np.empty(len(left), np.int64)
    k = np.frexp((right - left + 1).astype(float))[1] - 1
    rows = Minima(values).rows
    for level in np.unique(k):
        at = k == level
        row = rows[level]
        out[at] = np.minimum(row[left[at]], row[right[at] - (1 << int(level)) + 1])
    return out


def _find(sorted_turns: DataFrame) -> DataFrame:
    """Nodes, ends and the outermost conversations of each task's range."""
    types = empty_arrow(sorted_turns.sparkSession, StructType.fromDDL(FOUND))

    def batch_of(columns: dict) -> pa.RecordBatch:
        n = len(columns["kind"])
        arrays = [pa.array(columns[f.name], type=f.type) if f.name in columns else pa.nulls(n, f.type) for f in types]
        return pa.RecordBatch.from_arrays(arrays, schema=types)

    def edge(kind: str, part: int, conv: int, ids: list, chars: list) -> pa.RecordBatch:
        turns = [{"id": i, "chars": c} for i, c in zip(ids, chars)]
        return batch_of({"kind": [kind], "part": [part], "conv_id": [conv], "turns": [turns]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chain, last = Run(), [], None
        for batch in batches:
            parts, convs, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            bounds = lists.offsets.to_pylist()
            all_ids = lists.values.field("id").to_pylist()
            all_chars = lists.values.field("chars").to_pylist()
            for part, conv, a, z in zip(parts, convs, bounds, bounds[1:]):
                ids, chars = all_ids[a:z], all_chars[a:z]
                lcp = common(last[2], ids) if last else -1
                if last is None:
                    yield edge("first", part, conv, ids, chars)
                if current.full():
                    *found, chain = current.nodes(lcp, chain)
                    yield from map(batch_of, found)
                    current = Run()
                current.add(conv, ids, chars, lcp)
                last = part, conv, ids, chars
        if last:
            *found, chain = current.nodes(-1, chain)
            yield from map(batch_of, found)
            yield edge("last", *last)

    return sorted_turns.mapInArrow(run, FOUND)


def _seams(found: DataFrame) -> DataFrame:
    """What nodes that reach from one task's range into the next counted twice."""
    spark = found.sparkSession
    edges = found.where(F.col("kind").isin("first", "last")).select("kind", "part", "turns")
    # As many as there are ranges, which the session's settings bound.
    parts = sorted(r["part"] for r in edges.where("kind = 'first'").select("part").collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:])), "part long, following long")
    before = edges.where("kind = 'last'").select("part", F.col("turns").alias("a"))
    behind = edges.where("kind = 'first'").select(F.col("part").alias("following"), F.col("turns").alias("b"))
    pairs = follows.join(before, "part").join(behind, "following").select("a", "b")
    types = empty_arrow(spark, StructType.fromDDL(COUNTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = ([t["id"] for t in row[side]] for side in "ab")
                shared = common(a, b)
                keys = node_keys(b[:shared], [], 0)
                cum = np.cumsum([0, *[t["chars"] for t in row["b"]][:shared]])
                depth = np.arange(shared + 1)
                twice = cum[-1] - cum[np.maximum(depth - 1, 0)]
                columns = {
                    "key": keys, "parent": [None, *keys[:-1]], "depth": depth, "n_convs": depth * 0, "saved": twice,
                    "leaves": np.full(len(depth), -1 if shared == len(a) else 0), "conv_id": [None] * len(depth),
                }
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in types], schema=types)

    return pairs.mapInArrow(run, COUNTS)


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id, ends): lists of ids by their first, read one after another."""
    types = empty_arrow(ends.sparkSession, schema := StructType.fromDDL("key binary, ends_sha256 string"))
    ordered = ends.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, done = None, None, []

        def closed() -> Iterator[pa.RecordBatch]:
            columns = [list(c) for c in zip(*done)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key != current:
                    if digest:
                        done.append((current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256(ids.as_py().encode())
                else:
                    digest.update(f",{ids}".encode())
            if len(done) > 10_000:
                yield from closed()
                done.clear()
        if digest:
            done.append((current, digest.hexdigest()))
            yield from closed()

    return ordered.mapInArrow(run, schema)


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """One row per node, from (conv_id, turns) as ``sequences`` or ``rebuild`` give them.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the
    smallest member, the smallest member of the parent (null for the root), and counts; subtrees
    include their top.
    """
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = F.transform("turns", lambda t: t["id"])
    ranged = (
        conversations.withColumn("ids", ids)
        .repartitionByRange(tasks, "ids", "conv_id")
        .sortWithinPartitions("ids", "conv_id")
        .select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "turns")
    )
    found = materialize(_find(ranged), "trie")
    seams = _seams(found)
    parts = found.where("kind = 'node'").select(seams.columns).unionByName(seams)
    nodes = materialize(
        parts.groupBy("key").agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.sum("leaves").alias("n_leaves"),
            F.sum("saved").alias("saved_tokens"),
        ),
        "trie-nodes",
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    ends = ends_hashes(found.where("kind = 'end'").select("key", "conv_id", "ends"))
    # Many children may have one parent, so they are spread over tasks by their own keys.
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    root = nodes.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    placed = split_join(nodes, parents, "parent", "key").unionByName(root)
    return placed.join(children, "key", "left").join(ends, "key", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"),
    )
