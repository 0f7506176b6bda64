"""N-gram Jaccard join: documents whose sets of word shingles overlap, and their components.

The set of a document holds its distinct 5-word shingles (the whole word sequence where it has
fewer words). Two documents link when their sets' Jaccard similarity is 0.8 or more.

1. Documents with equal sets form one class, found by a hash of the set.
2. Candidates: two sets that link share one of the first shingles of both, in any fixed order of
   all shingles, if enough of the first ones are looked at. The order goes by how frequent a
   shingle is in the corpus, rare ones first, so passages that many documents share are seldom
   among them. Frequencies come from a list of bounded size; they decide the order only, never
   the result.
   With some more of the first shingles, a pair that links shares several of them, in proportion
   to the smaller set: where few classes share a key their pairs are counted, and pairs with too
   few shared keys fall out. Keys that many share are crowded and first counted by class: a pair
   that links and shares hardly any others has many of them on both sides. Classes with so many
   meet once more under these keys, and where many still share one, in order of their sizes, each
   is tied to the first of a run of sizes that could link, whatever the count. Other pairs lack no
   more keys than either side has crowded ones. Components of these ties contain whole components
   of links. Classes that share a very frequent key are tied within their batch already, and only
   the first of each run there, with the range of its sizes, meets the others.
3. Each candidate component is cut into tiles by size band and, within a band, by hash, each
   of bounded total size, and tiles of bands that can link are compared: parity bitmaps of
   hashed shingles bound the symmetric difference from below and so the overlap from above;
   what passes is intersected exactly as sorted arrays. Pairs already connected within the
   tile are not compared again. Links that connect are emitted, at most one per tile row.
   In a component of many tiles each tile is first compared with itself and the first tile of
   its own and the next band; only classes then outside the component's largest part meet the
   remaining tiles.

Shingles are 64-bit hashes.

Defined results: a null text or one without words has the empty set, links with nothing and is
its own component; rows with the same doc_id are one document each, a component's id is the
smallest doc_id in it; a null doc_id is carried along and is the id only of a component that has
no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..operators.joins import split_join
from .common import annotate, arrow_map, materialize, steps
from .components import components
from .textarrays import Texts, mix, windows_hash

SHINGLE = 5
#: Similarity as a fraction, so that tests on it are exact.
NUMERATOR, DENOMINATOR = 4, 5
#: Shingles whose frequency decides their place in the order, at most.
FREQUENT = 1_000_000
#: Size of the bitmap of candidate ids, as a power of two.
BITMAP_BITS = 24
#: Classes with one key whose pairs are counted; with more of them the key is crowded.
FEW = 8
#: A shingle in so many documents, as a binary logarithm, is tied within batches before its rows meet.
HOT_GRADE = 14
#: A set shows one more key for so many shingles, and a pair must then share one more.
SPARE = 20
#: A pair with less than this part of the keys that it needs, in keys of few classes, has the others in crowded ones.
LEAST_SHARE = 6
#: Shingles of neighbouring documents that are counted together.
COUNTED_TOGETHER = 4_000_000
#: Shingles that the sets of one tile hold together, about; a set weighs at least LEAST_WEIGHT.
TILE_SHINGLES = 1 << 21
LEAST_WEIGHT = 512


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their bounds."""
    texts = Texts(column, lower=True)
    hashes = texts.word_hashes()
    document = np.repeat(np.arange(len(texts)), texts.n_words)
    windows = windows_hash(hashes, size)
    inside = document[: len(windows)] == document[size - 1 :][: len(windows)]
    values, owners = windows[inside], document[: len(windows)][inside]
    short = np.flatnonzero((texts.n_words > 0) & (texts.n_words < size))
    if len(short):
        whole = []
        for d in short:
            value = np.uint64(texts.n_words[d])
            for h in hashes[texts.bounds[d] : texts.bounds[d + 1]]:
                value = mix(np.array([value], np.uint64) + h)[0]
            whole.append(value)
        values = np.concatenate([values, np.array(whole, np.uint64)])
        owners = np.concatenate([owners, short])
        order = np.argsort(owners, kind="stable")
        values, owners = values[order], owners[order]
    ends = np.searchsorted(owners, np.arange(len(texts) + 1))
    for a, b in zip(ends[:-1], ends[1:]):
        values[a:b].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[fresh], owners[fresh]
    return values, np.searchsorted(owners, np.arange(len(texts) + 1))


def set_hash(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set that does not depend on order: its sum and xor of mixed values."""
    mixed = mix(values ^ np.uint64(0x5851F42D4C957F2D))
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
    sums = total[bounds[1:]] - total[bounds[:-1]]
    return mix(sums + np.diff(bounds).astype(np.uint64))


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def min_overlap(a, b):
    """Least intersection of two sets of sizes a and b that link: ceil(t (a + b) / (1 + t))."""
    return -((-NUMERATOR * (a + b)) // (NUMERATOR + DENOMINATOR))


def frequent_shingles(docs: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in many documents, sorted, and the binary logarithm of how many.

    They are counted within batches of neighbouring documents and summed where they repeat there.
    """

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        held: list[np.ndarray] = []

        def repeated() -> dict:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return {"shingle": signed(values[counts > 1]), "n": counts[counts > 1]}

        for _, texts in steps(batch.column(0)):
            held.append(shingle_sets(texts)[0])
            if sum(map(len, held)) > COUNTED_TOGETHER:
                yield repeated()
        if held:
            yield repeated()

    counted = arrow_map(docs.select("text"), count, "shingle long, n long")
    top = counted.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(most)
    table = top.toArrow()
    values, counts = table.column("shingle").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(values)
    return values[order], np.log2(counts[order]).astype(np.int8)


def classes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class): documents with equal sets share a class; null for an empty set."""

    def digest(batch: pa.RecordBatch) -> Iterator[dict]:
        for start, texts in steps(batch.column(1)):
            values, bounds = shingle_sets(texts)
            n = np.diff(bounds)
            yield {
                "doc_id": batch.column(0).slice(start, len(texts)),
                "n_shingles": n,
                "class": pa.array(signed(set_hash(values, bounds)), mask=n == 0),
            }

    return arrow_map(docs.select("doc_id", "text"), digest, "doc_id long, n_shingles long, class long")


def shared_keys(n):
    """How many keys a set of n shingles shares with each set of its size or more that it links with."""
    return 1 + n // SPARE


def least_counted(need):
    """Shared keys of few classes below which a pair that needs ``need`` keys is told by crowded ones alone."""
    return F.greatest(F.lit(1), F.floor(need / LEAST_SHARE))


def least_crowded(n):
    """Crowded keys of a set of n shingles that links with one with which it shares fewer keys of few classes than that."""
    need = shared_keys_of(F.ceil(n * NUMERATOR / DENOMINATOR))
    return need - least_counted(need) + 1


def shared_keys_of(n):
    """``shared_keys`` of a column."""
    return F.floor(n / SPARE) + 1


def local_runs(key: np.ndarray, n: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of frequent keys as runs of sizes that could link, and ties of their members to the first.

    A run is (key, n, hi, class, head) with its smallest and largest size and its first class as
    class and head; a tie has size 0, a class and its head, and stands under the class.
    """
    order = np.lexsort((c, n, key))
    key, n, c = key[order], n[order], c[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (DENOMINATOR * n[:-1] < NUMERATOR * n[1:])
    starts = np.flatnonzero(first)
    head = c[starts][np.cumsum(first) - 1]
    hi = n[np.append(starts[1:], len(n)) - 1]
    member = ~first & (head != c)
    none = np.zeros(member.sum(), np.int64)
    return {
        "key": np.concatenate([key[starts], c[member]]),
        "n": np.concatenate([n[starts], none]),
        "hi": np.concatenate([hi, none]),
        "class": np.concatenate([c[starts], c[member]]),
        "head": np.concatenate([c[starts], head[member]]),
    }


KEYS = "key long, n long, hi long, class long, head long"


def _keys(docs: DataFrame, frequent, hot_grade: int = HOT_GRADE) -> DataFrame:
    """(key, n, hi, class, head) for the first shingles of every set; ``head`` is null but for ``local_runs``."""

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        often, grades = frequent.value
        held: list[tuple] = []
        for _, texts in steps(batch.column(0)):
            values, bounds = shingle_sets(texts)
            n = np.diff(bounds)
            owners = np.repeat(np.arange(len(n)), n)
            grade = np.zeros(len(values), np.int64)
            if len(often):
                at = np.minimum(np.searchsorted(often, values), len(often) - 1)
                grade = np.where(often[at] == values, grades[at], 0)
            order = np.argsort(64 * owners + grade, kind="stable")
            rank = np.arange(len(values)) - bounds[:-1][owners]
            # A set of n links only with an overlap of ceil(t n) at least, so with its partner it
            # shares at least k of its first n - ceil(t n) + k shingles.
            first = n + (-NUMERATOR * n) // DENOMINATOR + shared_keys(n)
            chosen = rank < first[owners]
            picked = order[chosen]
            digests = set_hash(values, bounds)
            keys, sizes, digests = values[picked], n[owners[picked]], digests[owners[picked]]
            _, once = np.unique(mix(keys + mix(digests)), return_index=True)  # copies show a key once
            keys, sizes, digests = signed(keys[once]), sizes[once], signed(digests[once])
            hot = grade[picked][once] >= hot_grade
            if hot.any():
                held.append((keys[hot], sizes[hot], digests[hot]))
            rest = ~hot
            yield {"key": keys[rest], "n": sizes[rest], "hi": sizes[rest], "class": digests[rest], "head": pa.nulls(int(rest.sum()), pa.int64())}
        if held:
            yield local_runs(*map(np.concatenate, zip(*held)))

    return arrow_map(docs.select("text"), cut, KEYS)


def _tied(keys: DataFrame, last: bool) -> DataFrame:
    """Rows (a, b, need, size) from all classes of each key: pairs, ties with the first of a run, crowded keys.

    A pair has the number of keys that it needs, a tie needs 0; both have size 0. A crowded key, b,
    stands beside its class, a, and the size of that; in the ``last`` round classes are tied under it.
    """
    types = pa.schema([(name, pa.int64()) for name in ("a", "b", "need", "size")])

    def tied_rows(x, y, need) -> pa.RecordBatch:
        rows = np.minimum(x, y), np.maximum(x, y), need, np.zeros(len(x), np.int64)
        return pa.RecordBatch.from_arrays([*map(pa.array, rows)], schema=types)

    def crowded_rows(key, n, c) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*map(pa.array, (c, key, np.zeros(len(c), np.int64), n))], schema=types)

    def pairs(key, n, c, few) -> Iterator[pa.RecordBatch]:
        """All pairs that could link by size, where few classes share the key."""
        for step in range(1, FEW):
            i = np.flatnonzero(few[:-step] & (key[:-step] == key[step:]))
            i = i[(DENOMINATOR * n[i] >= NUMERATOR * n[i + step]) & (c[i] != c[i + step])]
            if not len(i):
                break
            yield tied_rows(c[i], c[i + step], shared_keys(n[i]))

    def stars(key, n, top, c, use, held) -> tuple[np.ndarray, pa.RecordBatch]:
        """Each class with the first of its run of sizes; ``held`` is the last row before these."""
        joined = np.zeros(len(key), bool)
        joined[1:] = (key[1:] == key[:-1]) & (DENOMINATOR * top[:-1] >= NUMERATOR * n[1:])
        if held is not None:
            joined[0] = key[0] == held[0] and DENOMINATOR * held[1] >= NUMERATOR * n[0]
        heads = np.maximum.accumulate(np.where(joined, 0, np.arange(len(key))))
        roots = c[heads]
        if joined[0]:
            roots[: len(joined) if joined.all() else int(np.argmin(joined))] = held[2]
        use = use & (roots != c)
        return roots, tied_rows(roots[use], c[use], np.zeros(use.sum(), np.int64))

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a key that may go on in the next batch wait there, unless they are many
        # already: then the last of them and the head of its run are enough.
        waiting = [np.zeros(0, np.int64)] * 5
        held: tuple[int, int, int] | None = None

        def done(rows, held, over: bool):
            key, n, hi, c, run = rows
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (c[1:] != c[:-1]) | (run[1:] > 0) | (run[:-1] > 0)
            key, n, hi, c, run = (x[fresh] for x in (key, n, hi, c, run))
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            # Where runs meet the classes are many, whatever the rows.
            lengths = np.diff(np.append(cuts, len(key))) + (FEW + 1) * np.maximum.reduceat(run, cuts)
            if held is not None and key[0] == held[0]:
                lengths[0] += FEW + 1
            wait = [x[len(x) :] for x in (key, n, hi, c, run)]
            if not over and lengths[-1] <= FEW:
                wait = [x[cuts[-1] :] for x in (key, n, hi, c, run)]
                key, n, hi, c, run = (x[: cuts[-1]] for x in (key, n, hi, c, run))
                lengths = lengths[:-1]
            if not len(key):
                return wait, held, []
            own = cuts[: len(lengths)]
            sizes = np.diff(np.append(own, len(key)))
            many = np.repeat(lengths > FEW, sizes)
            # The largest size so far of each key.
            group = np.repeat(np.arange(len(own)), sizes) << 40
            top = np.maximum.accumulate(group + hi) - group
            if held is not None and key[0] == held[0]:
                top[: sizes[0]] = np.maximum(top[: sizes[0]], held[1])
            # Runs are of keys in so many classes that these met in their batches, ties and all.
            crowded = many & (run == 0) & (not last)
            roots, star = stars(key, n, top, c, many & ~crowded, held)
            held = (int(key[-1]), int(top[-1]), int(roots[-1])) if many[-1] else None
            return wait, held, [*pairs(key, n, c, ~many), star, crowded_rows(key[crowded], n[crowded], c[crowded])]

        for batch in batches:
            key, n, hi, c = (batch.column(i).to_numpy() for i in range(4))
            head = batch.column(4)
            ready = n == 0
            if ready.any():
                heads = head.filter(pa.array(ready)).to_numpy()
                yield tied_rows(heads, c[ready], np.zeros(len(heads), np.int64))
            run = head.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            rows = [np.concatenate([w, x[~ready]]) for w, x in zip(waiting, (key, n, hi, c, run))]
            if len(rows[0]):
                waiting, held, out = done(rows, held, over=False)
                yield from out
        if len(waiting[0]):
            yield from done(waiting, held, over=True)[2]

    ordered = keys.repartition("key").sortWithinPartitions("key", "n", "class")
    return ordered.mapInArrow(tie, "a long, b long, need long, size long")


def _ties(keys: DataFrame) -> DataFrame:
    """(a, b) of classes that may link; components of these hold whole components of links."""
    met = materialize(_tied(keys, last=False), "key-rows", release=True)
    crowded = materialize(
        met.where("size > 0")
        .groupBy(F.col("a").alias("class"))
        .agg(F.min("size").alias("n"), F.collect_list("b").alias("keys"))
        .select("class", "n", "keys", F.size("keys").alias("crowded")),
        "crowded",
        release=True,
    )
    # What shares too few other keys shares so many crowded ones that both sides are here.
    heavy = crowded.where(F.col("crowded") >= least_crowded(F.col("n")))
    again = heavy.select(F.explode("keys").alias("key"), "n", F.col("n").alias("hi"), "class", F.lit(None).cast("long").alias("head"))
    rows = met.where("size = 0").unionByName(_tied(again, last=True))
    counted = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("need").alias("need"))
    counted = materialize(counted.where(F.col("shared") >= F.least("need", least_counted(F.col("need")))), "pairs", release=True)
    # The others' missing keys may be crowded ones.
    more, lacks = crowded.select("class", "crowded"), F.col("need") - F.col("shared")
    rest = counted.where(lacks > 0).select("a", "b", lacks.alias("lacks"))
    for side in ("a", "b"):
        rest = rest.join(more.withColumnRenamed("class", side), side).where("crowded >= lacks").drop("crowded")
    return counted.where(lacks <= 0).select("a", "b").unionByName(rest.select("a", "b"))


def bitmaps(values: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """One parity bitmap per set: a bit tells whether an odd number of its shingles hash there."""
    n = len(bounds) - 1
    owners = np.repeat(np.arange(n), np.diff(bounds))
    places = (mix(values) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(owners * bits + places, minlength=n * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, bits), axis=1).view(np.uint64)


def tile_links(
    ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray]
) -> list[tuple[int, int]]:
    """Links that connect the sets of a tile pair; side 0 is one tile, 1 the other, 2 both at once.

    Only pairs across the sides are compared, or all pairs on side 2.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, sides, sets = ids[order], sides[order], [sets[i] for i in order]
    n = np.array([len(s) for s in sets])
    group = np.arange(len(ids))
    bits = max(64, 1 << int(2 * n.max()).bit_length())
    bits = min(bits, 1 << 14)
    maps = np.concatenate(
        [
            bitmaps(np.concatenate(sets[i : i + 256]), np.concatenate([[0], np.cumsum(n[i : i + 256])]), bits)
            for i in range(0, len(sets), 256)
        ]
    )
    reach = np.searchsorted(n, (n * DENOMINATOR) // NUMERATOR, "right")
    links = []
    for i in range(len(ids)):
        others = np.arange(i + 1, reach[i])
        others = others[(group[others] != group[i]) & ((sides[others] != sides[i]) | (sides[others] == 2))]
        if not len(others):
            continue
        need = min_overlap(n[i], n[others])
        apart = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1, dtype=np.int64)
        others = others[apart <= n[i] + n[others] - 2 * need]
        for j in others:
            if group[j] == group[i]:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if DENOMINATOR * shared >= NUMERATOR * (n[i] + n[j] - shared):
                links.append((int(ids[i]), int(ids[j])))
                group[group == group[j]] = group[i]
    return links


def _compare(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) links among members (tile, side, class, doc_id), by tile."""

    def links(table: pa.Table) -> pa.Table:
        ids = table.column("class").to_numpy()
        sides = table.column("side").to_numpy()
        sets = []
        for _, part in steps(table.column("text").combine_chunks()):
            values, bounds = shingle_sets(part)
            sets += [values[bounds[i] : bounds[i + 1]] for i in range(len(part))]
        found = tile_links(ids, sides, sets)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    placed = members.join(texts, "class").select("tile", "side", "class", "text")
    return placed.groupBy("tile").applyInArrow(links, "a long, b long")


def _band(n: str):
    """Sizes of one band, or of it and the next, are all that can link."""
    return F.floor(F.log(F.col(n)) / F.log(F.lit(DENOMINATOR / NUMERATOR) * F.lit(1.0000001))).cast("long")


def _tiled(candidates: DataFrame, tile_shingles: int) -> DataFrame:
    """Candidates (class, n, comp) with band, salt, and the tile numbers of their band and the next."""
    weight = F.greatest(F.col("n"), F.least(F.lit(LEAST_WEIGHT), F.lit(tile_shingles)))
    total = candidates.groupBy("comp").agg(F.sum(weight).alias("total"))
    # One component may hold most candidates, so they are spread by their classes.
    sized = split_join(candidates, total, "comp", "class").withColumn(
        "band", F.when(F.col("total") <= tile_shingles, F.lit(-1).cast("long")).otherwise(_band("n"))
    )
    tiles = sized.groupBy("comp", "band").agg(
        F.ceil(F.sum(weight) / F.lit(tile_shingles)).cast("long").alias("tiles")
    )
    after = tiles.select("comp", (F.col("band") - 1).alias("band"), F.col("tiles").alias("tiles_up"))
    before = tiles.select("comp", (F.col("band") + 1).alias("band"), F.col("tiles").alias("tiles_down"))
    known = tiles.join(after, ["comp", "band"], "left").join(before, ["comp", "band"], "left")
    known = known.where("band >= 0").unionByName(
        tiles.where("band < 0").select("comp", "band", "tiles", F.lit(None).cast("long").alias("tiles_up"), F.lit(None).cast("long").alias("tiles_down"))
    )
    place = F.struct("comp", "band").alias("place")
    known = known.select(place, "tiles", "tiles_up", "tiles_down")
    return (
        split_join(sized.withColumn("place", place), known, "place", "class")
        .drop("place")
        .withColumn("salt", F.pmod(F.xxhash64("class"), F.col("tiles")))
        .fillna(0, ["tiles_up", "tiles_down"])
    )


def _place(tiled: DataFrame, first: bool) -> DataFrame:
    """Rows (tile, side, class): the tile pairs each class takes part in.

    The first round pairs every tile with itself and with tile 0 of its own and the next band;
    the second pairs classes outside the largest part (``left``) with all other tiles.
    """

    def tile(band_a, salt_a, band_b, salt_b):
        return F.struct("comp", band_a.alias("ba"), salt_a.alias("sa"), band_b.alias("bb"), salt_b.alias("sb"))

    band, salt, zero = F.col("band"), F.col("salt"), F.lit(0).cast("long")

    def rows(df: DataFrame, name, side: int) -> DataFrame:
        return df.select(name.alias("tile"), F.lit(side).alias("side"), "class")

    def spread(df: DataFrame, count: str, name: str) -> DataFrame:
        return df.where(F.col(count) > 0).withColumn(name, F.explode(F.sequence(zero, F.col(count) - 1)))

    if first:
        parts = [rows(tiled, tile(band, salt, band, salt), 2)]
        parts.append(rows(tiled.where("salt > 0"), tile(band, zero, band, salt), 1))
        own = spread(tiled.where("salt = 0 and tiles > 1"), "tiles", "other").where("other > 0")
        parts.append(rows(own, tile(band, zero, band, F.col("other")), 0))
        # A tile of the next band against tile 0 of this one, seen from both.
        parts.append(rows(tiled.where("tiles_down > 0"), tile(band - 1, zero, band, salt), 1))
        up = spread(tiled.where("salt = 0"), "tiles_up", "other")
        parts.append(rows(up, tile(band, zero, band + 1, F.col("other")), 0))
    else:
        big = tiled.where("tiles > 1 or tiles_up > 0 or tiles_down > 0")
        loose = big.where("left")
        parts = []
        for count, step in (("tiles", 0), ("tiles_up", 1), ("tiles_down", -1)):
            # A loose class (side 0) meets every class of the tile (side 1) it is sent to.
            met = spread(loose, count, "other")
            parts.append(rows(met, tile(band, salt, band + step, F.col("other")), 0))
            back = {"tiles": "tiles", "tiles_up": "tiles_down", "tiles_down": "tiles_up"}[count]
            seen = spread(big, back, "other")
            wanted = parts[-1].select("tile").distinct()
            parts.append(
                rows(seen, tile(band - step, F.col("other"), band, salt), 1).join(wanted, "tile", "left_semi")
            )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents with all their columns, one of each component: the smallest doc_id in it.

    Documents without words stay. Of repeated rows with one doc_id and one set, one stays. Different
    texts that do not link stay, also on rows with one doc_id or without any; a null doc_id is kept
    only of a component that has no other.
    """
    linked = linked_components(docs, with_class=True, **options).where(F.col("class").isNotNull())
    linked = materialize(linked.select("doc_id", "class", "part"), "linked")
    key = [F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("class")]
    # A component is told by its part: the doc_id that names it may be null or name others as well.
    kept = linked.groupBy("part").agg(F.min(F.struct(*key)).alias("k")).select("k.*")
    # Most documents are alone in their component and stay where they are; a bitmap of fixed size tells most of them.
    tied = linked.where(F.col("class") != F.col("part")).select(F.explode(F.array("class", "part")).alias("class"))
    copied = linked.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("class")
    place = F.pmod("class", F.lit(1 << BITMAP_BITS))
    marked = docs.sparkSession.sparkContext.broadcast(_bitmap(tied.unionByName(copied).select(place.alias("place"))))

    def make():
        def digest(texts: pa.Array) -> dict:
            values, bounds = shingle_sets(texts)
            empty = np.diff(bounds) == 0
            classes = signed(set_hash(values, bounds))
            alone = empty | ~_marked(marked.value, classes & ((1 << BITMAP_BITS) - 1))
            return {"class": pa.array(classes, mask=empty), "alone": alone}

        return digest

    found = StructType([StructField("class", LongType()), StructField("alone", BooleanType())])
    rows = annotate(docs, make, found)
    others = rows.where(~F.col("found.alone")).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), "found.class")
    # Repeated rows meet within their tasks first, and once they have moved the join finds them in place.
    ones = others.select("row", *key).dropDuplicates(["late", "id", "class"]).join(kept, ["late", "id", "class"])
    return rows.where("found.alone").select("row.*").unionByName(ones.select("row.*"))


def linked_components(
    docs: DataFrame,
    tile_shingles: int = TILE_SHINGLES,
    frequent: int = FREQUENT,
    with_class: bool = False,
    hot_grade: int = HOT_GRADE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = materialize(classes_of(docs), "classes")
    often = spark.sparkContext.broadcast(frequent_shingles(docs, frequent))
    chained = components(_ties(_keys(docs, often, hot_grade)))
    # One document stands for its class; its text is all that the comparison needs.
    heads = known.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("n_shingles").alias("n"), F.min("doc_id").alias("doc_id")
    )
    candidates = materialize(
        chained.select(F.col("node").alias("class"), F.col("root").alias("comp")).join(heads, "class"), "candidates"
    )
    texts = materialize(_texts(docs, candidates), "candidate-texts", release=True)
    tiled = materialize(_tiled(candidates.select("class", "n", "comp"), tile_shingles), "tiles")
    links = materialize(_compare(_place(tiled, first=True), texts), "first-links", release=True)
    many = tiled.where("tiles > 1 or tiles_up > 0 or tiles_down > 0")
    if many.limit(1).count():
        links = links.unionByName(materialize(_second_links(many, links, texts), "second-links", release=True))
    parts = components(links).select(F.col("node").alias("class"), "root")
    placed = materialize(
        heads.join(parts, "class", "left").select("class", "doc_id", F.coalesce("root", "class").alias("part")), "parts"
    )
    named = placed.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    # A part may hold most classes and a class most documents: both are spread over tasks.
    ids = split_join(placed, named, "part", "class").select("class", "part", "component_id")
    linked = split_join(known, ids, "class", "doc_id").select("doc_id", "n_shingles", "component_id", "class", "part")
    alone = known.where(F.col("class").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "class", F.lit(None).cast("long").alias("part")
    )
    whole = linked.unionByName(alone)
    return whole if with_class else whole.select("doc_id", "n_shingles", "component_id")


def _bitmap(places: DataFrame) -> np.ndarray:
    """The places (place), of 2 ** BITMAP_BITS, as one bit each."""
    words = (
        places.groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bitmap


def _marked(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 6] >> (at & 63)) & 1 == 1


def _texts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(class, text) for one document of each candidate class.

    A bitmap of fixed size, of hashed ids, keeps most other texts out of the join.
    """
    spark = docs.sparkSession
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS))
    marked = spark.sparkContext.broadcast(_bitmap(candidates.select(place.alias("place"))))

    def own(batch: pa.RecordBatch) -> Iterator[dict]:
        batch = batch.filter(pa.array(_marked(marked.value, batch.column(0).to_numpy())))
        for start, texts in steps(batch.column(2)):
            values, bounds = shingle_sets(texts)
            yield {
                "doc_id": batch.column(1).slice(start, len(texts)),
                "class": pa.array(signed(set_hash(values, bounds)), mask=np.diff(bounds) == 0),
                "text": texts.cast(pa.string()),
            }

    found = arrow_map(docs.select(place.alias("place"), "doc_id", "text"), own, "doc_id long, class long, text string")
    wanted = candidates.select(F.col("doc_id").alias("head"), F.col("class").alias("wanted"))
    # The same id may stand on several rows; the one whose set has the class is meant.
    same = (F.col("class") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("head"))
    return found.join(wanted, same).select("class", "text").dropDuplicates(["class"])


def _second_links(many: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between classes outside a component's largest part and all others of it."""
    parts = components(links).select(F.col("node").alias("class"), "root")
    labelled = many.join(parts, "class", "left").withColumn("root", F.coalesce("root", "class"))
    sizes = labelled.groupBy("comp", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("comp").agg(F.max(F.struct("size", "root")).alias("top")).select("comp", F.col("top.root").alias("main"))
    marked = labelled.join(largest, "comp").withColumn("left", F.col("root") != F.col("main"))
    return _compare(_place(marked, first=False), texts)
