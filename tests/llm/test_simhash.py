"""SimHash fingerprints and BK-tree links against plain versions."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from campuslake.llm import queries, simhash


def plain_fingerprint(text: str | None) -> int:
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows: list[tuple]) -> list[tuple]:
    codes = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    values = np.array(codes, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 4):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(d, f"{c:016x}", least.get(find(i))) for i, ((d, _), c) in enumerate(zip(rows, codes))]


def as_sorted(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.queries()["op13_simhash"](spark, sf_dir).collect()
    assert as_sorted(got) == as_sorted(plain_components(docs))


def test_hard_rows(spark):
    rows = [
        (None, None), (3, ""), (2, " \t\n"), (5, "one two"), (4, "ONE\u000btwo"), (9, "Éa É b c"), (9, "éa é b c"),
        (7, "x " * 90_000 + "y"), (8, "x " * 90_000 + "z"), (8, "x " * 90_000 + "z"), (None, "lonely words of no one"),
    ]
    docs = spark.createDataFrame([(d, t, 0, "a") for d, t in rows], "doc_id long, text string, code int, part string")
    got = simhash.linked_components(docs).collect()
    assert as_sorted(got) == as_sorted(plain_components(rows))
    assert simhash.linked_components(docs.where("false")).count() == 0


def clustered(n: int, seed: int) -> np.ndarray:
    """Distinct codes around few centres, so that shards are crowded and chains are long."""
    random = np.random.default_rng(seed)
    centres = random.integers(0, 2**64, 6, dtype=np.uint64)
    codes = centres[random.integers(0, len(centres), n)]
    for _ in range(5):
        codes = codes ^ (np.uint64(1) << random.integers(0, 64, n).astype(np.uint64))
    return np.unique(codes)


@pytest.mark.parametrize("most", [32, 1024])
def test_crowded_shards_lose_no_link(spark, most):
    codes = clustered(1500, most)
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    links = simhash.shard_links(simhash.small_shards(frame, most=most)).collect()
    root = {int(c): int(c) for c in codes}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def parts() -> set:
        found: dict = {}
        for c in root:
            found.setdefault(find(c), set()).add(c)
        return {frozenset(p) for p in found.values()}

    for r in links:
        a, b = (int(np.int64(x).view(np.uint64)) for x in r)
        root[find(a)] = find(b)
    got = parts()
    root = {int(c): int(c) for c in codes}
    for i, c in enumerate(codes):
        for d in codes[:i][np.bitwise_count(codes[:i] ^ c) <= 4]:
            root[find(int(c))] = find(int(d))
    assert got == parts()


def test_search_follows_only_edges_within_the_radius():
    codes = clustered(1500, 3)
    forest = simhash.Forest(codes, np.array([0, 500, len(codes)]))
    got = {(int(a), int(b)) for x, y in forest.within(4, step=1000) for a, b in zip(x, y)}
    want = {
        (a, b) for a in range(len(codes)) for b in range(a)
        if (a < 500) == (b < 500) and int(codes[a] ^ codes[b]).bit_count() <= 4
    }
    assert got == want and len(want) > 20
    # Children of a node are keyed by their distance to it, one to an edge.
    assert len(np.unique(forest.branch)) == len(forest.branch)
    parent = forest.branch // 65
    assert (np.bitwise_count(codes[parent] ^ codes[forest.child]) == forest.branch % 65).all()


def test_blocks_share_out_the_free_bits():
    for fixed in (0, 0b1011, (1 << 61) - 1, (1 << 64) - 1):
        blocks = simhash.blocks_of(fixed, 5)
        assert sum(blocks) == (1 << 64) - 1 - fixed and all(b & fixed == 0 for b in blocks)
