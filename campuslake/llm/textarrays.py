"""Texts as byte arrays: words, lines and their hashes without a Python loop per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one, so that every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: Ranges of up to so many bytes are hashed side by side, longer ones one by one.
SHORT_BYTES = 64


def ranges_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; equal bytes give equal hashes wherever they stand.

    Eight bytes at a time are mixed in, one after another; a sum of bytes times powers would be
    blind to texts that are arranged by halves.
    """
    if not len(starts):
        return np.zeros(0, U64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = (ends - starts).astype(np.int64)
    out = mix(left.astype(U64) + U64(BASE))
    long = np.flatnonzero(left > SHORT_BYTES)
    live = np.flatnonzero((left > 0) & (left <= SHORT_BYTES))
    at, rest = starts[live].astype(np.int64), left[live]
    while len(live):
        word = eight[at]
        part = rest < 8
        word[part] &= (U64(1) << (U64(8) * rest[part].astype(U64))) - U64(1)
        out[live] = mix(out[live] ^ mix(word)) * U64(BASE)
        more = rest > 8
        live, at, rest = live[more], at[more] + 8, rest[more] - 8
    if len(long):
        raw = memoryview(padded)
        digest = xxhash.xxh64_intdigest
        cuts = zip(starts[long].tolist(), ends[long].tolist())
        out[long] ^= np.fromiter((digest(raw[a:b]) for a, b in cuts), U64, len(long))
    return mix(out)


def windows_hash(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values."""
    n = max(0, len(values) - size + 1)
    out = np.zeros(n, U64)
    for j in range(size):
        out = out * U64(BASE) + values[j : j + n]
    return mix(out)


def lookup(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACES = lookup(bytes([0x20, *range(0x09, 0x0E)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def running(flags: np.ndarray) -> np.ndarray:
    """Counts of true flags before each position, with the total at the end."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


class Texts:
    """A slice of texts in one byte buffer, cut into words at ASCII white space."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        self.data = LOWER[data] if lower else data
        self.offsets = offsets - offsets[0]
        self.in_word = ~SPACES[self.data]
        fresh = np.ones(len(self.data) + 1, bool)
        fresh[1:-1] = ~self.in_word[:-1]
        fresh[self.offsets] = True
        self.starts = np.flatnonzero(self.in_word & fresh[:-1])
        last = np.ones(len(self.data) + 1, bool)
        last[1:-1] = ~self.in_word[1:]
        last[self.offsets] = True
        self.ends = np.flatnonzero(self.in_word & last[1:]) + 1
        #: Words of text d are those from bounds[d] to bounds[d + 1].
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.bounds)

    def word_hashes(self) -> np.ndarray:
        return ranges_hash(self.data, self.starts, self.ends)

    def per_text(self, counts: np.ndarray) -> np.ndarray:
        """Differences of running counts over bytes, per text."""
        return counts[self.offsets[1:]] - counts[self.offsets[:-1]]


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same
    often = later.copy()
    often[order[:-1]] |= same
    return often, later
