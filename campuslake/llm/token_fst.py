"""Token counts by compiled finite-state transducers, for byte-level BPE vocabularies.

Counting goes through two deterministic machines:

* The splitter reads characters and tells where the pre-tokens of the public byte-level pattern
  begin. It has eight states; characters come with the little lookahead that the pattern needs.
  A slice of texts is cut into chunks of equal length, all of which run side by side, and each
  becomes a map from every entry state to its exit state. Maps compose associatively, so a
  parallel prefix scan gives the entry state of each chunk; a second run with the known state
  marks the beginnings.
* The merge transducer reads the bytes of one pre-token. Its transitions carry how many tokens
  the encoding gains (or loses) with that byte, so a count is a sum along a path. Its state is
  what future bytes can depend on: the longest suffix read that a token can still begin with,
  and for each position in it the last token of the encoding up to there. States and
  transitions are compiled when first needed and dropped when there are too many, as lazy
  automata do.

The last token of a prefix is the longest token that ends there and may follow the last token
before it; two tokens may be neighbours unless some merge across their border would have come
before the merges that formed them.

Defined results: null and empty texts have no tokens; special strings in a text count as one
token each, as the library reads them.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from .common import annotate

CHUNK = 128
#: Compiled states and counted pre-tokens a task keeps, at most.
MAX_STATES = 300_000
MAX_COUNTS = 1_000_000

# Character symbols. The apostrophe has three: not before a contraction, before a contraction of
# one letter, before one of two. White space has three: inside a run (or at the end of a text), the
# last of a run before other text, and the same where it is a blank that joins what follows.
LETTER, NUMBER, OTHER, QUOTE1, QUOTE2, SPACE, LAST_SPACE, LAST_BLANK = range(8)
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, AFTER_BLANK, ONE_MORE, TWO_MORE = range(8)
N_STATES = N_SYMBOLS = 8
#: Second letters of the contractions 're, 've and 'll, and the letters of the short ones.
SHORT = "stmd"
LONG = ("re", "ve", "ll")


def splitter_table() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a pre-token begins, by symbol (+ 8 at the first character of a text) and state."""
    following = np.zeros((2 * N_SYMBOLS, N_STATES), np.uint8)
    begins = np.zeros((2 * N_SYMBOLS, N_STATES), np.uint8)
    inside = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}
    for state in range(N_STATES):
        for symbol, run in inside.items():
            following[symbol, state] = run
            begins[symbol, state] = state not in (run, AFTER_BLANK)
        for symbol, waiting in ((QUOTE1, ONE_MORE), (QUOTE2, TWO_MORE)):
            joins = state in (IN_OTHER, AFTER_BLANK)
            following[symbol, state] = IN_OTHER if joins else waiting
            begins[symbol, state] = not joins
        following[SPACE, state], begins[SPACE, state] = IN_SPACE, state != IN_SPACE
        following[LAST_SPACE, state], begins[LAST_SPACE, state] = START, 1
        following[LAST_BLANK, state], begins[LAST_BLANK, state] = AFTER_BLANK, 1
    following[LETTER, TWO_MORE], begins[LETTER, TWO_MORE] = ONE_MORE, 0
    following[LETTER, ONE_MORE], begins[LETTER, ONE_MORE] = START, 0
    for symbol in range(N_SYMBOLS):  # a new text forgets what came before
        following[N_SYMBOLS + symbol] = following[symbol, START]
        begins[N_SYMBOLS + symbol] = begins[symbol, START]
    return following, begins


NEXT, BEGINS = splitter_table()


@cache
def map_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All maps from entry to exit states that symbols can make, as numbers; 0 changes nothing.

    Returned are the map after one more symbol, the map after another map, and the exit state of
    each map from the start state. The splitter makes few distinct maps, so one number stands
    for what a chunk does to all eight states.
    """
    maps = [tuple(range(N_STATES))]
    numbers = {maps[0]: 0}
    rows = []
    for known in maps:  # grows while it is read
        row = []
        for symbol in range(2 * N_SYMBOLS):
            after = tuple(int(NEXT[symbol, state]) for state in known)
            if after not in numbers:
                numbers[after] = len(maps)
                maps.append(after)
            row.append(numbers[after])
        rows.append(row)
    composed = [[numbers[tuple(b[state] for state in a)] for b in maps] for a in maps]
    return np.array(rows, np.intp), np.array(composed, np.intp), np.array([m[START] for m in maps], np.intp)


def scan(maps: np.ndarray) -> np.ndarray:
    """Compose each map with all before it, in a number of steps that grows with the logarithm."""
    _, after, _ = map_tables()
    composed, step = maps.copy(), 1
    while step < len(composed):
        composed[step:] = after[composed[:-step], composed[step:]]
        step *= 2
    return composed


def beginnings(symbols: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Where pre-tokens begin in one long row of symbols."""
    n = len(symbols)
    rows = -(-n // chunk)
    padded = np.full(rows * chunk, SPACE, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(rows, chunk).T).astype(np.intp)
    append, _, from_start = map_tables()
    append, width = append.ravel(), 2 * N_SYMBOLS
    maps = np.zeros(rows, np.intp)
    for column in columns:
        maps = append[maps * width + column]
    state = np.full(rows, START, np.intp)
    state[1:] = from_start[scan(maps)[:-1]]
    following, begins = NEXT.ravel().astype(np.intp), BEGINS.ravel().astype(bool)
    marks = np.zeros((chunk, rows), bool)
    for j, column in enumerate(columns):
        at = column * N_STATES + state
        marks[j] = begins[at]
        state = following[at]
    return marks.T.reshape(-1)[:n]


class Symbols:
    """Turns characters into symbols; classes of characters are asked of the library itself."""

    def __init__(self, tokenizer):
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.known = np.full(0x110000, 255, np.uint8)

    def _class(self, c: str) -> int:
        if len(self.split("a" + c)) == 1:
            return LETTER
        if len(self.split("1" + c)) == 1:
            return NUMBER
        return OTHER if len(self.split("!" + c)) == 1 else SPACE

    def of(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Symbols of code points; ``first`` marks the first character of each text."""
        classes = self.known[points]
        if (classes == 255).any():
            for point in np.unique(points[classes == 255]):
                self.known[point] = self._class(chr(point))
            classes = self.known[points]
        n = len(points)
        same = np.zeros((3, n), bool)  # whether the text goes on for so many characters
        same[1, : n - 1] = ~first[1:]
        same[2, : n - 2] = same[1, : n - 2] & same[1, 1 : n - 1]
        after = np.zeros((3, n), points.dtype)
        after[1, : n - 1] = points[1:]
        after[2, : n - 2] = points[2:]
        out = classes.copy()
        quote = points == ord("'")
        if quote.any():
            out[quote & same[1] & np.isin(after[1], [ord(c) for c in SHORT])] = QUOTE1
            for a, b in LONG:
                out[quote & same[2] & (after[1] == ord(a)) & (after[2] == ord(b))] = QUOTE2
        space = classes == SPACE
        last = space.copy()
        last[: n - 1] &= same[1, : n - 1] & ~space[1:]
        last[n - 1 :] = False
        out[last] = LAST_SPACE
        out[last & (points == ord(" "))] = LAST_BLANK
        return out + N_SYMBOLS * first.astype(np.uint8)


@cache
def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, inverted."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTransducer:
    """Counts the BPE tokens of a pre-token byte by byte."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], skip: set[str] = frozenset()):
        to_byte = byte_characters()
        ids = {bytes(to_byte[c] for c in token): i for token, i in vocab.items() if token not in skip}
        as_bytes = {token: bytes(to_byte[c] for c in token) for token in vocab if token not in skip}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            a, b, whole = ids[as_bytes[left]], ids[as_bytes[right]], ids[as_bytes[left] + as_bytes[right]]
            self.rank.setdefault((a, b), rank)
            self.halves.setdefault(whole, (a, b, rank))
        usable = {t: i for t, i in ids.items() if len(t) == 1 or i in self.halves}
        self.ids = usable
        self.begins = {t[:k] for t in usable for k in range(1, len(t))}
        self.fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        #: A state is (bytes that a token can still begin with, last token and count at each of its positions).
        start = (b"", ((None, 0),))
        self.states = [start]
        self.numbers = {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}
        self.fits.clear()

    def may_follow(self, a: int, b: int) -> bool:
        """Whether BPE can leave a border between tokens a and b."""
        known = self.fits.get((a, b))
        if known is None:
            known = self.fits[a, b] = self._may_follow(a, b)
        return known

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The token and its outermost parts on one side, each with the rank of the merge that ends it."""
        out, until = [(token, float("inf"))], float("inf")
        while token in self.halves:
            until = self.halves[token][2]
            token = self.halves[token][side]
            out.append((token, until))
        return out

    def _may_follow(self, a: int, b: int) -> bool:
        for left, left_ends in self._spine(a, 1):
            for right, right_ends in self._spine(b, 0):
                rank = self.rank.get((left, right))
                # Of two equal merges the left one comes first.
                if rank is not None and rank < left_ends and rank <= right_ends:
                    return False
        return True

    def _compile(self, number: int, byte: int) -> tuple[int, int]:
        window, history = self.states[number]
        text = window + bytes([byte])
        before = history[-1][1]
        for k in range(len(text)):
            token = self.ids.get(text[k:])
            if token is None:
                continue
            previous, count = history[k]
            if previous is None or self.may_follow(previous, token):
                history = (*history, (token, count + 1))
                break
        else:
            raise ValueError("the vocabulary has no token for a byte")
        count = history[-1][1]
        keep = next((k for k in range(len(text)) if text[k:] in self.begins), len(text))
        history = tuple((token, n - count) for token, n in history[keep:])
        state = (text[keep:], history)
        target = self.numbers.get(state)
        if target is None:
            target = self.numbers[state] = len(self.states)
            self.states.append(state)
        move = self.moves[number << 8 | byte] = (target, count - before)
        return move

    def count(self, piece: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self.reset()
        state = total = 0
        moves = self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._compile(state, byte)
            state = move[0]
            total += move[1]
        return total


class Counter:
    """Token counts of texts for one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        special = {t["content"] for t in spec.get("added_tokens", ())}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.transducer = MergeTransducer(model["vocab"], pairs, special)
        self.symbols = Symbols(Tokenizer.from_file(path))
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.counts: dict[str, int] = {}

    def _pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of all texts and how many each text has."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        if not joined:
            return [], np.zeros(len(texts), np.int64)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        first = np.zeros(len(points) + 1, bool)
        first[offsets] = True
        starts = np.flatnonzero(beginnings(self.symbols.of(points, first[:-1])))
        cuts = starts.tolist()
        pieces = [joined[a:b] for a, b in zip(cuts, [*cuts[1:], len(joined)])]
        return pieces, np.diff(np.searchsorted(starts, offsets))

    def __call__(self, texts: list[str]) -> np.ndarray:
        specials = np.zeros(len(texts), np.int64)
        parts, owner = texts, None
        if self.special and any(self.special.search(t) for t in texts):
            # A special string is one token; the text goes on behind it as a new one.
            parts, owner = [], []
            for i, text in enumerate(texts):
                cut = self.special.split(text)
                specials[i] = len(cut) - 1
                parts += cut
                owner += [i] * len(cut)
        pieces, per_part = self._pieces(parts)
        known = self.counts
        if len(known) > MAX_COUNTS:
            known.clear()
        for piece in set(pieces).difference(known):
            known[piece] = self.transducer.count(piece.encode())
        tokens = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        running = np.concatenate([[0], np.cumsum(tokens)])
        ends = np.cumsum(per_part)
        each = running[ends] - running[ends - per_part]
        return specials + (each if owner is None else np.bincount(owner, each, len(texts)).astype(np.int64))


@cache
def _counter(path: str) -> Counter:
    return Counter(path)


COUNTED = StructType([StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents as (row, found) with found.n_bytes and found.n_tokens.

    ``vocabulary`` is the path of a byte-level BPE file that every executor can read.
    """

    def make():
        counter = _counter(vocabulary)

        def task(texts: pa.Array) -> dict:
            return {"n_bytes": pc.binary_length(texts).to_numpy(), "n_tokens": counter(texts.to_pylist())}

        return task

    return annotate(docs, make, COUNTED, text, keep)
