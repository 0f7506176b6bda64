"""BPE encoding and decoding through a table of distinct words.

1. The most frequent words of a sample of documents, a table of bounded size (``HOT_WORDS`` rows of
   up to ``HOT_BYTES`` bytes), are encoded and broadcast. The sample decides only how words travel.
   Words with punctuation behind them count as words here, so that most texts are cut at white
   space alone.
2. Tasks split texts into words. They write the row of each word of the table in its place and
   leave a mark for every other word. Those meet by the word itself, where each distinct one is
   encoded once, and its ids return to the marks of their documents; there rows and marks become
   ids. Rows are shorter than ids, so that is what moves, the most frequent words' in the fewest bits.
3. Decoding joins every id with its piece; the table of pieces is as large as the vocabulary and
   broadcast.

The vocabulary is a BPE file with word ends whose tokenizer drops white space. Documents meet
their words by 96 bits of hashes over the whole row, its address. What goes to a document is one
string of bytes: its address, what it is, and that.

Defined results: a null or empty text has no ids and decodes to the empty string; special
strings in a text are read as the library reads them; repeated rows each get a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from . import wordsplit
from .common import arrow_map, empty_arrow, steps

HOT_WORDS = 1 << 19
HOT_BYTES = 48
#: About so many documents are sampled for frequent words.
SAMPLE_DOCUMENTS = 50_000
#: Tasks that encode the table of frequent words.
ENCODERS = 8
#: A longer word may have as many rows as documents, so these are dealt to so many groups by document.
SPREAD = 64
#: Distinct words a task gathers before it hands its counts on.
GATHERED = 250_000
ID_TYPE = np.dtype("<u4")
#: Places that become ids in one step.
PLACES = 1 << 18
#: Set in a word's place to its number among the other words of the document; rows stay below.
MARK = 1 << 31
#: A packed place is a code of a byte: a row below OWN itself, MARKED for a mark, and one of those
#: between for many other rows, whose lowest bits are packed apart.
OWN = 190
MARKED = 255
ADDRESS = np.dtype([("key", "<i8"), ("check", "<u4")])
#: Behind the address: a word's number if it is below this, this and four bytes if not, or
#: DOCUMENT, which comes behind all words.
LONG_NUMBER = 254
DOCUMENT = 255
#: The low half of a word's place is the check of its document, the high half its number.
LOW = (1 << 32) - 1


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each distinct word occurs, and each that has punctuation behind it with that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def handed() -> pa.RecordBatch:
            # Pieces of several words count for each of them as well.
            for piece, n in list(counts.items()):
                words = wordsplit.words(piece)
                if len(words) > 1:
                    for word in words:
                        counts[word] += n
            words, n = pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

        for batch in batches:
            for _, texts in steps(batch.column(0)):
                for body in texts.cast(pa.large_binary()).to_pylist():
                    counts.update(wordsplit.pieces(body))
                if len(counts) > GATHERED:
                    yield handed()
        if counts:
            yield handed()

    found = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def narrow(ids: Sequence[int]) -> bytes:
    """Ids of one word in the fewest bytes each that hold them all, behind that number."""
    width = 1
    while max(ids, default=0) >> 8 * width:
        width *= 2
    return bytes([width]) + np.array(ids, f"<u{width}").tobytes()


def widen(data: bytes) -> bytes:
    """What :func:`narrow` packed, in 32 bits each."""
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(ID_TYPE).tobytes()


def frequent_words(docs: DataFrame, vocabulary: str, text: str, most: int, sample: int) -> pa.Table:
    """(word, ids) of the ``most`` most frequent words in about ``sample`` documents, those first that occur most."""
    n = docs.count()
    some = docs if n <= sample else docs.sample(sample / n, seed=0)
    counted = count_words(some, text).where(F.octet_length("word") <= HOT_BYTES)
    # Few rows once more, so that tasks encode them side by side.
    top = counted.orderBy(F.desc("n"), "word").limit(most).select("word", "n").repartition(ENCODERS)

    def encoded(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = wordsplit.encode(vocabulary, batch.column(0).to_pylist())
        yield {"word": batch.column(0), "ids": [np.array(i, ID_TYPE).tobytes() for i in ids], "n": batch.column(1)}

    found = arrow_map(top, encoded, "word string, ids binary, n long").toArrow()
    return found.sort_by([("n", "descending")]).select(["word", "ids"])


def addresses(keys: np.ndarray, checks: np.ndarray) -> pa.Array:
    """The address of each document by its hashes."""
    found = np.empty(len(keys), ADDRESS)
    found["key"], found["check"] = keys, checks
    kind = pa.binary(ADDRESS.itemsize)
    return pa.Array.from_buffers(kind, len(found), [None, pa.py_buffer(found)]).cast(pa.binary())


def _number(number: int) -> bytes:
    return number.to_bytes(1) if number < LONG_NUMBER else LONG_NUMBER.to_bytes(1) + number.to_bytes(4, "little")


def _joined(*parts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(b""))


def encode_words(rows: DataFrame, vocabulary: str) -> DataFrame:
    """(data) of rows (key, place, word); a distinct word is encoded once for all its rows.

    ``data`` holds address, number and ids, these as :func:`narrow` packs them.
    """
    long = F.when(F.octet_length("word") > HOT_BYTES, F.pmod("key", F.lit(SPREAD))).otherwise(0)
    met = rows.repartition("word", long).sortWithinPartitions("word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids = None, b""
        for batch in batches:
            met = pc.dictionary_encode(batch.column(2))
            words = met.dictionary.to_pylist()
            fresh = [w for w in words if w != last]
            packed = {last: ids} | dict(zip(fresh, map(narrow, wordsplit.encode(vocabulary, fresh))))
            found = pa.array([packed[w] for w in words], pa.binary()).take(met.indices)
            if words:
                last = batch.column(2)[-1].as_py()
                ids = packed[last]
            places = batch.column(1).to_numpy()
            to = addresses(batch.column(0).to_numpy(), places & LOW)
            numbers = pa.array(map(_number, (places >> 32).tolist()), pa.binary())
            yield pa.RecordBatch.from_arrays([_joined(to, numbers, found)], names=["data"])

    return met.select("key", "place", "word").mapInArrow(run, "data binary")


def piece_table(vocabulary: str) -> list[str | None]:
    """The piece of every id."""
    found = wordsplit.load(vocabulary).get_vocab(with_added_tokens=True)
    pieces: list[str | None] = [None] * (max(found.values(), default=-1) + 1)
    for piece, i in found.items():
        pieces[i] = piece
    return pieces


def decode(ids: list[bytes], pieces: pa.Array) -> pa.Array:
    """The text of each list of packed ids, by a join of ids and pieces."""
    ends = np.cumsum([0, *map(len, ids)]) // ID_TYPE.itemsize
    flat = np.frombuffer(b"".join(ids), ID_TYPE) if ends[-1] else np.zeros(0, ID_TYPE)
    found = pieces.take(pa.array(flat, pa.uint32()))
    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), found)
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def low_bits(rows: int) -> int:
    """How many bits of a place its code leaves out, for a table of so many rows."""
    return max(0, (rows - 1 - OWN) // (MARKED - OWN)).bit_length()


def _press(places: np.ndarray, low: int) -> bytes:
    """Places as compressed codes, the bits that these leave out, and the numbers of marks."""
    codes, marks = places.astype(np.uint8), places >= MARK
    far = (places >= OWN) & ~marks
    rest = places[far] - ID_TYPE.type(OWN)
    codes[far], codes[marks] = OWN + (rest >> low), MARKED
    data = zstandard.compress(codes.tobytes())
    parts = [len(data).to_bytes(4, "little"), data]
    for start in range(0, len(rest), PLACES):
        octets = rest[start : start + PLACES].view(np.uint8).reshape(-1, ID_TYPE.itemsize)
        parts.append(np.packbits(np.unpackbits(octets, 1, low, "little"), bitorder="little").tobytes())
    return b"".join([*parts, narrow((places[marks] - ID_TYPE.type(MARK)).tolist())])


def _unpress(data: bytes, low: int) -> np.ndarray:
    at = 4 + int.from_bytes(data[:4], "little")
    codes = np.frombuffer(zstandard.decompress(data[4:at]), np.uint8)
    places, marks = codes.astype(ID_TYPE), codes == MARKED
    far = (codes >= OWN) & ~marks
    rest = (places[far] - ID_TYPE.type(OWN)) << low
    for start in range(0, len(rest), PLACES):
        part = rest[start : start + PLACES]
        octets = np.frombuffer(data, np.uint8, -(-len(part) * low // 8), at)
        bits = np.zeros((len(part), 8 * ID_TYPE.itemsize), np.uint8)
        bits[:, :low] = np.unpackbits(octets, count=len(part) * low, bitorder="little").reshape(len(part), low)
        part |= np.packbits(bits, 1, "little").view(ID_TYPE).ravel()
        at += len(octets)
    places[far] = rest + ID_TYPE.type(OWN)
    places[marks] = np.frombuffer(widen(data[at:]), ID_TYPE) + ID_TYPE.type(MARK)
    return places


class Ragged:
    """Lists of ids end to end, and where each begins."""

    def __init__(self, lists: Sequence[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(lists), ID_TYPE)
        self.sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // ID_TYPE.itemsize
        self.starts = np.cumsum(self.sizes) - self.sizes

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the lists at ``rows``, and how many each has."""
        sizes = self.sizes[rows]
        shift = self.starts[rows] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes


def places_of(body: bytes, known: dict[bytes, int]) -> tuple[np.ndarray, list[bytes]]:
    """The row in ``known`` of every word of a text, or its mark, and the words that have marks, in their order."""
    pieces = wordsplit.pieces(body)
    rows = np.fromiter(map(known.get, pieces, repeat(MARK)), ID_TYPE, len(pieces))
    missing = np.flatnonzero(rows == MARK)
    if not len(missing):
        return rows, []
    # Pieces that are not in the table fall into their words.
    words = [wordsplit.words(pieces[i]) for i in missing.tolist()]
    others = sorted({w for each in words for w in each if w not in known})
    number = dict(zip(others, range(MARK, MARK + len(others))))
    found = [known[w] if w in known else number[w] for each in words for w in each]
    sizes = np.ones(len(rows), np.int64)
    sizes[missing] = [len(each) for each in words]
    gone = np.zeros(len(rows), bool)
    gone[missing] = True
    out = np.repeat(rows, sizes)
    out[np.repeat(gone, sizes)] = found
    return out, others


def _filled(places: np.ndarray, hot: Ragged, others: Ragged) -> bytes:
    """Packed ids of the words at all places of a document."""
    parts = []
    for start in range(0, len(places), PLACES):
        part = places[start : start + PLACES]
        marks = part >= MARK
        sizes = np.empty(len(part), np.int64)
        common, sizes[~marks] = hot.take(part[~marks])
        rare, sizes[marks] = others.take(part[marks] - MARK)
        ids, is_rare = np.empty(sizes.sum(), ID_TYPE), np.repeat(marks, sizes)
        ids[~is_rare], ids[is_rare] = common, rare
        parts.append(ids.tobytes())
    return b"".join(parts)


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    keep: Sequence[str] | None = None,
    hot_words: int = HOT_WORDS,
    sample: int = SAMPLE_DOCUMENTS,
) -> DataFrame:
    """Documents as (row, ids, decoded); ``ids`` are packed little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    hot = spark.sparkContext.broadcast(packed(frequent_words(docs, vocabulary, text, hot_words, sample)))
    # As many pieces as the vocabulary has.
    pieces = spark.sparkContext.broadcast(piece_table(vocabulary))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").cast("string").alias("text")
    ).select(
        F.xxhash64("row", "text").alias("key"),
        F.hash("row", "text").alias("check"),
        "row",
        "text",
    )
    row_type = rows.schema["row"].dataType

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _dictionary(hot.value)
        for batch in batches:
            for start, texts in steps(batch.column(2)):
                found = [places_of(body, known)[1] for body in texts.cast(pa.large_binary()).to_pylist()]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                at = pa.array(np.repeat(np.arange(start, start + len(found)), sizes))
                numbers = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                place = pa.array(numbers << 32 | batch.column(1).take(at).to_numpy().view(np.uint32))
                words = pa.array([w for each in found for w in each], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), place, words], names=["key", "place", "word"])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _dictionary(hot.value)
        low = low_bits(len(known))
        for batch in batches:
            for start, texts in steps(batch.column(3)):
                key, check, row, _ = batch.slice(start, len(texts)).columns
                data = [_press(places_of(body, known)[0], low) for body in texts.cast(pa.large_binary()).to_pylist()]
                to = addresses(key.to_numpy(), check.to_numpy().view(np.uint32))
                found = _joined(to, pa.scalar(bytes([DOCUMENT])), pa.array(data, pa.binary()))
                yield pa.RecordBatch.from_arrays([found, row], names=["data", "row"])

    rare = rows.select("key", "check", "text").mapInArrow(others, "key long, place long, word string")
    returned = encode_words(rare, vocabulary).select("data", F.lit(None).cast(row_type).alias("row"))
    bodies = rows.mapInArrow(marked, StructType([StructField("data", BinaryType()), rows.schema["row"]]))
    result = StructType([rows.schema["row"], StructField("ids", BinaryType()), StructField("decoded", StringType())])
    types = empty_arrow(spark, result)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _dictionary.cache_clear()  # the words have their places; the stages that follow need the memory
        known = pa.array(pieces.value, pa.large_string())
        common = Ragged(unpacked(hot.value).column("ids").to_pylist())
        low = low_bits(len(common.sizes))
        other: dict[int, bytes] = {}
        current = None

        def done(batch: pa.RecordBatch, rows: list[int], ids: list[bytes]) -> pa.RecordBatch:
            columns = [batch.column(1).take(pa.array(rows)), pa.array(ids, pa.binary()), decode(ids, known)]
            return pa.RecordBatch.from_arrays(columns, schema=types)

        for batch in batches:
            data = batch.column(0)
            rows, ids, held = [], [], 0
            for i in range(len(data)):
                sent = data[i].as_py()
                address, number, start = sent[: ADDRESS.itemsize], sent[ADDRESS.itemsize], ADDRESS.itemsize + 1
                if address != current:
                    other, current = {}, address
                if number != DOCUMENT:
                    if number == LONG_NUMBER:
                        number, start = int.from_bytes(sent[start : start + 4], "little"), start + 4
                    other[number] = widen(sent[start:])
                    continue
                rows.append(i)
                ids.append(_filled(_unpress(sent[start:], low), common, Ragged([other[k] for k in sorted(other)])))
                held += len(ids[-1])
                if held > 8 << 20:
                    yield done(batch, rows, ids)
                    rows, ids, held = [], [], 0
            if rows:
                yield done(batch, rows, ids)

    both = bodies.unionByName(returned)
    met = both.repartition(F.substring("data", 1, ADDRESS.itemsize)).sortWithinPartitions("data")
    return met.mapInArrow(assemble, result)


def unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


@lru_cache(maxsize=1)
def _dictionary(data: bytes) -> dict[bytes, int]:
    """The row of each word in the table; kept for the next task of the process."""
    words = unpacked(data).column("word").cast(pa.binary()).to_pylist()
    return dict(zip(words, range(len(words))))


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def digests(encoded: DataFrame) -> DataFrame:
    """(row, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    return encoded.select(
        "row",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


__all__ = ["count_words", "decode", "digests", "encode_documents", "encode_words", "frequent_words", "piece_table"]
