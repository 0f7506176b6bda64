"""Chat formatting by token-level assembly.

Every turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Markers are reserved ids behind the
vocabulary and are spliced in between segments that are encoded separately, so no text can make
one. So that the written-out form is safe as well, every ``<`` of a text that is followed by any
number of backslashes and a bar gets one more backslash, which reading takes away again. The
loss mask covers the segment of each assistant text: starts count +1 and ends -1, and the
prefix sum of these marks is the mask.

Rows are formatted turn by turn and put in order by (conversation, turn); a conversation is never
held as a whole, so one of any length takes the memory of a batch.

Defined results: a null role or text is empty, a null turn comes first, rows that share a turn are
ordered by role and text, a null conv_id is a conversation of its own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from . import wordsplit
from .common import empty_arrow

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """Break every control string of a text, reversibly."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles additionally keep no line break, since one ends the role."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Assembler:
    """Encodes turns with one vocabulary; the reserved ids follow its last id."""

    def __init__(self, path: str):
        self.tokenizer = wordsplit.fresh(path)  # its setting must not reach others in the worker
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.start, self.end = size, size + 1

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def turns(self, roles: list[str], texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and loss mask of each turn."""
        heads = self.encode([escape_role(r) + "\n" for r in roles])
        bodies = self.encode([escape(t) for t in texts])
        newline = self.encode(["\n"])[0]
        ids, masks = [], []
        for role, head, body in zip(roles, heads, bodies):
            turn = np.array([self.start, *head, *body, self.end, *newline], np.int32)
            marks = np.zeros(len(turn) + 1, np.int8)
            if role == TRAINED:
                marks[1 + len(head)] += 1
                marks[1 + len(head) + len(body)] -= 1
            ids.append(turn)
            masks.append(np.cumsum(marks[:-1]) > 0)
        return ids, masks

    def text(self, ids: np.ndarray) -> str:
        """The written-out form of ids, reserved ids included."""
        out, cut = [], np.flatnonzero(ids >= self.start)
        for a, b in zip([0, *(cut + 1)], [*cut, len(ids)]):
            out.append(self.tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False))
            if b < len(ids):
                out.append(START if ids[b] == self.start else END)
        return "".join(out)

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str | None, int]:
        """(role, text, text under the mask or None, characters written) of one assembled turn."""
        written = self.text(ids)
        if not (written.startswith(START) and written.endswith(f"{END}\n")):
            raise ValueError("not an assembled turn")
        role, _, text = written[len(START) : -len(END) - 1].partition("\n")
        role = unescape_role(role)
        trained = unescape(self.text(ids[mask])) if mask.any() else "" if role == TRAINED else None
        return role, unescape(text), trained, len(written)


@cache
def _assembler(path: str) -> Assembler:
    return Assembler(path)


FORMATTED = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("position", LongType()),
        StructField("start", LongType()),
        StructField("ids", ArrayType(IntegerType())),
        StructField("loss", ArrayType(BooleanType())),
    ]
)


def format_conversations(turns: DataFrame, vocabulary: str) -> DataFrame:
    """(conv_id, position, start, ids, loss): one row per turn, in order within its conversation.

    ``position`` counts the turns of a conversation and ``start`` its ids before this turn; the
    ids of a conversation are those of its rows, one after another.
    """
    types = empty_arrow(turns.sparkSession, FORMATTED)
    ordered = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assembler = _assembler(vocabulary)
        current, position, start = object(), 0, 0
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                convs = part.column(0).to_pylist()
                ids, masks = assembler.turns(part.column(2).to_pylist(), part.column(3).to_pylist())
                positions, starts = [], []
                for conv, turn in zip(convs, ids):
                    if conv != current:
                        current, position, start = conv, 0, 0
                    positions.append(position)
                    starts.append(start)
                    position, start = position + 1, start + len(turn)
                columns = (convs, positions, starts, ids, masks)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    return ordered.mapInArrow(run, FORMATTED)


READ = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("n_turns", LongType()),
        StructField("turns_sha256", StringType()),
        StructField("loss_chars", LongType()),
        StructField("loss_sha256", StringType()),
        StructField("formatted_chars", LongType()),
    ]
)


def read_conversations(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of formatted conversations, taken from their ids and masks alone."""
    types = empty_arrow(formatted.sparkSession, READ)
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assembler = _assembler(vocabulary)
        done: list[tuple] = []
        state = None

        def closed() -> tuple:
            conv, n, turns, chars, loss, written = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), written

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)

        for batch in batches:
            convs = batch.column(0).to_pylist()
            ids, masks = batch.column(3), batch.column(4)
            for i, conv in enumerate(convs):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(closed())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                values = ids[i].values.to_numpy()
                mask = masks[i].values.to_numpy(zero_copy_only=False).astype(bool)
                role, text, trained, written = assembler.read(values, mask)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if trained is not None:
                    state[3] += len(trained)
                    state[4].update(trained.encode())
                state[5] += written
            if len(done) > 1000:
                yield batch_of(done)
                done = []
        if state is not None:
            done.append(closed())
        if done:
            yield batch_of(done)

    return ordered.mapInArrow(run, READ)
