"""Repair of the turn structure of conversations at least cost, with square-root checkpoints.

``damage`` harms rows in a way that can be repeated, ``repair`` mends whatever rows it is given. A
mended conversation has the role initials ``(s?(ua)+)?``: maybe a system turn, then user and
assistant in turn. An edit keeps a row (K, 0), gives it the role that is due (R, 1), deletes it
(D, 2) or inserts an empty turn (I, 5); blank and repeated rows have to go, and a row that breaks
off costs 5 unless it is deleted. Of the cheapest lists of edits the one whose initials come first
in ASCII order is taken.

1. Rows are dealt by ranges of their order, so a conversation with a third of all rows lies in many
   tasks, and numbered. Repeats are told by the least number of each hash of role and text.
2. Of each row one letter goes on, its class by role and fault. The letters of a conversation meet
   in one string, in two steps; its audit, which is one cell of the result, is as long. Texts do
   not meet.
3. The cheapest costs from a row to the end are a vector over the states of the pattern. Going
   back, only the vectors at every square root of n rows stay; going forward, each block between
   two of them is computed again and left behind, so that beside the letters n rows take memory
   for about 2 sqrt(n) vectors.
4. The audit meets the rows again in order, and the texts run through the digest one by one.

Defined results: a null role or text is one space, a null turn comes first and does not count for
gaps, a null conv_id is a conversation of its own; rows that share a turn are ordered by role and
text; a role without an initial cannot be kept; no rows give no result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import inf, isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import empty_arrow, materialize

WHITE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 1, 2, 5, 5
#: Rows of a conversation, in order, whose letters are put together first.
PIECE_BITS = 12

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn with the role that is due.
DUE = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua-"
FAULTS = ("sound", "blank", "duplicate", "truncated")
#: A row's letter: its initial and its fault.
LETTERS = {chr(ord("A") + 4 * i + f): (INITIALS[i], FAULTS[f]) for i in range(4) for f in range(4)}
#: The state that a kept row leads to, from each state that it may follow.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "-": {}}


def _clean(turns: DataFrame) -> DataFrame:
    def text(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)

    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text")
    )


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage, by the checksum of ``conv_id:turn``.

    Of 20 rows about one is dropped, emptied, rid of sentence ends, repeated, or made the user's.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)))
    harmed = _clean(turns).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))
    return harmed.drop("copy")


def numbered(turns: DataFrame) -> DataFrame:
    """The rows with ``pos``, which ascends along each conversation."""
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The running number of the input tells equal rows apart, so that any number of them spreads.
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    ranged = _clean(turns).withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(tasks, *order)
    return ranged.sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id()).drop("tie")


def _letters(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, letter) of numbered rows."""
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    seen = F.unhex(F.sha2(whole, 256))
    firsts = rows.groupBy("conv_id", seen.alias("seen")).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.instr(F.lit(INITIALS[:3]), F.left("role", F.lit(1)))
    brief = rows.select(
        "conv_id",
        "pos",
        F.when((initial == 0) | (F.length("role") == 0), 3).otherwise(initial - 1).alias("initial"),
        (body == "").alias("blank"),
        (~F.right(body, F.lit(1)).isin(*".!?")).alias("broken"),
    )
    fault = F.when(F.col("blank"), 1).when(F.col("new").isNull(), 2).when(F.col("broken"), 3).otherwise(0)
    return brief.join(firsts, "pos", "left").select(
        "conv_id", "pos", F.char(ord("A") + 4 * F.col("initial") + fault).alias("letter")
    )


def _strings(rows: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """(conv_id, letters, gaps) for every conversation of ``conv_ids``, with rows or without."""

    def joined(parts, field: str):
        return F.array_join(F.transform(F.array_sort(parts), lambda x: x[field]), "")

    piece = F.shiftright("pos", PIECE_BITS).alias("piece")
    letters = _letters(rows).groupBy("conv_id", piece).agg(
        joined(F.collect_list(F.struct("pos", "letter")), "letter").alias("letters")
    )
    distinct = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    gaps = distinct.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")
    )
    parts = (
        conv_ids.select(F.col("conv_id").cast("long").alias("conv_id"))
        .distinct()
        .unionByName(letters, allowMissingColumns=True)
        .unionByName(gaps, allowMissingColumns=True)
    )
    present = F.when(F.col("piece").isNotNull(), F.struct("piece", "letters"))
    return parts.groupBy("conv_id").agg(
        joined(F.collect_list(present), "letters").alias("letters"), F.coalesce(F.max("gaps"), F.lit(0)).alias("gaps")
    )


Vector = tuple[float, float, float, float]


def _with_inserts(w: list[float]) -> Vector:
    """Costs when turns may be inserted first."""
    user = min(w[USER], INSERT + w[ASSISTANT])
    assistant = min(w[ASSISTANT], INSERT + w[USER])
    return min(w[START], INSERT + user), min(w[SYSTEM], INSERT + user), user, assistant


def edits_of(letter: str, state: int) -> Iterator[tuple[str, float, int]]:
    """(initial, cost, next state) of the edits that a row allows, in ASCII order of initials."""
    initial, fault = LETTERS[letter]
    yield "D", DELETE, state
    if fault in ("blank", "duplicate"):
        return
    more = BROKEN if fault == "truncated" else 0
    if state in KEPT[initial]:
        yield "K", KEEP + more, KEPT[initial][state]
    yield "R", REROLE + more, DUE[state]


EDITS = {letter: [list(edits_of(letter, state)) for state in range(4)] for letter in LETTERS}
AT_END = _with_inserts([0, inf, inf, 0])


def back(letter: str, after: Vector) -> Vector:
    """Cheapest costs from before a row, by state, given those from behind it."""
    return _with_inserts([min(cost + after[then] for _, cost, then in edits) for edits in EDITS[letter]])


def cheapest_edits(letters: str) -> tuple[int, str]:
    """The least cost, and the ASCII-least initials of edits that reach it."""
    n = len(letters)
    block = isqrt(n) + 1
    checkpoints = {n: AT_END}
    vector = AT_END
    for i in range(n - 1, -1, -1):
        vector = back(letters[i], vector)
        if i % block == 0:
            checkpoints[i] = vector
    least, state, audit = vector[START], START, []

    def inserted(now: Vector, state: int, before: str) -> bool:
        return INSERT + now[DUE[state]] == now[state] and "I" < before

    for start in range(0, n, block):
        stop = min(start + block, n)
        vectors = [checkpoints.pop(stop)]
        for i in range(stop - 1, start - 1, -1):
            vectors.append(back(letters[i], vectors[-1]))
        vectors.reverse()
        if stop < n:
            checkpoints[stop] = vectors[-1]
        for i in range(start, stop):
            now, after = vectors[i - start], vectors[i - start + 1]
            while True:
                tight = [e for e in EDITS[letters[i]][state] if e[1] + after[e[2]] == now[state]]
                if not inserted(now, state, tight[0][0] if tight else "Z"):
                    break
                audit.append("I")
                state = DUE[state]
            audit.append(tight[0][0])
            state = tight[0][2]
    while AT_END[state]:
        audit.append("I")
        state = DUE[state]
    return int(least), "".join(audit)


STATS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LEGAL = {"su", "ua", "au"}


def _judge(strings: DataFrame) -> DataFrame:
    types = empty_arrow(strings.sparkSession, StructType.fromDDL(STATS))

    def row(conv: int | None, letters: str, gaps: int) -> tuple:
        initials = "".join(LETTERS[x][0] for x in letters)
        counts = [sum(letters.count(x) for x, (_, f) in LETTERS.items() if f == fault) for fault in FAULTS[1:]]
        illegal = sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))
        return conv, gaps, *counts, illegal, *cheapest_edits(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(*(v.as_py() for v in values)) for values in zip(*batch.columns)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)

    return strings.select("conv_id", "letters", "gaps").mapInArrow(run, STATS)


class Mended:
    """The digest of one mended conversation, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.digest, self.first = hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = DUE[self.state]
            self._put(ROLES[self.state], "")

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[role[0]][self.state]
            self._put(role, text)
        elif edit == "R":
            self.state = DUE[self.state]
            self._put(ROLES[self.state], text)

    def close(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


def _digests(stats: DataFrame, rows: DataFrame) -> DataFrame:
    schema = f"{STATS}, repaired_sha256 string"
    types = empty_arrow(rows.sparkSession, StructType.fromDDL(schema))
    # A conversation's statistics come before its rows.
    heads = stats.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.struct(*stats.columns).alias("stats"))
    both = heads.unionByName(rows.select("conv_id", "pos", "role", "text"), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("pos", "stats", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, current, done = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), types)], schema=types)

        for batch in batches:
            positions, roles = batch.column(0).to_pylist(), batch.column(2)
            stats, texts = batch.column(1), batch.column(3)
            for i, pos in enumerate(positions):
                if pos < 0:
                    if head:
                        done.append((*head, current.close()))
                    head = tuple(stats[i].as_py().values())
                    current = Mended(head[-1])
                else:
                    current.row(roles[i].as_py(), texts[i].as_py())
            if len(done) > 1000:
                yield out()
                done = []
        if head:
            done.append((*head, current.close()))
            yield out()

    return ordered.mapInArrow(run, schema)


def repair(turns: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: faults, cost, audit and digest of the mended turns.

    ``conv_ids`` may name conversations beyond those of ``turns``; they are empty.
    """
    rows = materialize(numbered(turns), "numbered-turns")
    strings = _strings(rows, turns if conv_ids is None else conv_ids)
    return _digests(materialize(_judge(strings), "audits"), rows)
