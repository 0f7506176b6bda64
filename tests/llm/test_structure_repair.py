"""Conversation repair against a plain version that tries all lists of edits."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

from campuslake.llm import queries, structure_repair

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_damage(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_edits(rows: list[tuple[str, str, str]]) -> tuple[int, str, tuple]:
    """(cost, audit, mended rows): the least of all lists of edits, whole lists kept for each row and role before it."""
    due = {"": "us", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    end = {"": (0, "", ()), "a": (0, "", ())}
    best: dict = {}
    for i in range(len(rows), -1, -1):
        now = dict(end) if i == len(rows) else {}
        if i < len(rows):
            role, text, fault = rows[i]
            for state in due:
                options = [(2, "D", state, ())]
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault == "truncated" else 0
                    if role[:1] and role[:1] in due[state]:
                        options.append((more, "K", role[0], (f"{role}:{text}",)))
                    options += [(1 + more, "R", new, (f"{names[new]}:{text}",)) for new in due[state] if new in names]
                found = [
                    (cost + best[new][0], letter + best[new][1], put + best[new][2])
                    for cost, letter, new, put in options if new in best
                ]
                if found:
                    now[state] = min(found, key=lambda f: f[:2])
        for _ in range(4):  # inserts in a row
            for state in due:
                for new in due[state]:
                    if new in names and new in now:
                        one = (5 + now[new][0], "I" + now[new][1], (f"{names[new]}:",) + now[new][2])
                        now[state] = min(now.get(state, one), one, key=lambda f: f[:2])
        best = now
    return best[""]


def plain_repair(rows: list[tuple], conv_ids) -> list[tuple]:
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn, role, text))
    out = []
    for conv in conv_ids:
        own = sorted(convs[conv], key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        seen, judged = set(), []
        for _, _, role, text in own:
            body = text.rstrip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            judged.append((role, text, fault))
            seen.add((role, text))
        turns = [t for known, t, *_ in own if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [sum(f == name for *_, f in judged) for name in ("blank", "duplicate", "truncated")]
        initials = [role[:1] for role, *_ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, mended = plain_edits(judged)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(mended).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def collected(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select(COLUMNS).collect()), key=repr)


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = collected(queries.queries()["op12_structure_repair"](spark, sf_dir))
    assert got == plain_repair(plain_damage(rows), {r[0] for r in rows})


def test_hard_rows(spark):
    rows = [
        (1, 0, "system", "be kind."), (1, 1, "user", "hi!"), (1, 2, "assistant", "hello. \t\u000b"), (1, 2, "assistant", "hello. \t\u000b"),
        (2, None, None, None), (2, None, "user", "a"), (3, 5, "", "b."), (3, 9, "tool", "c?"), (3, 9, "ua", "c?"),
        (4, 0, "assistant", "x" * 200_000 + "."), (4, 1, "system", "late."), (4, 7, "user", "q "), (4, 7, "user", "q.\n"),
        (None, 0, "user", "no one?"), (None, 1, "assistant", "nobody."), (5, 0, "user", ""), (5, 1, "assistant", "\n"),
    ]
    schema = "conv_id long, turn long, role string, text string, letter string, pos int"
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], schema)
    assert collected(structure_repair.repair(frame)) == plain_repair(
        [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], {r[0] for r in rows}
    )
    named = spark.createDataFrame([(7,), (1,)], "conv_id long")
    empty = hashlib.sha256(b"").hexdigest()
    assert collected(structure_repair.repair(frame.where("false"), named)) == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in (1, 7)]
    assert structure_repair.repair(frame.where("false")).count() == 0
    harmed = structure_repair.damage(frame)
    assert sorted(map(tuple, harmed.collect()), key=repr) == sorted(plain_damage(rows), key=repr)


def test_one_conversation_over_many_tasks(spark):
    random = np.random.default_rng(2)
    roles, texts = ["system", "user", "assistant", "tool"], ["a.", "b", "", "c!", "d?", "e"]
    rows = [(9, int(random.integers(0, 500)), roles[random.integers(0, 4)], texts[random.integers(0, 6)] * int(random.integers(1, 30))) for _ in range(900)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert collected(structure_repair.repair(frame)) == plain_repair(rows, [9])


def test_cheapest_edits_of_all_short_strings():
    random = np.random.default_rng(4)
    letters = sorted(structure_repair.LETTERS)
    for n in (0, 1, 2, 3, 5, 9, 30):
        for _ in range(150):
            own = "".join(random.choice(letters, n))
            rows = [({"s": "system", "u": "user", "a": "assistant", "-": "-"}[i], "t", f) for i, f in map(structure_repair.LETTERS.get, own)]
            assert structure_repair.cheapest_edits(own) == plain_edits(rows)[:2]
