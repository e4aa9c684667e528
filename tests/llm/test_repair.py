"""Conversation repair (op11) against a plain row-by-row search, and its edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from kinloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def least(rows):
    """(cost, audit, turns) over (initial, lost, cut) rows by trying every edit."""
    following = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    @lru_cache(maxsize=None)
    def search(i, state, inserted):
        role = following[state]
        out = []
        if inserted < 2:
            cost, audit, turns = search(i, role[0], inserted + 1)
            out.append((2 + cost, "I" + audit, ((role, ""), *turns)))
        if i == len(rows):
            return min([*out, (0, "", ())] if state in ("", "a") else out, default=(10**9, "", ()))
        name, text, lost, cut = rows[i]
        cost, audit, turns = search(i + 1, state, 0)
        out.append((3 + cost, "D" + audit, turns))
        if not lost:
            first = name[:1]
            if first and (first == "s" and state == "" or first == "u" and state != "u" or first == "a" and state == "u"):
                cost, audit, turns = search(i + 1, first, 0)
                out.append((cut + cost, "K" + audit, ((name, text), *turns)))
            cost, audit, turns = search(i + 1, role[0], 0)
            out.append((2 + cut + cost, "R" + audit, ((role, text), *turns)))
        return min(out)

    return search(0, "", 0)


def brute_force(rows):
    """Results by conv_id of whole tables of (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        found = convs.setdefault(conv, [])
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        found += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, found in convs.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        faults, seen = [], set()
        for _, role, text in found:
            end = text.rstrip(BLANKS)
            fault = "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else ""
            faults.append(fault)
            seen.add((role, text))
        turns = [t for t, _, _ in found if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(found, found[1:], strict=False)]
        plan = tuple((r, t, f in ("b", "d"), int(f == "t")) for (_, r, t), f in zip(found, faults, strict=True))
        cost, audit, repaired = least(plan)
        joined = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(joined.encode()).hexdigest(), repaired,
        )
    return out


def ours(spark, rows):
    frame = repair.damaged(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", copies int, head string"))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = {r.conv_id: tuple(r[n] for n in names) for r in repair.repair_digests(frame).collect()}
    turns = {}
    for r in sorted(repair.repaired(frame).collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    return {c: (*v, tuple(turns.get(c, ()))) for c, v in found.items()}


def random_rows(seed, conversations):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Ünder"]
    texts = ["Yes.", "No", "no end, ", "", " \t", None, "A?", "B! \n", "c.c", "é.", "…"]
    rows = []
    for conv in [*range(conversations), None]:
        turn = 0
        for _ in range(draw.randrange(9)):
            turn += draw.choice([0, 1, 1, 1, 3])
            rows.append((conv, draw.choice([turn, turn, turn, None]), draw.choice(roles), draw.choice(texts)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [12, 1])
def test_against_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = random_rows(3, 250)
    assert ours(spark, rows) == brute_force(rows)


def test_runs_equal_rows():
    draw = random.Random(1)
    for _ in range(300):
        symbols = [draw.choice([1, 3, 4, 6, 8, 9, 10]) for _ in range(draw.randrange(1, 4)) for _ in range(draw.randrange(1, 200))]
        whole = repair.solve([(s, 1) for s in symbols])
        runs = []
        for s in symbols:
            runs = [*runs[:-1], (s, runs[-1][1] + 1)] if runs and runs[-1][0] == s else [*runs, (s, 1)]
        assert repair.solve(runs) == whole


def test_long_conversation_and_repeats(spark):
    """One conversation with most rows, long runs, a very long text and many equal rows."""
    rows = [(7, t, "user" if t % 3 else "assistant", "same." if t < 90 else f"text {t}.") for t in range(150)]
    rows += [(8, 5, "user", "x." * 500_000)] + [(9, 1, "user", "twice")] * 40
    assert ours(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert ours(spark, []) == {}
