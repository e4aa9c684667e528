"""The prefix trie of conversations (op12) against a dictionary of prefixes, and its edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from kinloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def in_order(rows):
    convs = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [t[-1] for t in sorted(found)] for c, found in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        rest = abs(c) % 100 * (1 if c >= 0 else -1)
        out[c] = convs.get(c - rest, [])[:h] + own[h:]
    return out


def brute_force(convs):
    members = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    own = {k: (len(m) - 1) * (len(k[-1][1]) if k else 0) for k, m in members.items()}
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = children.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) if below else 1
        saved[k] = own[k] + sum(saved[x] for x in below)
    return sorted(
        (
            min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k],
            hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k)))).encode()).hexdigest(),
        )
        for k, m in members.items()
    )


def ours(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2] + (r[2] or 0,) + r[3:])


def key(rows):
    return sorted(rows, key=lambda r: r[:2] + (r[2] or 0,) + r[3:])


def random_rows(seed, conversations):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-150, 1000), conversations):
        for turn in range(draw.choice([1, 2, 3, 4, 5, 9])):
            text = draw.choice(["a", "bb", "é中", "", None]) if draw.random() < 0.9 else f"own {conv} {turn}"
            rows.append((conv, draw.choice([turn, turn, turn, None]), draw.choice(["user", "user", "assistant", None]), text))
    rows += [(2000 + i, t, "user", "same opening") for i in range(60) for t in range(3)]
    rows += [(None, 1, "user", "nobody")] * 3
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, ids", [(16, 12), (3, 2), (0, 0)])
def test_against_brute_force(spark, monkeypatch, block, ids):
    monkeypatch.setattr(trie, "IDS", ids)
    rows = random_rows(block, 200)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", at int, block string")
    convs = in_order(rows)
    assert ours(trie.prefix_trie(trie.rebuilt(frame), block=block)) == key(brute_force(rebuilt(convs)))
    assert ours(trie.prefix_trie(trie.sequences(frame), block=block)) == key(brute_force(convs))


def test_deep_copies_across_blocks(spark):
    """Long sequences that differ at the end only, prefixes of one another, and turnless ones."""
    rows = [(100 + c, t, "user", f"turn {t}") for c in range(12) for t in range(40 + c % 5)]
    rows += [(500, 0, "user", "x" * 300_000), (501, 0, "user", "x" * 300_000), (100, 50, "user", "end")]
    frame, convs = spark.createDataFrame(rows, SCHEMA), in_order(rows)
    for block in (0, 1, 16):
        assert ours(trie.prefix_trie(trie.sequences(frame), block=block)) == key(brute_force(convs))
        assert ours(trie.prefix_trie(trie.rebuilt(frame), block=block)) == key(brute_force(rebuilt(convs)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = trie.prefix_trie(trie.rebuilt(empty))
    assert found.columns == trie.NODES and found.collect() == []


@pytest.mark.parametrize("size", [1, 2, 7, 64, 100])
def test_minima(size):
    draw = np.random.default_rng(size)
    values = draw.integers(0, 5, size)
    table = trie.Minima(values)
    for at in range(size):
        for bound in range(7):
            right = next((r for r in range(at, size - 1) if values[r + 1] < bound), size - 1)
            left = next((low for low in range(at, 0, -1) if values[low] < bound), 0)
            one = np.array([at]), np.array([bound])
            assert (table.right(*one)[0], table.left(*one)[0]) == (right, left)
        high = np.arange(at, size)
        assert table.least(np.full(len(high), at), high).tolist() == [values[at : h + 1].min() for h in high]
