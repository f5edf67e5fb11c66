"""Trie of rebuilt conversations, against plain Python; perfect hash tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rosterflow.llm import prefix_trie
from rosterflow.llm.perfect_hash import SlotTable

SCHEMA = "conv_id long, turn long, role string, text string, depth int, place string, a long"


def expected(rows):
    said = {}
    for conv, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        said.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {}
    for conv, own in said.items():
        base = conv - int(np.fmod(conv, 20))
        h = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(said.get(base, [])[:h] + own[h:])
    nodes = {}
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(conv)
    children = {}
    for prefix in nodes:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(nodes, key=len, reverse=True):
        below = children.get(prefix, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        leaves[prefix] = sum(leaves[c] for c in below) or 1
        saved[prefix] = (len(nodes[prefix]) - 1) * words + sum(saved[c] for c in below)
    out = []
    for prefix, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(prefix))
        parent = min(nodes[prefix[:-1]]) if prefix else None
        out.append((min(members), len(prefix), parent, len(members), len(children.get(prefix, [])), leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def found(spark, rows, shard_nodes):
    got = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(6), shard_nodes)
    assert got.columns == prefix_trie.NODE
    return sorted(map(tuple, got.collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(2)
    out = []
    for conv in [*range(-45, 150), 1000, 1001, 10**12]:
        if conv in (40, 77):
            continue
        for turn in range(chance.randrange(1, 6)):
            first = turn == 0 and chance.random() < 0.5
            out.append((conv, turn, chance.choice(["user", "assistant"]), "hot first turn" if first else " ".join(chance.choices(["yes", "no", "é"], k=chance.randrange(2))), 1, "x", 2))
    for conv in (300, 310, 320):  # one long conversation, three times
        out += [(conv, turn, "user", f"long {turn} text", 0, "", 0) for turn in range(60)]
    for conv in range(500, 560):  # copies
        out += [(conv, turn, "user", f"copy {turn}", 0, "", 0) for turn in range(6)]
    for conv in range(700, 740):  # every one a turn longer than the last
        out += [(conv, turn, "user", f"step {turn} of", 0, "", 0) for turn in range(conv - 698)]
    out += [(400, None, None, None, 0, "", 0), (400, 1, "user", None, 0, "", 0), (400, 2, None, "\x0b two\twords ", 0, "", 0), (None, 1, "user", "lost", 0, "", 0)]
    out += [(600, 1, "user", "twice", 0, "", 0), (600, 1, "user", "twice", 0, "", 0), (601, 0, "user", "word " * 50_000, 0, "", 0)]
    return out


@pytest.mark.parametrize("shard_nodes", [prefix_trie.SHARD_NODES, 9])
def test_nodes_equal_plain_python(spark, rows, shard_nodes):
    assert found(spark, rows, shard_nodes) == expected(rows)


def test_only_turnless_conversations(spark):
    rows = [(c, 0, "user", "x", 0, "", 0) for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    assert found(spark, rows, 5) == expected(rows) == [(rows[0][0], 0, None, len(rows), 0, 1, 0, hashlib.sha256(",".join(str(r[0]) for r in rows).encode()).hexdigest())]


def test_no_rows(spark):
    assert found(spark, [], 5) == []


def test_slots_are_minimal_and_verified():
    chance = np.random.default_rng(1)
    a, b = (chance.integers(-(1 << 62), 1 << 62, 5000) for _ in range(2))
    a[:100] = a[0]  # one half alone does not tell them apart
    table = SlotTable(a, b)
    assert sorted(table.slot) == list(range(5000))
    assert (table.find(a, b) == table.slot).all()
    assert (table.find(a, b + 1) == -1).all()
    assert len(SlotTable(a[:0], b[:0]).find(a, b)) == 5000
    with pytest.raises(ValueError, match="one digest"):
        SlotTable(np.array([1, 1]), np.array([2, 2]))
