import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tickflow.llm import conversation_trie as trie
from tickflow.llm.conversation_trie import SketchSize, count_min, numbered_turns, prefix_trie, with_family_heads

SCHEMA = "conv_id long, turn long, role string, text string, d long, n long, da long, conv long, rep long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, 5, 5, 5, 5) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = (*own.get(c - c % 5, [])[:h], *turns[h:])
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, at in members.items():
        if node:
            children[node[:-1]] += 1
        ends = [c for c in at if paths[c] == node]
        for k in range(len(node) + 1):
            leaves[node[:k]] += len(ends) == len(at)
            saved[node[:k]] += (len(at) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, at in members.items():
        ends = ",".join(str(c) for c in at if paths[c] == node)
        parent = members[node[:-1]][0] if node else None
        out.append(
            (at[0], len(node), parent, len(at), children[node], leaves[node], saved[node])
            + (hashlib.sha256(ends.encode()).hexdigest(),)
        )
    return sorted(out, key=str)


def nodes(df, size=SketchSize()):
    return sorted(map(tuple, prefix_trie(*with_family_heads(numbered_turns(df), 5, 9), size).collect()), key=str)


def family_rows(seed, n):
    """Conversations over few words, so that many start alike at all depths."""
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        if pick.random() < 0.9:
            rows += [(c, k, pick.choice("ua"), pick.choice(["hi", "yes", "é"])) for k in range(pick.randrange(1, 7))]
    return rows


def test_against_brute_force(spark):
    rows = family_rows(1, 300)
    assert nodes(frame(spark, rows)) == brute(rows)


def test_estimates_that_prove_nothing(spark, monkeypatch):
    """A full sketch sends every prefix to exact grouping; the nodes stay the same."""
    rows = family_rows(2, 90)
    full = np.full((3, 1 << 13), 255, dtype=np.uint8)
    monkeypatch.setattr(trie, "count_min", lambda *_: full)
    assert nodes(frame(spark, rows)) == brute(rows)


def test_count_min_proves_singletons(spark):
    """No shared digest is estimated at one; nearly all others are."""
    df = spark.createDataFrame([(i % 700, -i % 700) for i in range(900)], "da long, db long").repartition(5)
    size = SketchSize(rows=2, least=1 << 15, most=1 << 15)
    bits = count_min(df, size, 1 << 15)
    twice = set()
    for i in range(700):
        da, db = np.array([i]), np.array([-i % 700])
        slots = [int(trie._slots(da, db, row, 1 << 15)[0]) for row in range(2)]
        if all(bits[row, s >> 3] >> (s & 7) & 1 for row, s in enumerate(slots)):
            twice.add(i)
    assert set(range(200)) <= twice and len(twice) < 210


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (5, None, None, None), (5, 1, "u", "x" * 100_000), (5, 1, "a", "y"), (5, 1, "a", "y"),
        (6, 0, "u", ""), (7, None, "", ""), (8, 3, "u", "é\0"), (8, 2, None, "é"),
        (None, 1, "u", "no id"), (13, 1, "u", "late"), (14, 1, "u", "late"), (2**62, 1, "u", "far"),
    ]
    assert nodes(frame(spark, rows)) == brute(rows)


def test_hot_end_spans_partitions(spark):
    """Many conversations end at one node; their ids are hashed in order."""
    rows = [(5 * i, 0, "u", "same") for i in range(4000)]
    assert nodes(frame(spark, rows).repartition(7)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "x")]])
def test_no_conversations(spark, rows):
    assert nodes(frame(spark, rows)) == []


def test_all_turnless(spark):
    """Where h spares all turns and the family's first is absent, only the root is left."""
    lone = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:3]
    rows = [(c, 0, "u", "gone") for c in lone]
    assert nodes(frame(spark, rows)) == brute(rows) and len(brute(rows)) == 1
