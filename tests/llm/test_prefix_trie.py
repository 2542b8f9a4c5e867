"""Prefix trie of conversations against brute force."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from labelkiln.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, n long, pos long, conv string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)


def brute(rows, graft=True):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v, key=lambda r: r[:2])] for c, v in by.items()}
    path = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:] if graft else turns
    members, ends = {}, {}
    for c, turns in path.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        told = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), len(leaves), saved,
                    hashlib.sha256(told.encode()).hexdigest()))
    return sorted(out, key=str)


def grafted(spark, rows):
    c = F.col("conv")
    turns = P.number_turns(frame(spark, rows))
    return sorted((tuple(r) for r in P.prefix_trie(*P.graft(turns, c - c % 100, F.crc32(c.cast("string")) % 6, 5)).collect()),
                  key=str)


def some(seed, convs, longest, kinds=2):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"][:kinds]), r.choice(["a", "bc", "déf"][:kinds]))
            for c in convs for t in range(r.randrange(1, longest))]


def test_nodes(spark):
    rows = some(1, [*range(0, 60), *range(95, 130), *range(1020, 1030), 5000, 5001], 7)
    assert grafted(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, "user", "first"), (1, 0, None, None), (1, 3, "user", ""), (2, 0, "user", "only"),
            (300, 5, "user", "y"), (300, 9, "user", "z"), (302, 5, "user", "y"), (-7, 0, "user", "minus"), (0, 0, "user", "0")]
    assert grafted(spark, rows) == brute(rows)
    assert grafted(spark, []) == []


def test_repeated_rows_are_turns(spark):
    rows = [(100, 1, "user", "a")] * 3 + [(100, 2, "user", "b")]
    assert grafted(spark, rows) == brute(rows)


def test_long_conversations_and_shards(spark, monkeypatch):
    """Bands of positions and shards of ids give the same trie."""
    monkeypatch.setattr(P, "RANGE_BITS", 2)
    long = [("user" if t % 2 else "assistant", "xy"[: t % 3]) for t in range(200)]
    rows = [(c, t, *long[t]) for c, n in ((0, 200), (1, 130), (5, 128), (9, 128), (3000, 64), (3100, 65)) for t in range(n)]
    rows += [(c, t, "user", "other" if t == 100 else long[t][1]) for c in (7, 8) for t in range(140)]
    turns = P.number_turns(frame(spark, rows))
    got = sorted((tuple(r) for r in P.prefix_trie(turns, turns.select("conv").distinct()).collect()), key=str)
    assert got == brute(rows, graft=False)


@pytest.mark.parametrize("n", [1, 300])
def test_one_common_conversation(spark, n):
    rows = [(c, t, "user", "same") for c in range(n) for t in range(3)]
    turns = P.number_turns(frame(spark, rows))
    got = sorted((tuple(r) for r in P.prefix_trie(turns, turns.select("conv").distinct()).collect()), key=str)
    assert got == brute(rows, graft=False)
