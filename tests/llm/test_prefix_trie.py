"""The conversation trie against plain dictionaries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import prefix_trie as pt
from tessera.llm import queries

COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members, kids = defaultdict(set), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
            if d:
                kids[turns[: d - 1]].add(turns[:d])
    below = {}

    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        mine = (len(members[node]) - 1) * words
        below[node] = (sum(below[k][0] for k in kids[node]) or 1, mine + sum(below[k][1] for k in kids[node]))
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(rebuilt[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(kids[node]), *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r[c] for c in COLS) for r in pt.prefix_trie(df, queries.trie_base, queries.trie_head, 3, **kw).collect())


def made(n, seed=4, long=0):
    rng, rows = random.Random(seed), []
    for c in range(n):
        script = rng.choice([None, 1, 2, 3])
        for t in range(rng.randrange(1, 7)):
            text = f"turn {t} of {script} " + "w " * t if script else f"own {c} {rng.randrange(3)}"
            rows.append((c, None if t == 0 and c % 7 == 0 else t, "user" if t % 2 == 0 else None, None if rng.random() < 0.05 else text))
    rows += [(n + 5, t, "user", f"long {t}") for t in range(long)]
    return rows + rows[: 20] + [(None, 1, "user", "nobody's")]


@pytest.mark.parametrize("shard", [pt.SHARD_ROWS, 40, 1])
def test_trie_brute_force(spark, shard):
    rows = made(130)
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    assert got(df, shard_rows=shard) == brute(rows)


def test_long_conversations_go_in_stretches_and_bands(spark, monkeypatch):
    monkeypatch.setattr(pt, "STRETCH", 7)
    monkeypatch.setattr(pt, "BAND", 16)
    monkeypatch.setattr(pt, "ID_BLOCK", 2)
    rows = made(45, long=60)
    assert got(spark.createDataFrame(rows, TURNS), shard_rows=5) == brute(rows)


def test_trie_of_test_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert got(df) == brute([tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in df.collect()])


def test_trie_awkward_rows(spark):
    assert got(spark.createDataFrame([], TURNS)) == []
    only = spark.createDataFrame([(None, 1, "a", "b")], TURNS)
    assert got(only) == []
    # A turnless conversation: one own turn, which the heads it lacks would have replaced.
    c = next(c for c in range(21, 99) if zlib.crc32(str(c).encode()) % 4 == 2 and c % 20)
    rows = [(c, 1, "user", "x")]
    clash = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS c", "2 AS key", "3 AS depth", "4 AS words", "5 AS parent", "6 AS TOP")
    assert got(clash) == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    copies = [(k, t, "user", f"{t} " * 3) for k in range(20, 400) for t in range(5)]
    assert got(spark.createDataFrame(copies, TURNS), shard_rows=10) == brute(copies)
    texts = [(1, 0, "", ""), (1, 1, None, None), (2, 0, "a", "b c " * 50_000), (2, 0, "a", "b c " * 50_000)]
    assert got(spark.createDataFrame(texts, TURNS)) == brute(texts)


def test_findclose_on_random_forests():
    rng = np.random.default_rng(3)
    for n, deep in ((1, 0), (2, 1), (700, 0), (900, 1), (1500, 2)):
        parent = np.array([-1 if k == 0 or rng.random() < 0.01 else (k - 1 if deep == 1 or (deep == 2 and rng.random() < 0.8) else int(rng.integers(0, k))) for k in range(n)])
        bits, order = pt.parentheses(parent)
        tree = pt.Parentheses(bits, 16)
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        assert tree.findclose(tree.opens).tolist() == [want[i] for i in tree.opens.tolist()]
        assert sorted(order.tolist()) == list(range(n))
