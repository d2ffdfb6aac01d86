"""op11 against a dictionary of all beginnings."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from galetrack.llm import conversations


def rebuild(rows):
    """Each conversation's turns as the contract has them."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + ts[h:]
    return out


def nodes(talks):
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    members = defaultdict(list)
    for c, ts in talks.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        children[node[:-1]] += bool(node)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(own) - 1) * (len(node[-1][1].encode()) if node else 0)
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(talks[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        yield min(own), len(node), parent, len(own), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()


def made(seed, n=60, words=("a", "bé", "")):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(1, 14))):
            turn = None if rng.random() < 0.05 else int(rng.integers(0, 6)) if rng.random() < 0.1 else t
            rows.append((c, turn, [None, "user", "user"][rng.integers(3)], words[rng.integers(len(words))] if rng.random() > 0.05 else None))
    return [*rows, *rows[:3], (None, 1, "user", "nobody's"), (2**62 + 5, 0, "user", "a")]


@pytest.mark.parametrize("seed, per_block, words", [(0, 1000, ("a", "bé", "")), (1, 7, ("a", "b")), (2, 2, ("a", "bé", "")), (3, 1, ("a",)), (4, 5, ("a",)), (5, 3, ("a", "b", "c", "d", "e"))])
def test_against_a_dictionary(spark, monkeypatch, seed, per_block, words):
    monkeypatch.setattr(conversations, "CHUNK", 2)
    rows = made(seed, words=words)
    talks = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    got = sorted(map(tuple, conversations.trie(conversations.rebuilt(talks), per_block).collect()), key=str)
    assert got == sorted(nodes(rebuild(rows)), key=str)


def test_few_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    run = lambda rows: sorted(map(tuple, conversations.trie(conversations.rebuilt(spark.createDataFrame(rows, schema))).collect()), key=str)
    assert run([]) == []
    for rows in ([(7, 0, "user", "hm")], [(0, 1, None, None)], [(8, 0, "user", "x"), (9, 0, "user", "x")]):
        assert run(rows) == sorted(nodes(rebuild(rows)), key=str)


def test_sequences_without_rebuilding(spark):
    """Random sequences, so that ranges of all shapes cross borders of blocks."""
    rng = np.random.default_rng(9)
    talks = {int(c): [("user", "ab"[rng.integers(2)] * int(rng.integers(1, 3))) for _ in range(int(rng.integers(0, 9)))] for c in rng.permutation(300)[:150]}
    rows = [(c, [hashlib.sha256(repr(t).encode()).digest() for t in ts], [len(t[1]) for t in ts]) for c, ts in talks.items()]
    made = spark.createDataFrame(rows, "conv_id long, keys array<binary>, bytes array<long>")
    want = sorted(nodes(talks), key=str)
    for per_block in (3, 10):
        assert sorted(map(tuple, conversations.trie(made, per_block).collect()), key=str) == want
