"""op13 against scores of all documents, and the treaps against plain searches."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from galetrack.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def found(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    texts = [(i, Counter(found(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    for item, text in items:
        asked, scores = found(text), []
        for i, c in texts:
            m = 75 + (25 * sum(c.values()) * n) // total if total else 75
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if c[t])
            if score > 0:
                scores.append((-score, i is not None, i or 0))
        yield from [(item, r + 1, i if has else None, -s) for r, (s, has, i) in enumerate(sorted(scores)[:k])]


def rows(seed=1):
    rng = np.random.default_rng(seed)
    words = ["Ab", "b2", "c", "dé", "É", "x_y", "the", "THE", "Ω", "zz", *(f"w{i}" for i in range(60))]
    text = lambda n: " ".join(words[min(int(w), len(words)) - 1] for w in rng.zipf(1.3, n))
    docs = [(i, text(int(rng.integers(0, 40)))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "!?"), (None, "b2 c Ω"), (3, docs[3][1]), (503, docs[4][1]), (504, text(3000))]
    items = [(1, text(8)), (2, docs[7][1]), (3, "nothing-here"), (4, None), (5, "the the The c"), (None, "zz w7"), (6, " ".join(words))]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"SHARD_DOCS": 11, "ENTRIES": 64}, {"TERMS": 40, "SHARD_COUNTS": 100}])
def test_against_all_scores(spark, monkeypatch, options):
    for name, value in options.items():
        monkeypatch.setattr(lexical, name, value)
    docs, items = rows()
    table = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    got = lexical.search(table, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(docs, items), key=str)


def test_fewer_and_empty(spark):
    docs, items = rows(2)
    table, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items[:2], "item_id long, text string")
    assert sorted(map(tuple, lexical.search(table, asked, 3).collect()), key=str) == sorted(brute(docs, items[:2], 3), key=str)
    assert lexical.search(table, asked.limit(0)).collect() == []
    assert lexical.search(table.limit(0), asked).collect() == []


def test_treap_ranges():
    rng = np.random.default_rng(4)
    place, impact = np.sort(rng.choice(500, 200, replace=False)), rng.integers(1, 20, 200)
    treaps = lexical.Treaps(np.zeros(200, np.int32), place, impact)
    low, high = rng.integers(-1, 500, 300), rng.integers(0, 501, 300)
    got = treaps.within(np.full(300, treaps.root[0]), low, high)
    for a, z, node in zip(low, high, got):
        inside = impact[(place > a) & (place < z)]
        assert (node < 0 and not len(inside)) or (a < treaps.place[node] < z and treaps.impact[node] == inside.max())


def test_search_leaves_most_ranges():
    """A document that is better by far keeps the search from scoring all others."""
    rng = np.random.default_rng(5)
    term, place = np.repeat(np.arange(4), 2000).astype(np.int32), np.tile(np.arange(2000), 4)
    impact = rng.integers(1, 1000, 8000)
    impact[place == 777] = 10**6
    treaps, looked = lexical.Treaps(term, place, impact), []
    within = treaps.within
    treaps.within = lambda node, low, high: looked.append(len(node)) or within(node, low, high)
    query, at, _ = lexical.best(treaps, [(np.arange(4), np.ones(4, np.int64))], 2000, 1)
    assert at.tolist() == [777] and sum(looked) < 200
