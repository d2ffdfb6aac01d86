"""The model of op9 is whole whatever is broadcast: scores equal those of plain dictionaries of everything."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from galetrack.llm import ppm


def rows():
    rng = np.random.default_rng(3)
    stems = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 8))) for _ in range(400)]
    texts = [" ".join(stems[i] for i in np.minimum(rng.zipf(1.4, 60), 400) - 1) for _ in range(40)]
    return list(enumerate([*texts, "an unseen zzz word zzz word zzz word zzz", "", None, "x" * 3000]))


def expected(texts):
    """Scores by plain dictionaries, byte by byte."""
    k, nodes = ppm.ORDER, [{} for _ in range(ppm.ORDER + 1)]
    for i, t in texts:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            data = ppm.stream(ppm.tokens(t))
            for at in range(k, len(data)):
                node = nodes[k].setdefault(data[at - k : at], Counter())
                node[data[at]] += 1
    for o in range(k - 1, -1, -1):
        for p in {q[1:] for context, node in nodes[o + 1].items() for q in [context + bytes([b]) for b in node]}:
            longer = sum(c[1:] == p[:-1] and p[-1] in node for c, node in nodes[o + 1].items())
            nodes[o].setdefault(p[:-1], Counter())[p[-1]] = longer
    discounts = []
    for level in nodes:
        counts = [c for node in level.values() for c in node.values()]
        discounts.append(ppm.discount(counts.count(1), counts.count(2)))

    def log(context, byte):
        out, barred = 0.0, set()
        for o in range(k, -1, -1):
            node = nodes[o].get(context[k - o :])
            if node is None:
                continue
            left = {b: c for b, c in node.items() if b not in barred}
            total = sum(left.values())
            if byte in left:
                return out + math.log((left[byte] - discounts[o]) / total)
            if left:
                out += math.log(discounts[o] * len(left) / total)
            barred |= node.keys()
        return out - math.log(256 - len(barred))

    known = {}
    for i, text in texts:
        data, total = ppm.stream(ppm.tokens(text)), 0.0
        for at in range(k, len(data)):
            key = data[at - k : at + 1]
            if key not in known:
                known[key] = log(key[:-1], key[-1])
            total += known[key]
        yield i, total / math.log(10)


@pytest.mark.parametrize("options", [{}, {"max_entries": 20, "hot_words": 5}])
def test_nothing_is_dropped(spark, options):
    texts = rows()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in ppm.score_documents(docs, **options).collect()}
    assert got == pytest.approx(dict(expected(texts)), abs=1e-6)


def test_pieces_join(spark, monkeypatch):
    texts = [(1, " ".join(f"w{i % 37}" for i in range(500))), (2, None), (3, "w1 w2 w3")]
    data = b"".join(ppm.stream(ppm.tokens(t)) for _, t in texts)
    whole = np.concatenate([c for _, _, c in ppm.full_codes(data)])
    monkeypatch.setattr(ppm, "PIECE", 64)
    assert np.concatenate([c for _, _, c in ppm.full_codes(data)]).tolist() == whole.tolist()
