"""op12 against one dictionary of all strings."""

import hashlib

import numpy as np
import pytest

from galetrack.llm import suffixes

DIR = "/root/testdata/sf0.01"


def brute(texts, length=100):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    seen, out = set(), []
    for doc_id, text in sorted(texts, key=lambda d: (d[0] is not None, d[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            if key in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(key)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return out


def passages(seed=5):
    """Texts made of passages cut at all places near 100 bytes, alone, side by side and within one text."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeéß"), rng.integers(1, 6)))
    base = [" ".join(word() for _ in range(90)) for _ in range(4)]
    texts = []
    for n in (98, 99, 100, 101, 102, 115, 129, 130, 131, 160, 230):
        for _ in range(6):
            b = base[rng.integers(len(base))]
            a = int(rng.integers(0, max(1, len(b) - n)))
            texts.append(" ".join(word() for _ in range(int(rng.integers(0, 25)))) + b[a : a + n] + " ".join(word() for _ in range(int(rng.integers(0, 25)))))
    texts += [base[0], base[0], base[1][:100], base[1][:99], "ab" * 300, "ab" * 80, "x" * 101, "", None, texts[5] + texts[9], "y" * 99, "z" * 100]
    ids = rng.permutation(len(texts)).tolist()
    return list(zip([*ids[:-1], None], texts))


@pytest.mark.parametrize("options", [{}, {"BLOCK": 400, "PIECE": 64, "NAMES": 300, "REPEATS": 100}, {"HOT_BLOCKS": 0, "HOT_TIMES": 0, "BLOCK": 700}, {"HOT_BLOCKS": 3, "HOT_TIMES": 4, "BLOCK": 500}])
def test_against_a_dictionary(spark, monkeypatch, options):
    for name, value in options.items():
        monkeypatch.setattr(suffixes, name, value)
    texts = passages()
    docs = spark.createDataFrame([(i, t, "extra") for i, t in texts], "doc_id long, text string, block string").repartition(3)
    got = sorted(map(tuple, suffixes.digests(docs).collect()), key=str)
    assert got == sorted(brute(texts), key=str)


def test_cover():
    m, cover = suffixes.MODULUS, suffixes.COVER
    assert {(a - b) % m for a in cover for b in cover} == set(range(m)) and suffixes.TUPLE + suffixes.SIDE == suffixes.LENGTH


def test_no_rows(spark):
    assert suffixes.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, suffixes.digests(docs).collect())) == sorted(brute([tuple(r) for r in docs.collect()]))


def test_text_that_remains(spark):
    shared = " ".join(str(n * n) for n in range(30)) + "é"
    rows = [(1, "a" + shared), (2, "b" + shared + "c")]
    kept = dict(map(tuple, suffixes.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert kept == {1: rows[0][1], 2: "bc"}
