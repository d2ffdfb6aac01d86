"""op1, op5 and op6 against plain Python over every document."""

import functools
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

from galetrack.llm import language, mixing, simhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def votes(text):
    """What the words give to each of 64 bits."""
    out = [0.0] * 64
    for word, n in Counter(text.split()).items():
        weight, bits = (1 + math.log(n)) * max(len(word) - 1, 0.25), int.from_bytes(xxhash.xxh3_64_digest(word.encode()), "big")
        for i in range(64):
            out[i] += weight if bits >> (63 - i) & 1 else -weight
    return out


def agrees(text, print_):
    """Whether a fingerprint has the sign of every vote that isn't a tie but for rounding."""
    return all((v > 0) == bool(int(print_, 16) >> (63 - i) & 1) for i, v in enumerate(votes(text)) if abs(v) > 1e-3)


def test_simhash_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    extra = [(10_000, ""), (10_001, None), (10_002, "é"), (10_003, "a 𝔟 c"), (10_004, "one word")]
    docs, rows = docs.unionByName(spark.createDataFrame(extra, docs.schema)), [*rows, *((i, t or "") for i, t in extra)]
    alike = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 64
    got = {r["doc_id"]: r for r in simhash.compare_with_next(docs, rows_per_partition=50).collect()}
    assert got.keys() == {i for i, _ in rows}
    for (i, text), (following, other) in zip(rows, [*rows[1:], rows[0]]):
        half, r = len(text) // 2, got[i]
        changed = text[: len(text) - half] + other[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert agrees(text, r["fingerprint"]) and agrees(changed, r["edited_fingerprint"])
        assert r["near_edited"] == alike(r["fingerprint"], r["edited_fingerprint"]) and r["near_next"] == alike(r["fingerprint"], got[following]["fingerprint"])


def test_language_query(spark):
    """Predictions from sums over every segmentation of every word."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = docs.collect()
    path = P.path("piece_bpe_32k.model")
    model = language.train(docs, path, where=F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 != 1, F.lit(True)))
    number = {p: i for i, p in enumerate(language.load_pieces(path))}

    def word(text, p):
        marked = language.START + text

        @functools.cache
        def rest(at):
            if at == len(marked):
                return 1.0
            # The mark and a word's first character stand together where no piece has them.
            lone = at + (2 if at == 0 else 1)
            ends = {e: p[number[marked[at:e]]] for e in range(at + 1, len(marked) + 1) if marked[at:e] in number}
            ends.setdefault(lone, p[-1])
            return sum(q * rest(e) for e, q in ends.items())

        return rest(0)

    found = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in language.predict(docs, path).collect()}
    for r in rows:
        words = [w for w in re.findall(r"[^\W\d_]+", (r["text"] or "").lower())]
        if max(map(len, words), default=0) > 30 or len(words) > 400:
            continue
        logs = [prior + sum(n * math.log(word(w, p)) for w, n in Counter(words).items()) for prior, p in zip(model.priors, model.p)]
        best = max(range(len(logs)), key=logs.__getitem__)
        score = 1 / sum(math.exp(x - logs[best]) for x in logs)
        assert found[r["doc_id"]][:2] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1, model.languages[best])
        assert found[r["doc_id"]][2] == pytest.approx(score, abs=1e-9)


def test_mixing_query(spark):
    """The schedule walked slot by slot, and the words of each block counted one block at a time."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source").limit(300)
    docs = docs.unionByName(spark.createDataFrame([(10**6, None, "a"), (10**6 + 1, "x y", None), (10**6 + 2, "", "zz"), (10**6 + 2, "", "zz")], docs.schema))
    block, weights = 64, (5, 2, 1)
    rows = docs.withColumn("size", mixing.word_count(F.col("text"))).withColumn("h", F.xxhash64("doc_id", "size", F.lit("mix"))).collect()
    size = {(r["doc_id"], i): len(SPACE.findall(r["text"] or "")) for i, r in enumerate(rows)}
    whole = defaultdict(int)
    for i, r in enumerate(rows):
        whole[r["source"]] += size[r["doc_id"], i]
    order = sorted(whole, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    share, left, goals, open_ = dict(zip(order, [weights[k % 3] for k in range(len(order))])), sum(whole.values()), {}, set(order)
    while open_:
        sums = sum(share[s] for s in open_)
        over = {s for s in open_ if left * share[s] / sums > 3 * whole[s]}
        for s in over or open_:
            goals[s] = 3.0 * whole[s] if over else left * share[s] / sums
        left -= sum(goals[s] for s in over)
        open_ = open_ - over if over else set()
    want = {s: round(goals[s]) for s in order}
    blocks = {s: max(1, -(-whole[s] // block)) for s in order}
    need = [want[s] // whole[s] * -(-whole[s] // block) + -(-(want[s] % whole[s]) // block) if whole[s] else 0 for s in order]
    edges, total = [], 0
    for n in need:
        total += n * mixing.CIRCLE // sum(need)
        edges.append(total)
    times, seen, slot = Counter(), [0] * len(order), 0
    while any(a < b for a, b in zip(seen, need)):
        point = slot * mixing.GOLDEN % mixing.CIRCLE
        k = sum(point >= e for e in edges[:-1])
        slot += 1
        rank, s = seen[k], order[k]
        seen[k] += 1
        if rank < need[k]:
            j, end = rank % blocks[s], (rank % blocks[s] + 1) * block
            times[k, j, min(end, want[s] % whole[s]) if rank // blocks[s] == want[s] // whole[s] else end] += 1
    buckets, taken = max(1, len(rows) // 10_000), {}
    for k, s in enumerate(order):
        at = 0
        for i in sorted((i for i, r in enumerate(rows) if r["source"] == s), key=lambda i: (rows[i]["h"] % buckets, rows[i]["h"], rows[i]["doc_id"])):
            n = size[rows[i]["doc_id"], i]
            taken[i] = sum(c * max(0, min(at + n, (j + 1) * block, end) - max(at, j * block)) for (kk, j, end), c in times.items() if kk == k)
            at += n
    got = sorted((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.digest(docs, block=block).collect())
    assert got == sorted((r["doc_id"], size[r["doc_id"], i], whole[r["source"]], round(goals[r["source"]], 6), taken[i]) for i, r in enumerate(rows))
    for s in order:
        assert abs(sum(taken[i] for i, r in enumerate(rows) if r["source"] == s) - goals[s]) <= 1
