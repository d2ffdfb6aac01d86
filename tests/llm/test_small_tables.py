"""Every operator over null, empty, very long, repeated and no rows, beside clashing columns."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from galetrack.llm import ann, bpe, language, licenses, mixing, omh, ppm, simhash, toxicity, warc

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, row long, id long, uid long, key string, label string, word string, rank int, h long, kept string"


def documents(spark, rows=None):
    base = "the of and to in is that for it as with by on this are the of and to in".split()
    texts = [None, "", "   ", "42 !!", "the cat sat on the mat", "le chat est sur la table", "The CAT sat on the mat"]
    texts += [" ".join(base[i % 7 :] + base[: i % 7]) + f" w{i}" for i in range(12)] + [" ".join(f"word{i % 997}" for i in range(30_000)), "a" * 5000]
    made = [(i, t, "fr" if t and "chat" in t else "en", f"s{i % 3}" if i % 5 else None) for i, t in enumerate(texts)]
    made += [(50, "the cat sat on the mat", "en", "s1"), (50, "the cat sat on the mat", "en", "s1"), (None, "the cat sat", None, None)]
    made = made if rows is None else rows
    return spark.createDataFrame([(*r, 7, 0.5, 9, 1, 2, 3, "k", "l", "w", 4, 5, "x") for r in made], DOCS)


def test_language(spark):
    docs = documents(spark)
    got = language.predict(docs, P.path("piece_bpe_32k.model")).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and by[0]["score"] == 0
    assert all(r["lang_pred"] in ("en", "fr", "und") and 0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert language.predict(documents(spark, []), P.path("piece_bpe_32k.model")).count() == 0


def test_language_of_texts_without_letters(spark):
    """Signs of numbers, marks and scripts beside one another."""
    none = ["½ ² ① 42", "Ⅷ ⅷ ㊿ ٣ 三"[:8], "\u0301 \u0300", "_ 1_2", "𝟙 ➓ ⑳"]
    assert not any(language.words(t) for t in none)
    assert language.words("½abc²Ñé Жук三x_y") == ["abc", "Ñé", "Жук三x", "y"]
    texts = [*none, "the thing in the house", "La casa de los ñandúes", "½ the"]
    docs = spark.createDataFrame([(i, t, "en" if "th" in t else "es", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, P.path("piece_bpe_32k.model")).collect()}
    assert all(got[i] == ("und", 0.0) for i in range(len(none))) and all(got[i][0] != "und" for i in range(len(none), len(texts)))


def test_language_sums_all_segmentations():
    pieces = language.load_pieces(P.path("piece_bpe_32k.model"))
    model = language.Model(["x"], pieces, [0.0], {"x": {i: 1.0 + i % 7 for i in range(len(pieces))}})

    def brute(marked):
        p, ids = model.p[0], model.lattice.ids

        def go(i):
            if i == len(marked):
                return 1.0
            first = 2 if i == 0 else i + 1
            ends = [(j, ids[marked[i:j]]) for j in range(i + 1, len(marked) + 1) if ids.get(marked[i:j], -1) >= 0]
            if not any(j == first for j, _ in ends):
                ends.append((first, len(pieces)))
            return sum(p[k] * go(j) for j, k in ends)

        return math.log(go(0))

    for word in ("the", "straße", "réseaux", "日本", "x"):
        assert model.word(word)[0] == pytest.approx(brute(language.START + word))
        assert model._scaled(model.lattice.arcs(word), len(word) + 1, model.p[0]) == pytest.approx(brute(language.START + word))


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for g in range(25):
        words = [f"w{x}" for x in rng.integers(0, 400, rng.integers(30, 200))]
        for c in range(rng.integers(1, 6)):
            own = list(words)
            for _ in range(c):
                own[rng.integers(0, len(own))] = f"z{rng.integers(0, 10**6)}"
            rows.append((at, " ".join(own), "en", "s"))
            at += 1
    docs = documents(spark, rows)
    h = [omh.labelled(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if omh.aligned(h[i], h[j]) >= omh.LEAST and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    got = {r["doc_id"]: r["class_id"] for r in omh.classes(docs).collect()}
    assert got == {i: find(i) for i in range(len(rows))}
    kept = omh.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_near_duplicates_small(spark):
    docs = documents(spark)
    got = omh.classes(docs).collect()
    by = {r["doc_id"]: r["class_id"] for r in got}
    assert len(got) == docs.count() and by[1] == by[2] == by[0] == 0 and by[50] == 4 and by[5] == 5
    assert omh.deduplicate(docs).count() == len({r["class_id"] for r in got if r["doc_id"] is not None}) + 1
    assert omh.classes(documents(spark, [])).count() == 0


def test_alignment_is_ordered_and_banded():
    a = np.arange(100, dtype=np.uint64)
    assert omh.aligned(a, a, 0.8) == 1.0
    assert omh.aligned(a, np.r_[a[50:], a[:50]], 0.0) == pytest.approx(50 / 150)
    assert omh.aligned(a, np.r_[a[50:], a[:50]], 0.8) == 0.0
    assert omh.aligned(a, a[:80], 0.8) == pytest.approx(0.8)


def test_ann(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 24)).astype("f4")
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(600, None, 1), (601, [0.0] * 24, 1), (602, [float("nan")] * 24, 1), (603, [1.0] * 23, 1), (604, [None] * 24, 1), (605, x[3].tolist(), 1), (606, x[3].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").withColumn("shard", F.lit("x"))
    got = ann.search(df, F.col("vec_id") % 20 == 0, k=5, shard_rows=200).toPandas()
    ids = np.r_[np.arange(600), 605, 606]
    all_ = np.vstack([x, x[3], x[3]]).astype("f8")
    hits = 0
    for q, part in got.groupby("query_id"):
        s = all_ @ all_[ids == q][0]
        best = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:5]
        part = part.sort_values("rank")
        assert part["rank"].tolist() == [1, 2, 3, 4, 5]
        hits += len(set(part["vec_id"]) & set(ids[best]))
    assert set(got["query_id"]) == set(range(0, 600, 20)) and hits / (30 * 5) >= 0.9
    few = ann.search(df.where("vec_id in (0, 3, 605, 606)"), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert len(few) == 3 and ann.search(df.where("vec_id < 0"), F.lit(True)).count() == 0


def test_pigeonhole_finds_every_code():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    index = ann.MultiIndex(codes)
    for radius in (3, 12, 24):
        assert index.within(codes[7], radius).tolist() == np.flatnonzero(ann.distances(codes[7], codes) <= radius).tolist()


def test_toxicity(spark):
    bad, good = "you idiot moron", "the fine weather today"
    rows = [(i, f"{good} number {i} " + (bad if i % 4 == 0 else "and on"), "en", "s") for i in range(400)] + [(1000, None, None, None), (1001, "", "en", "s")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.predict(docs, labels).collect()}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 400]
    assert held and all(r["predicted"] == int(r["doc_id"] % 4 == 0) == int(r["score"] >= 0.5) for r in held)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == 402
    assert {r["score"] for r in toxicity.predict(docs, labels.where("toxic < 0")).collect()} == {0.5}
    assert toxicity.predict(documents(spark, []), labels).count() == 0


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    x = np.round(rng.standard_normal(500), 1)
    ends, means = toxicity.isotonic(x, (rng.random(500) < 1 / (1 + np.exp(-x))).astype(float))
    assert (np.diff(ends) > 0).all() and (np.diff(means) > 0).all() and ends[-1] == x.max()


def test_simhash(spark):
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in simhash.compare_with_next(docs, 4).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    ids, own = sorted(texts), simhash.Fingerprints()
    for i, following in zip(ids, ids[1:] + ids[:1]):
        t, u = texts[i], texts[following]
        changed = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        want = (len(t), hashlib.sha256(changed.encode()).hexdigest(), f"{own.of(t):016x}", simhash.likeness(own.of(t), own.of(u)))
        assert tuple(got[i][c] for c in ("n_chars", "edited_sha256", "fingerprint", "near_next")) == want
    assert got[4]["fingerprint"] == got[50]["fingerprint"]
    assert simhash.compare_with_next(documents(spark)).count() == documents(spark).count()
    assert simhash.compare_with_next(documents(spark, [])).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 7])
def test_block_tables_find_all(spark, radius):
    rng = np.random.default_rng(radius)
    base = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 60)]
    values = base + [b ^ sum(1 << int(k) for k in rng.choice(62, rng.integers(0, 9), replace=False)) for b in base]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "fingerprint long")
    got = {(r["left"], r["right"], r["distance"]) for r in simhash.near_fingerprints(df, radius).collect()}
    kinds, mask = sorted(set(values)), (1 << 64) - 1
    assert got == {(a, b, d) for i, a in enumerate(kinds) for b in kinds[i + 1 :] if (d := ((a ^ b) & mask).bit_count()) <= radius}


def test_mixing(spark):
    docs = documents(spark)
    got = mixing.take(docs, block=64).collect()
    again = mixing.take(docs.repartition(3), block=64).collect()
    key = lambda r: str(tuple(r))
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == docs.count()
    sizes, taken = Counter(), Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    goals = mixing.targets(dict(sizes))
    assert list(goals) == ["s0", "s1", "s2", None]
    assert all(abs(taken[s] - goals[s]) <= 1 for s in goals) and all(r["target"] == goals[r["source"]] and r["source_size"] == sizes[r["source"]] for r in got)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.take(documents(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.take(documents(spark, [(1, None, None, None)])).collect()] == [0]


def test_targets_reshare_the_excess():
    goals = mixing.targets({"a": 10, "b": 1000, "c": 100, None: 0})
    assert goals["a"] == 30 and goals[None] == 0 and goals["c"] == 300 and goals["b"] == 1110 - 330
    assert mixing.targets({}) == {}


def test_licenses(spark):
    mit = licenses.TEMPLATES["mit"]
    pad = " ".join(f"p{i}" for i in range(77))
    rows = [(1, f"{pad} {mit} {pad}", None, None), (2, None, None, None), (3, "", None, None), (4, pad, None, None), (5, mit.replace("merge", "join").upper(), None, None), (6, "Released under the MIT License. " * 3, None, None), (6, "Released under the MIT License. " * 3, None, None), (7, " ".join(mit.split()[:40]), None, None)]
    got = sorted((r["doc_id"], r["license"], r["containment"]) for r in licenses.scan(documents(spark, rows)).collect())
    assert [g[:2] for g in got] == [(1, "mit"), (5, "mit"), (6, "mit-line"), (6, "mit-line")]
    assert got[0][2] == 1.0 and 0.8 <= got[1][2] < 1
    assert licenses.scan(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(documents(spark, rows), templates={"x": "too short"})


def test_warc(spark):
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n"
    rows = [(1, "http://b.org/z?q=1", "same"), (2, "https://www.a.org/x", "same"), (3, None, None), (4, "http://[bad", ""), (5, "http://q\r\n.z", tricky), (6, "http://é.fr/ü", "é" * 20000), (6, "http://é.fr/ü", "é" * 20000), (None, "u", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"row": F.lit(1), "digest": F.lit("d"), "ts": F.lit("t")})
    got = warc.archive(pages).collect()
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got if r["page_id"] != 6)
    assert kinds == [(0, "response", None, 5), (1, "revisit", 2, 4), (2, "response", None, 4), (3, "revisit", 4, 0), (4, "response", None, 0), (5, "response", None, len(tricky))]
    assert sorted(r["record_type"] for r in got if r["page_id"] == 6) == ["response", "revisit"]
    order = [(r["urlkey"], r["ts"]) for r in sorted(got, key=lambda r: (r["range"], r["place"]))]
    assert order == sorted(order)
    assert warc.archive(pages.where("page_id < 0")).count() == 0


def test_warc_against_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), f"http://h{rng.integers(9)}.org/{chr(rng.integers(1, 127))}", f"page {rng.integers(25)}") for i in rng.choice(10**6, 200, replace=False)]
    rows += [(10**13, "http://h1.org/a", "page 1"), (-5, "http://h1.org/b", "page 2"), (10**13 + 1, "http://h1.org/\n", "x" * 200_000)]
    best = {}
    for i, _, html in rows:
        best[html] = max(i, best.get(html, i))
    got = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    want = {(i, len(h.encode()), warc.digest(h.encode()), "response" if best[h] == i else "revisit", None if best[h] == i else best[h]) for i, _, h in rows}
    assert {(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got} == want and len(got) == len(rows)
    order = [(r["urlkey"], r["ts"], r["page_id"]) for r in sorted(got, key=lambda r: (r["range"], r["place"]))]
    assert order == sorted(order)


def test_warc_archives_are_read_once(spark):
    """The merge counts the index's rows, samples its ranges and deals it out, on one reading of the archives."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [(i, f"u{i % 5}", i, 1, "d", "response", None, f"a{i % 3}", i, 1) for i in range(60)]
    index = spark.createDataFrame(rows, warc.INDEX)
    got = warc.merge_indexes(index.mapInArrow(seen, index.schema), rows_per_range=20).collect()
    assert sorted(r["page_id"] for r in got) == list(range(60)) and len({r["range"] for r in got}) > 1
    assert read.value == 60


def test_ann_ties_are_exact(spark):
    """Equal vectors have equal scores wherever they lie, and go by id."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((40, 16))
    rows = [(i, x[i // 3].tolist()) for i in range(120)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=8, shard_rows=16, query_block=2).toPandas()
    for _, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 9))
        assert part.sort_values(["score", "vec_id"], ascending=[False, True])["vec_id"].tolist() == part["vec_id"].tolist()
        for _, same in part.groupby(part["vec_id"] // 3):
            assert same["score"].nunique() == 1


def test_simhash_counts_near_fingerprints(spark):
    docs = documents(spark).where("doc_id is not null").withColumn("doc_id", F.col("doc_id") * 50)
    got = simhash.compare_with_next(docs, 4, queries=F.col("doc_id") % 100 == 0).collect()
    prints = [int(r["fingerprint"], 16) for r in got]
    assert len(got) == docs.count()
    for r in got:
        want = sum((int(r["fingerprint"], 16) ^ p).bit_count() <= 3 for p in prints) if r["doc_id"] % 100 == 0 else None
        assert r["near_count"] == want


def test_loser_tree():
    rng = np.random.default_rng(2)
    for _ in range(100):
        runs = [sorted(rng.integers(0, 30, rng.integers(0, 8)).tolist()) for _ in range(rng.integers(0, 8))]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_ppm(spark):
    docs = documents(spark)
    got = ppm.score_documents(docs).collect()
    rows = docs.collect()
    train = [r["text"] for r in rows if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in ppm.tokens(t))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    want = sorted((r["doc_id"] or -1, len(t := ppm.tokens(r["text"])) + 1, sum(counts[w] > 0 for w in t) + 1, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t) + math.log10((len(train) + 1) / (n + v + 1)), 6)) for r in rows)
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert ppm.score_documents(documents(spark, [])).count() == 0
    # Held-out documents only: nothing is learned.
    lone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = ppm.score_documents(documents(spark, [(lone, "a b", None, None)])).first()
    assert (only["n_known"], only["train_tokens"], only["base_score"]) == (0, 0, 0.0) and math.isfinite(only["score"])


def test_ppm_is_a_distribution():
    data = ppm.stream([b"the", b"then", b"than", b"cat", b"a", b"the", b"cat"], 3)
    found = np.concatenate([c for _, _, c in ppm.full_codes(data, 3)])
    keys, counts = ppm._summed(found, np.ones(len(found), dtype=np.int64))
    every, n = [keys], [counts]
    for o in (2, 1, 0):
        less, c = np.unique((np.int64(o) << ppm.SHIFT) | (every[-1] & ((np.int64(1) << (8 * (o + 1))) - 1)), return_counts=True)
        every.append(less)
        n.append(c)
    trie = ppm.Trie(np.concatenate(every), np.concatenate(n), [0.3, 0.4, 0.5, 0.6], 3)
    for context in (b"\tth", b"the", b"zzz", b"at "):
        held = sum(c << (8 * (3 - i)) for i, c in enumerate(context)) | (3 << ppm.SHIFT)
        total = np.exp(trie.key_logs(np.array([held | b for b in range(256)], dtype=np.int64))).sum()
        assert total == pytest.approx(1)
    assert ppm.adaptive_bits("abcabc" * 50) < 8 * 300 * 0.3 and ppm.adaptive_bits(None) == 0


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = documents(spark)
    odd = [(100, "ΣΑΣ İé é 1②\x1cx\x85y's'LL <|endoftext|>a<|startoftext|>", None, None), (101, "aab" * 700 + " 中文 😀‍", None, None)]
    docs = docs.unionByName(documents(spark, odd))
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append((r["doc_id"] or -1, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, path).collect()) == sorted(want)
    both = bpe.decode(bpe.encode(docs, path), path)
    assert set(docs.columns) < set(both.columns)
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in both.collect())
    assert bpe.digests(documents(spark, []), path).count() == 0


def test_bpe_remembers_frequent_words(monkeypatch):
    """Words that come again and again are encoded once, however many others come between; results don't depend on what is remembered."""
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = bpe.Vocabulary(f.read())
    small, large, encoded = bpe.Encoder(vocabulary, cache_words=50), bpe.Encoder(vocabulary), Counter()
    symbols = small.word_symbols
    monkeypatch.setattr(small, "word_symbols", lambda w: (encoded.update([w]), symbols(w))[1])
    for i in range(1000):
        text = f"often, seldom{''.join('abcdefghij'[int(d)] for d in str(i))} Often"
        assert small.digest(text) == large.digest(text)
    assert encoded["often"] == 1 and len(encoded) == 1002 and len(small.cache) <= 50
