"""Near duplicates by order MinHash.

A text is the sequence of its k-mers (k words), each labelled with its occurrence
number, so that all are distinct. A sketch is made of the ``length`` labelled
k-mers with the smallest hashes, kept in the order of the text; two texts share a
sketch if they share its k-mers in the same order, which is sensitive to edit
similarity, not only to the set. ``sketches`` such sketches are the keys under
which texts meet.

Candidates are verified by banded alignment of their k-mer sequences: with m
k-mers aligned in order, of n1 and n2, the similarity is m / (n1 + n2 - m), an
ordered Jaccard index (1 minus it is a metric). Pairs at or above ``least`` never
leave the diagonals |i - j| <= n1 + n2 - 2 m, which bounds the band. As labelled
k-mers are distinct, the alignment is the longest rising run of positions.

At a similarity of 0.8, a sketch of 4 is shared with probability about 0.4, so 24
sketches miss a pair with probability about 5e-6. Texts of at most ``short``
k-mers don't depend on it: they all take part in the exact search below.

Skew: equal texts (after splitting into words) become one class representative
first, by a minimum, whatever their number. In each key's bucket every text is
compared with the bucket's representative alone, and classes are formed; the
representative is the text whose buckets are the largest, a maximum by key, so
that copies with different edits meet their original. Buckets that then hold one
class are done. The texts of the others, which share a frequent passage or lie
near the threshold, are searched exactly among each other (:func:`unmet`): by
their rarest k-mers, of which a pair at ``least`` must share one, and by the
number of k-mers that no other text has, which such a pair can't have many of.
Pairs of one class aren't formed again. No bucket is collected anywhere.

Defined results: null text is empty text; texts of fewer than k words are one k-mer
of all their words, so they are near duplicates only of equal ones; empty texts
are one class; the class id is the smallest id in it; null ids come last. Extra
columns are ignored by :func:`classes` and kept by :func:`deduplicate`, whatever
their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galetrack.llm.common import importable, map_rows, materialise, release

WORDS, LEAST = 5, 0.8
#: Texts of at most so many k-mers, and partners of theirs, are searched exactly.
SHORT = 24


def labelled(text: str | None, k: int = WORDS) -> np.ndarray:
    """64-bit hashes of the text's k-mers, each with its occurrence number."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "replace"), seed=1)], dtype=np.uint64)
    ids = {w: 0 for w in words}
    for w in ids:
        ids[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
    h = np.fromiter([ids[w] for w in words], dtype=np.uint64, count=len(words))
    n = len(words) - k + 1
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
        order = np.argsort(out, kind="stable")
        ranked = out[order]
        first = np.r_[True, ranked[1:] != ranked[:-1]]
        if not first.all():
            starts = np.flatnonzero(first)
            occurrence = np.empty(n, dtype=np.uint64)
            occurrence[order] = (np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))).astype(np.uint64)
            out = np.where(occurrence > 0, mixed(out ^ (occurrence * np.uint64(0xC2B2AE3D27D4EB4F))), out)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch_keys(h: np.ndarray, sketches: int, length: int) -> list[int]:
    """One signed 64-bit key for each sketch; a text with fewer k-mers uses all."""
    n, take = len(h), min(length, len(h))
    if not take:
        return []
    seeds = (np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[:, None]
    keys = np.arange(sketches, dtype=np.uint64)
    step = max(1, 400_000 // n)
    for s in range(0, sketches, step):
        own = mixed(h[None, :] ^ seeds[s : s + step])
        at = np.sort(np.argpartition(own, take - 1, axis=1)[:, :take], axis=1) if n > take else np.tile(np.arange(n), (len(own), 1))
        picked = np.take_along_axis(own, at, axis=1)
        for c in range(take):
            keys[s : s + step] = mixed(keys[s : s + step] * np.uint64(0x9E3779B97F4A7C15) + picked[:, c])
    return keys.astype(np.int64).tolist()


def aligned(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Similarity of two k-mer sequences by banded alignment; 0.0 if surely below ``least``."""
    n1, n2 = len(a), len(b)
    if not n1 or not n2:
        return float(n1 == n2)
    a, b = a.astype(np.uint64), b.astype(np.uint64)
    # m / (n1 + n2 - m) >= least  <=>  m >= least (n1 + n2) / (1 + least)
    need = least * (n1 + n2) / (1 + least)
    if min(n1, n2) < need - 1e-9:
        return 0.0
    band = n1 + n2 - 2 * need + 1e-9
    order = np.argsort(b, kind="stable")
    at = np.minimum(np.searchsorted(b[order], a), n2 - 1)
    hit = b[order][at] == a
    i, j = np.flatnonzero(hit), order[at[hit]]
    inside = np.abs(i - j) <= band
    j = j[inside]
    if len(j) < need - 1e-9:
        return 0.0
    if len(j) == 0:
        return 0.0
    if (np.diff(j) > 0).all():
        m = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            p = bisect_left(tails, x)
            if p == len(tails):
                tails.append(x)
            else:
                tails[p] = x
        m = len(tails)
    return m / (n1 + n2 - m)


def stage(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """uid, id, text and the whole ``row`` of ``docs``, written once so that uid stays.

    The row is one column, so no name of the input can clash.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = materialise(docs.select(whole).withColumn("uid", F.monotonically_increasing_id()), "omh-documents")
    return rows.select("uid", "row", F.col(f"row.`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit("")).alias("text"))


def sketch(staged: DataFrame, sketches: int, length: int, k: int) -> DataFrame:
    """uid, id, digest (of the words), n (k-mers) and keys of each document."""

    def make():
        release()

        def step(rows):
            found = [labelled(t, k) for t in rows["text"]]
            return {
                "uid": rows["uid"], "id": rows["id"],
                "digest": [xxhash.xxh3_128_digest(" ".join(t.split()).encode("utf-8", "replace")) for t in rows["text"]],
                "n": [len(h) for h in found], "keys": [sketch_keys(h, sketches, length) for h in found],
            }

        return step

    source = staged.select("uid", "id", "text")
    return map_rows(source, "uid long, id long, digest binary, n int, keys array<long>", make)


def verify(pairs: DataFrame, kmers: DataFrame, least: float) -> DataFrame:
    """a, b and sim of pairs (a, b): by the band if at least ``least``, else by all k-mers."""
    left = kmers.select(F.col("digest").alias("a"), F.col("h").alias("ha"))
    right = kmers.select(F.col("digest").alias("b"), F.col("h").alias("hb"))

    def make():
        def step(rows):
            sims = []
            for x, y in zip(rows["ha"], rows["hb"]):
                p, q = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                sims.append(aligned(p, q, least) or aligned(p, q))
            return {"a": rows["a"], "b": rows["b"], "sim": sims}

        return step

    return map_rows(pairs.join(right, "b").join(left, "a").select("a", "b", "ha", "hb"), "a binary, b binary, sim double", make, rows=512)


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for all nodes of edges (a, b).

    Minimum labels spread along edges and are shortened by looking up the label's
    label; every round is a written table. Stars settle in two rounds.
    """
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "omh-edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "omh-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        spread = labels.join(near, "node").select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = spread.join(up, "label").select("node", F.least("label", "above").alias("label"), "old")
        new = materialise(new, "omh-labels")
        labels = new.select("node", "label")
        if new.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def postings(kmers: DataFrame) -> DataFrame:
    """A row (h, digest) for each k-mer of each text."""
    importable(kmers.sparkSession)
    arrow = pa.schema([("h", pa.int64()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for digest, h in zip(b.column(0), b.column(1)):
                h = np.frombuffer(h.as_py(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([digest.as_py()] * len(h), pa.binary())], schema=arrow)

    return kmers.select("digest", "h").mapInArrow(run, "h long, digest binary")


def unmet(texts: DataFrame, kmers: DataFrame, least: float) -> DataFrame:
    """a and b: the pairs of ``texts`` (digest, n, label) of different labels that may
    have a similarity of ``least``. No such pair is left out.

    A pair at ``least`` shares at least that part of either text's k-mers. So texts
    with too many k-mers that no other has can't be in one, and of the n k-mers of a
    text, the rarest first in an order common to all, one of the first
    n - ceil(least n) + 1 is among the partner's first ones too. Where a text shares
    its first common k-mer, it can share no more than that one and those after it.
    """
    rows = postings(kmers.join(texts, "digest", "left_semi"))
    shared = rows.join(rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "h")
    shared = materialise(shared.select("digest", "h", "df"), "omh-shared-kmers")
    part = F.ceil(F.col("n") * F.lit(least) - 1e-9)
    held = shared.groupBy("digest").agg(F.count("*").alias("s")).join(texts, "digest").where(F.col("s") >= part)
    by = Window.partitionBy("digest").orderBy("df", "h")
    first = shared.join(held, "digest").withColumn("r", F.row_number().over(by)).where(F.col("r") <= F.col("s") - part + 1)
    # Of a pair's common k-mers the first stands before all others, so r - 1 of the s are not common.
    first = materialise(first.select("h", "digest", "n", (F.col("s") - F.col("r") + 1).alias("most"), "label"), "omh-rare")
    mixed = first.groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("h")
    first = first.join(mixed, "h", "left_semi")
    other = first.select("h", *[F.col(c).alias(f"o_{c}") for c in ("digest", "n", "most", "label")])
    need = F.lit(least / (1 + least)) * (F.col("n") + F.col("o_n")) - 1e-9
    met = first.join(other, "h").where((F.col("digest") < F.col("o_digest")) & (F.col("label") != F.col("o_label")) & (F.least("most", "o_most") >= need))
    return met.select(F.col("digest").alias("a"), F.col("o_digest").alias("b")).distinct()


def find(staged: DataFrame, sketches: int = 24, length: int = 4, least: float = LEAST, k: int = WORDS, short: int = SHORT) -> DataFrame:
    """uid, id, digest and the class's least (id, uid) of every staged document."""
    prints = materialise(sketch(staged, sketches, length, k), "omh-sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("first")
    nodes = materialise(prints.groupBy("digest").agg(first, F.first("n").alias("n"), F.first("keys").alias("keys")), "omh-nodes")

    rows = nodes.select("digest", F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    shared = materialise(rows.join(counts, "key"), "omh-shared")
    # The most central text of a bucket represents it: the one whose buckets are the largest.
    # An original is in the buckets of all its copies, so most of them meet it at once.
    central = shared.groupBy("digest").agg(F.sum("c").alias("weight"))
    weighed = shared.join(central, "digest").select("key", "digest", "weight")
    heads = weighed.groupBy("key").agg(F.max(F.struct("weight", "digest")).alias("head"))
    members = weighed.join(heads, "key").select("key", "digest", F.col("head.digest").alias("rep"))
    members = materialise(members, "omh-members")
    # A text of n k-mers has partners of at most n / least.
    brief = nodes.where((F.col("n") >= 4) & (F.col("n") <= int(short / least))).select("digest")
    involved = members.select("digest").union(brief).distinct().join(nodes.select("digest", "first.uid"), "digest")
    texts = staged.select("uid", "text").join(involved, "uid").select("digest", "text")

    def make():
        def step(rows):
            return {"digest": rows["digest"], "h": [labelled(t, k).tobytes() for t in rows["text"]]}

        return step

    kmers = materialise(map_rows(texts, "digest binary, h binary", make), "omh-kmers")
    pairs = members.where("digest != rep").select(F.col("rep").alias("a"), F.col("digest").alias("b")).distinct()
    edges = materialise(verify(pairs, kmers, least).where(F.col("sim") >= least).select("a", "b"), "omh-verified")
    labels = components(edges)

    # Buckets that hold several classes, and short texts: exactly.
    seen = members.select("key", "digest").join(labels.withColumnRenamed("node", "digest"), "digest", "left").select("key", "digest", F.coalesce("label", "digest").alias("label"))
    several = seen.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("key")
    left = seen.join(several, "key", "left_semi").select("digest").union(brief).distinct().join(nodes.select("digest", "n"), "digest")
    left = left.join(labels.withColumnRenamed("node", "digest"), "digest", "left").select("digest", "n", F.coalesce("label", "digest").alias("label"))
    left = materialise(left.where("n >= 4"), "omh-open")
    more = materialise(verify(unmet(left, kmers, least), kmers, least).where(F.col("sim") >= least).select("a", "b"), "omh-more")
    if not more.isEmpty():
        labels = components(edges.union(more))

    known = nodes.select("digest", "first").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    known = known.select("digest", "first", F.coalesce("label", "digest").alias("label"))
    heads = known.groupBy("label").agg(F.min("first").alias("head"))
    of = known.join(heads, "label").select("digest", "head")
    return prints.select("uid", "id", "digest").join(of, "digest")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id and class_id (the smallest id of its near duplicates) for each document."""
    staged = stage(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), "doc_id", "text")
    return find(staged, **options).select(F.col("id").alias("doc_id"), F.col("head.id").alias("class_id"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class: the one with the smallest id."""
    staged = stage(docs, doc_id, text)
    kept = find(staged, **options).where(F.col("uid") == F.col("head.uid")).select("uid")
    return staged.join(kept, "uid", "left_semi").select("row.*")
