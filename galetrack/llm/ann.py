"""Nearest vectors by multi-index hashing.

Vectors are turned into binary codes: the signs of a learned rotation (iterative
quantisation on a bounded sample), several rotations for longer codes. A code is
split into substrings and each substring is indexed. By the pigeonhole principle
a code within Hamming distance ``radius`` of a query's agrees with it in some
substring up to ``radius // substrings`` bits, so probing every substring's
buckets within that distance retrieves every such code. What is retrieved and
lies within the radius is ranked again by the exact inner product.

Largest inner product is turned into smallest angle by one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm, which queries have as 0.

The index is dealt into shards of bounded size by a hash of the id (no key can be
hot) and the stated queries into blocks; each task holds one shard and one block,
and only the best of each (query, shard) go on. A substring's buckets are probed by
looking up all values within the distance, or by comparing the shard's own distinct
values where those are fewer. The radius is learned on the sample: the smallest that
holds ``recall`` of the sample's true neighbours. Inner products are added up in the
order of the components, so equal vectors have equal scores wherever they lie.

Defined results: vectors that are null, zero, of another length than the most
frequent, or that hold null or non-finite components take no part; ties go to the
smaller id; a query with fewer candidates returns all; a query that the radius
gives fewer than k takes the nearest codes beyond it; repeated ids are vectors of
their own, except that no row with the query's id is its candidate.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galetrack.llm.common import importable, materialise

SUBSTRING = 16


class Coder:
    """Learned rotations that turn vectors into codes of ``substrings`` 16-bit parts."""

    def __init__(self, sample: np.ndarray, top: float, rotations: int = 2, rounds: int = 20, seed: int = 1):
        self.top = top
        lifted = self.lift(sample)
        self.mean = lifted.mean(axis=0)
        centred = lifted - self.mean
        width = max(SUBSTRING, min(64, -(-centred.shape[1] // SUBSTRING) * SUBSTRING))
        rng = np.random.default_rng(seed)
        # Principal directions; random ones where there are fewer than bits.
        _, _, axes = np.linalg.svd(centred, full_matrices=False)
        basis = axes[:width]
        if len(basis) < width:
            basis = np.vstack([basis, rng.standard_normal((width - len(basis), centred.shape[1])) / np.sqrt(centred.shape[1])])
        projected = centred @ basis.T
        self.maps = []
        for _ in range(rotations):
            turn, _ = np.linalg.qr(rng.standard_normal((width, width)))
            for _ in range(rounds):
                u, _, vt = np.linalg.svd(np.sign(projected @ turn).T @ projected)
                turn = (u @ vt).T
            self.maps.append(basis.T @ turn)
        self.bits = width * rotations

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        scaled = x / self.top
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1 - (scaled**2).sum(axis=1)))
        return np.column_stack([scaled, rest])

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """One row of 16-bit substrings for each vector."""
        centred = self.lift(x, query) - self.mean
        bits = np.concatenate([centred @ m > 0 for m in self.maps], axis=1)
        return np.packbits(bits, axis=1).view(np.uint16)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of one code to many."""
    return np.bitwise_count(b ^ a).sum(axis=1, dtype=np.int64)


def masks(radius: int) -> np.ndarray:
    """All 16-bit values of at most ``radius`` set bits."""
    every = np.arange(1 << SUBSTRING, dtype=np.uint32).astype(np.uint16)
    return every[np.bitwise_count(every) <= radius]


def products(x: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products of rows with a vector, each summed component by component."""
    out = np.zeros(len(x))
    for column, v in zip(x.T, vector):
        out += column * v
    return out


class MultiIndex:
    """The substrings of a shard's codes, each with its buckets."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for part in codes.T:
            order = np.argsort(part, kind="stable")
            values, first = np.unique(part[order], return_index=True)
            self.tables.append((order, values, np.r_[first, len(order)]))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes lie within ``radius``: every one, by pigeonhole probing."""
        near = min(SUBSTRING, radius // len(self.tables))
        probes = masks(near) if sum(math.comb(SUBSTRING, i) for i in range(near + 1)) < len(self.codes) else None
        found = np.zeros(len(self.codes), dtype=bool)
        for part, (order, values, ends) in zip(code, self.tables):
            if probes is not None and len(probes) < len(values):
                wanted = probes ^ part
                at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
                hit = at[values[at] == wanted]
            else:
                hit = np.flatnonzero(np.bitwise_count(values ^ part) <= near)
            if len(hit) == len(values):
                found[:] = True
                break
            sizes = ends[hit + 1] - ends[hit]
            at = np.repeat(ends[hit] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            found[order[at]] = True
        rows = np.flatnonzero(found)
        return rows[distances(code, self.codes[rows]) <= radius]


def learn(sample: np.ndarray, top: float, k: int, recall: float, probes: int = 200) -> tuple[Coder, int]:
    """A coder and the radius that holds ``recall`` of the sample's true neighbours."""
    coder = Coder(sample, top)
    codes, found = coder.codes(sample), []
    step = max(1, len(sample) // probes)
    for i in range(0, len(sample), step):
        score = sample @ sample[i]
        score[i] = -np.inf
        best = np.argsort(-score, kind="stable")[: min(k, len(sample) - 1)]
        own = coder.codes(sample[i : i + 1], query=True)[0]
        found.append(distances(own, codes[best]))
    flat = np.concatenate(found) if found else np.array([], dtype=np.int64)
    return coder, int(np.quantile(flat, recall)) if len(flat) else coder.bits


def best_in_shard(coder: Coder, radius: int, k: int, ids: np.ndarray, x: np.ndarray, index: MultiIndex, query_ids: np.ndarray, q: np.ndarray) -> list[tuple[int, int, float]]:
    """The k best of a shard for each query: (query_id, vec_id, score)."""
    out = []
    for query_id, vector, code in zip(query_ids, q, coder.codes(q, query=True)):
        rows = index.within(code, radius)
        rows = rows[ids[rows] != query_id]
        if len(rows) < k:
            others = np.flatnonzero(ids != query_id)
            rows = others[np.argsort(distances(code, index.codes[others]), kind="stable")[:k]]
        score = products(x[rows], vector)
        order = np.lexsort((ids[rows], -score))[:k]
        out += [(int(query_id), int(ids[r]), float(s)) for r, s in zip(rows[order], score[order])]
    return out


def valid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x (array<double>) of the rows that take part."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null and size(x) > 0")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(finite & F.exists("x", lambda v: v != 0))
    return rows


def search(vectors: DataFrame, queries: Column, k: int = 20, sample_rows: int = 4096, recall: float = 0.97, shard_rows: int = 8192, query_block: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score: each query row's k nearest other vectors.

    ``queries`` is a condition on vec_id. ``sample_rows`` bounds what is learned
    from; every row is indexed. A task holds about ``shard_rows`` vectors and
    ``query_block`` queries; work and shuffle grow with queries times vectors.
    """
    spark = vectors.sparkSession
    importable(spark)
    empty = "query_id long, rank int, vec_id long, score double"
    rows = materialise(valid(vectors), "vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], empty)
    rows = rows.where(F.size("x") == sizes["d"])
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    top = rows.agg(F.max(norm)).first()[0]
    share = min(1.0, sample_rows / sizes["n"])
    cut = (1 << 63) - 1 if share == 1 else int(-(1 << 63) + share * (1 << 64))
    picked = rows.withColumn("h", F.xxhash64("vec_id", F.lit("sample"))).where(F.col("h") <= cut).orderBy("h", "vec_id").limit(2 * sample_rows)
    coder, radius = learn(np.array([r["x"] for r in picked.select("x").collect()]), top, k, recall)
    held = spark.sparkContext.broadcast((coder, radius))

    shards = max(1, -(-sizes["n"] // shard_rows))
    wanted = rows.where(queries)
    blocks = max(1, -(-wanted.count() // query_block))
    shard, block = F.pmod(F.xxhash64("vec_id", "x"), F.lit(shards)).cast("int"), F.pmod(F.xxhash64("vec_id", "x", F.lit("block")), F.lit(blocks)).cast("int")
    indexed = rows.select("vec_id", "x", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = wanted.select("vec_id", "x", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"))

    def probe(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        coder, radius = held.value
        out: list[tuple] = []
        if len(index) and len(asked):
            ids, x = index["vec_id"].to_numpy(), np.stack(index["x"].to_numpy())
            built = MultiIndex(coder.codes(x))
            out = best_in_shard(coder, radius, k, ids, x, built, asked["vec_id"].to_numpy(), np.stack(asked["x"].to_numpy()))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    key = ("shard", "block")
    found = indexed.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(probe, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
