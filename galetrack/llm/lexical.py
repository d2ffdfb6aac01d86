"""Ranked lexical search by inverted treaps.

Terms are runs of letters, digits and all characters beyond ASCII, with A-Z in lower
case. N documents hold a term at least, L terms in all. A term that df documents hold
weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); it adds w (10^9 tf div (1000 tf + 12 m))
to a document's score for each time the query has it, where m = 75 + (25 n N div L) for
a document of n terms.

Documents are read once, in place: shards of them keep the counts of the queries' terms.
When N, L and every df are known, a shard builds a treap for each term: a search tree by
the document's place and a heap by its impact, so that the root of any subtree is the
greatest impact below it. All treaps of a query are gone through together over ranges of
places: a range is left when the sum of its roots' impacts can't enter the shard's top k;
else it is split at the document of the greatest impact, which is scored. Chunks of
ranges of many queries are handled at once, those of the greatest bounds first. A
shard's best are then ranked with those of all others.

Queries are taken in blocks of at most about ``TERMS`` distinct terms, whose list is
broadcast; each block reads the documents once. A query itself is a row.

Defined results: null text has no terms; a query without terms or hits has no rows;
rows of equal item_id are queries of their own; equal scores go by ascending doc_id, null
first; rows of equal doc_id are documents of their own; null ids count like others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galetrack.llm.common import importable, materialise, received, send

#: Terms of the queries of one block; documents and counts of a shard; entries of ranges handled at once.
TERMS, SHARD_DOCS, SHARD_COUNTS, ENTRIES = 200_000, 4096, 1 << 20, 1 << 18

#: Bytes of terms as they are, A-Z in lower case, all others a space.
_LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_LETTERS).split()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(df: DataFrame, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], fields).schema)


#: n: terms of each document; edges: where each one's counts begin; term, tf: the counts.
SHARDS = "held long, length long, ids array<long>, n binary, edges binary, term binary, tf binary"


def count_terms(docs: DataFrame, index) -> DataFrame:
    """Shards of documents with the counts of the terms in ``index`` (a broadcast)."""
    importable(docs.sparkSession)
    schema = _arrow(docs, SHARDS)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = received(index).get
        ids, n, edges, term, tf = [], [], [0], [], []

        def shard() -> pa.RecordBatch:
            pack = lambda x, kind: zstandard.compress(np.array(x, dtype=kind).tobytes(), 3)
            row = (sum(x > 0 for x in n), sum(n), ids[:], pack(n, np.int64), pack(edges, np.int64), pack(term, np.int32), pack(tf, np.int64))
            ids.clear(), n.clear(), term.clear(), tf.clear()
            edges[:] = [0]
            return _batch([row], schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = text.translate(_LETTERS).split()
                counts = Counter(map(number, found))
                counts.pop(None, None)
                ids.append(doc_id), n.append(len(found))
                term.extend(counts), tf.extend(counts.values()), edges.append(len(term))
                if len(ids) >= SHARD_DOCS or len(term) >= SHARD_COUNTS:
                    yield shard()
        if ids:
            yield shard()

    return source.mapInArrow(run, docs.sparkSession.createDataFrame([], SHARDS).schema)


def _column(body: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(body), dtype=kind)


def document_counts(shards: DataFrame) -> DataFrame:
    """term, df: added up in each task before the shuffle."""
    schema = _arrow(shards, "term int, df long")

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                more = np.bincount(_column(body, np.int32))
                if len(more) > len(total):
                    total, more = more, total
                total[: len(more)] += more
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total).astype(np.int32)), pa.array(total[total > 0])], schema=schema)

    return shards.select("term").mapInArrow(run, shards.sparkSession.createDataFrame([], "term int, df long").schema).groupBy("term").agg(F.sum("df").alias("df"))


class Treaps:
    """The treaps of a shard's terms in common arrays. ``place``: of documents, rising in
    each term; equal impacts are put in a mixed order, so that the trees stay shallow."""

    def __init__(self, term: np.ndarray, place: np.ndarray, impact: np.ndarray):
        by = np.lexsort((place, term))
        self.place, self.impact = place[by], impact[by]
        term = term[by]
        mixed = (np.arange(len(by), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        rank = np.empty(len(by), np.int64)
        rank[np.lexsort((mixed, self.impact))] = np.arange(len(by))
        self.left, self.right = np.full(len(by), -1), np.full(len(by), -1)
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(by) else np.zeros(0, np.int64)
        self.root = dict(zip(term[first].tolist(), self._built(rank.tolist(), first.tolist())))

    def _built(self, rank: list[int], first: list[int]) -> list[int]:
        left, right, roots = self.left.tolist(), self.right.tolist(), []
        for a, z in zip(first, [*first[1:], len(rank)]):
            open_: list[int] = []
            for i in range(a, z):
                last = -1
                while open_ and rank[open_[-1]] < rank[i]:
                    last = open_.pop()
                left[i] = last
                if open_:
                    right[open_[-1]] = i
                open_.append(i)
            roots.append(open_[0])
        self.left, self.right = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
        return roots

    def within(self, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The root of what each subtree has between two places (both exclusive); -1: nothing."""
        out, active = node.copy(), np.flatnonzero(node >= 0)
        while len(active):
            at = out[active]
            place = self.place[at]
            above, below = place >= high[active], place <= low[active]
            move = above | below
            active = active[move]
            out[active] = np.where(above[move], self.left[at[move]], self.right[at[move]])
            active = active[out[active] >= 0]
        return out


def best(treaps: Treaps, queries: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query, place and score of each query's k best documents of a shard.

    ``queries``: for each one the numbers and the weights of its terms.
    """
    width = max((len(t) for t, _ in queries), default=0)
    roots, weights = np.full((len(queries), width), -1), np.zeros((len(queries), width), np.int64)
    for q, (numbers, weight) in enumerate(queries):
        roots[q, : len(numbers)] = [treaps.root.get(t, -1) for t in numbers.tolist()]
        weights[q, : len(weight)] = weight
    least = np.ones(len(queries), np.int64)
    top = (np.zeros(0, np.int64),) * 3
    start = np.arange(len(queries))
    stack = [(start, np.full(len(start), -1), np.full(len(start), documents), roots)] if width else []
    step = max(1, ENTRIES // max(1, width))
    while stack:
        query, low, high, node = stack.pop()
        part = np.where(node >= 0, treaps.impact[node], 0) * weights[query]
        bound = part.sum(axis=1)
        live = np.flatnonzero(bound >= least[query])
        if not len(live):
            continue
        if len(live) > step:  # the greatest bounds are taken first
            live = live[np.argsort(bound[live], kind="stable")]
            cut = len(live) - step
            stack.append(tuple(x[live[:cut]] for x in (query, low, high, node)))
            live = live[cut:]
        query, low, high, node, part = (x[live] for x in (query, low, high, node, part))
        split = treaps.place[node[np.arange(len(live)), part.argmax(axis=1)]]
        flat, wide = node.ravel(), np.repeat(np.arange(len(live)), node.shape[1])
        at = treaps.within(flat, split[wide] - 1, split[wide] + 1).reshape(node.shape)
        score = (np.where(at >= 0, treaps.impact[at], 0) * weights[query]).sum(axis=1)
        top = _cut(*(np.concatenate(c) for c in zip(top, (query, split, score))), k)
        full = np.bincount(top[0], minlength=len(queries)) >= k
        lowest = np.full(len(queries), np.iinfo(np.int64).max)
        np.minimum.at(lowest, top[0], top[2])
        least = np.where(full, np.maximum(lowest, 1), 1)
        left, right = treaps.within(flat, low[wide], split[wide]).reshape(node.shape), treaps.within(flat, split[wide], high[wide]).reshape(node.shape)
        stack.append((np.r_[query, query], np.r_[low, split], np.r_[split, high], np.concatenate([left, right])))
    good = top[2] > 0
    return top[0][good], top[1][good], top[2][good]


def _cut(query: np.ndarray, place: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query: by score, then place."""
    by = np.lexsort((place, -score, query))
    query, place, score = query[by], place[by], score[by]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    return query[rank < k], place[rank < k], score[rank < k]


HITS = "item int, doc_id long, score long"


def rank_block(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """item (its place in ``items``), doc_id and score of the shards' best documents."""
    spark = docs.sparkSession
    asked = [Counter(terms(text)) for _, text in items]
    index = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    shards = materialise(count_terms(docs, send(spark, index)), "lexical-shards")
    total = shards.agg(F.sum("held").alias("n"), F.sum("length").alias("l")).first()
    n, length = total["n"] or 0, total["l"] or 0
    weight = np.zeros(len(index), np.int64)
    for batch in document_counts(shards).toArrow().to_batches():  # a row for each term of the block at most
        for t, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            weight[t] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    numbers = [np.array([index[t] for t in c], dtype=np.int64) for c in asked]
    told = send(spark, [(t, weight[t] * np.array(list(c.values()), dtype=np.int64)) for t, c in zip(numbers, asked)])
    schema = _arrow(docs, HITS)

    def run(batches):
        queries = received(told)
        for batch in batches:
            for ids, size, edges, term, tf in zip(*(batch.column(i).to_pylist() for i in range(5))):
                # Places follow the order of ids, so that ties go to the smaller one.
                order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0))
                place = np.empty(len(ids), np.int64)
                place[order] = np.arange(len(ids))
                m = np.array([75 + 25 * x * n // length if length else 75 for x in _column(size, np.int64).tolist()], dtype=np.int64)
                edge = _column(edges, np.int64)
                doc, tf = np.repeat(np.arange(len(ids)), np.diff(edge)), _column(tf, np.int64)
                treaps = Treaps(_column(term, np.int32), place[doc], 1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
                item, at, score = best(treaps, queries, len(ids), k)
                yield _batch([(i, ids[order[p]], s) for i, p, s in zip(item.tolist(), at.tolist(), score.tolist())], schema)

    return shards.select("ids", "n", "edges", "term", "tf").mapInArrow(run, spark.createDataFrame([], HITS).schema)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = asked.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    blocks = max(1, -(-sizes // TERMS))
    out = None
    for b in range(blocks):
        # A block's queries are few by the bound on their terms.
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        if not mine:
            continue
        hits = rank_block(docs, [tuple(r) for r in mine], k)
        best_first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        ranked = hits.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)], "item int, item_id long")
        ranked = ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
