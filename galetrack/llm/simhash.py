"""Document fingerprints by SimHash, and all pairs within a Hamming radius.

Each distinct word of a text votes on 64 signed bits with its hash; its weight is
``(1 + ln(count)) * (characters - 1)``, so that frequent short words, which all
texts share, hardly count. A bit is set where the votes are above zero.

Permuted block tables find all fingerprints within a radius r: the 64 bits are
cut into ``blocks`` (more than r) blocks, and fingerprints that differ in at most
r bits agree on some ``blocks - r`` of them. For every such choice there is a
table keyed by the chosen blocks; a table's pairs are verified by their exact
distance. Equal fingerprints are first reduced to one.

Defined results: null text is empty text; a text without words has fingerprint 0;
likeness is 1 - distance / 64, so two empty texts have likeness 1. Equal texts
have equal fingerprints. Rows with equal ids are ordered by a hash of their text.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galetrack.llm.common import importable, map_rows, materialise, per_worker

BITS = 64


class Fingerprints:
    """Fingerprints of texts, with a cache of words' signed bits; one per Python worker."""

    def __init__(self, cache_words: int = 200_000):
        self.limit = cache_words
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.signs = np.zeros((1024, BITS), dtype=np.float32)

    def add(self, word: str) -> int:
        at = len(self.index)
        if at == len(self.signs):
            self.signs = np.concatenate([self.signs, np.zeros_like(self.signs)])
        digest = np.frombuffer(xxhash.xxh3_64_digest(word.encode("utf-8", "replace")), dtype=np.uint8)
        self.signs[at] = np.unpackbits(digest) * np.float32(2) - np.float32(1)
        self.index[word] = at
        return at

    def of(self, text: str | None) -> int:
        counts = Counter((text or "").split())
        if not counts:
            return 0
        if len(self.index) + len(counts) > self.limit:
            self.reset()
        if len(counts) > self.limit:
            return self._in_parts(counts)
        index, add = self.index, self.add
        at = [index[w] if w in index else add(w) for w in counts]
        return self._bits(self._weights(counts) @ self.signs[at])

    def _in_parts(self, counts: Counter) -> int:
        votes, items = np.zeros(BITS, dtype=np.float32), iter(counts.items())
        while part := dict(itertools.islice(items, self.limit // 2)):
            self.reset()
            votes += self._weights(part) @ self.signs[[self.add(w) for w in part]]
        return self._bits(votes)

    @staticmethod
    def _weights(counts: dict[str, int]) -> np.ndarray:
        tf = np.fromiter(counts.values(), dtype=np.float32, count=len(counts))
        size = np.fromiter(map(len, counts), dtype=np.float32, count=len(counts))
        return (1 + np.log(tf)) * np.maximum(size - 1, np.float32(0.25))

    @staticmethod
    def _bits(votes: np.ndarray) -> int:
        return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    return 1 - (a ^ b).bit_count() / BITS


def fingerprint(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``fingerprint`` (signed 64-bit long) for each row."""
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def make():
        prints = per_worker("simhash", Fingerprints)

        def step(rows):
            found = [prints.of(t) for t in rows["__text"]]
            return {c: rows[c] for c in keep} | {"fingerprint": [f - (1 << 64) if f >> 63 else f for f in found]}

        return step

    return map_rows(source, fields + ", fingerprint long", make)


def tables(radius: int, blocks: int | None = None) -> list[tuple[int, ...]]:
    """Which blocks key each permuted table: every choice of ``blocks - radius``."""
    blocks = radius + 2 if blocks is None else blocks
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("radius must be at least 0 and below the number of blocks, at most 64")
    return list(itertools.combinations(range(blocks), blocks - radius))


def block_masks(blocks: int) -> list[int]:
    """Bit masks of ``blocks`` nearly equal blocks."""
    ends = [round(BITS * i / blocks) for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(ends)]


def near_fingerprints(prints: DataFrame, radius: int = 3, blocks: int | None = None, column: str = "fingerprint") -> DataFrame:
    """All pairs of distinct fingerprints within ``radius``: left < right, distance.

    Documents join back by their fingerprint, so copies are never paired. A
    bucket holds only fingerprints that agree on about ``64 * (blocks - radius)
    / blocks`` bits; it is joined by key, and skewed keys are split by AQE.
    """
    blocks = radius + 2 if blocks is None else blocks
    masks = block_masks(blocks)
    keys = []
    for t, chosen in enumerate(tables(radius, blocks)):
        mask = sum(masks[b] for b in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(signed)).alias("key")))
    distinct = prints.select(F.col(f"`{column}`").alias("fp")).where("fp is not null").distinct()
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.table", "k.key")
    left, right = rows.withColumnRenamed("fp", "left"), rows.withColumnRenamed("fp", "right")
    pairs = left.join(right, ["table", "key"]).where(F.col("left") < F.col("right"))
    distance = F.bit_count(F.col("left").bitwiseXOR(F.col("right"))).cast("int")
    return pairs.select("left", "right", distance.alias("distance")).where(F.col("distance") <= radius).distinct()


def count_near(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """fingerprint and near_count of each query: how many rows of ``prints`` lie within ``radius``.

    Both have a signed column ``fingerprint``. Equal ones are counted first; queries
    meet the rest through the permuted block tables.
    """
    blocks = radius + 2 if blocks is None else blocks
    masks, keys = block_masks(blocks), []
    for t, chosen in enumerate(tables(radius, blocks)):
        mask = sum(masks[b] for b in chosen)
        keys.append(F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("key")))
    explode = F.explode(F.array(*keys)).alias("k")
    held = prints.where("fingerprint is not null").groupBy(F.col("fingerprint").alias("fp")).agg(F.count("*").alias("n"))
    held = held.select("fp", "n", explode).select("fp", "n", "k.table", "k.key")
    asked = queries.where("fingerprint is not null").select(F.col("fingerprint").alias("fp")).distinct()
    asked = asked.select("fp", explode).select(F.col("fp").alias("q"), "k.table", "k.key")
    met = asked.join(held, ["table", "key"]).where(F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius)
    return met.select("q", "fp", "n").distinct().groupBy(F.col("q").alias("fingerprint")).agg(F.sum("n").alias("near_count"))


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


def _row(prints: Fingerprints, doc_id, text: str, following: str, own: int, other: int):
    changed = edited(text, following)
    after = prints.of(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
    return (doc_id, len(text), digest, f"{own:016x}", f"{after:016x}", likeness(own, after), likeness(own, other))


SUCCESSOR_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, part int, edge string, text string"
)


def compare_with_next(docs: DataFrame, rows_per_partition: int = 8192, queries=None, radius: int = 3) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    Documents are dealt by ranges of the id (and a hash of the text, so that one id
    of very many rows is split) and sorted, so that a document's successor is the
    next row of the stream. Only the two ends of a partition wait: its last row is
    joined with the first one of the next partition by the partitions' numbers.

    ``queries`` is a condition on doc_id: documents that meet it also get
    ``near_count``, the number of documents whose fingerprint lies within
    ``radius`` (their own included), found through the permuted block tables; it is
    null for the others.
    """
    spark = docs.sparkSession
    importable(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = source.count()
    parts = max(1, -(-count // rows_per_partition))
    dealt = source.withColumn("h", F.xxhash64("text"))
    order = (F.col("doc_id").asc_nulls_first(), F.col("h"))
    dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    schema = spark.createDataFrame([], SUCCESSOR_SCHEMA).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        prints = per_worker("simhash", Fingerprints)
        part = TaskContext.get().partitionId()
        before = None  # (doc_id, text, fingerprint)
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * len(arrow)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
            out.clear()
            return made

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = prints.of(text)
                if before is None:
                    out.append((doc_id, None, None, f"{own:016x}", None, None, None, part, "first", text))
                else:
                    out.append((*_row(prints, before[0], before[1], text, before[2], own), part, None, None))
                before = (doc_id, text, own)
                if len(out) >= 1024:
                    yield batch()
        if before is not None:
            out.append((before[0], None, None, f"{before[2]:016x}", None, None, None, part, "last", before[1]))
        yield batch()

    found = materialise(dealt.mapInArrow(run, schema), "fingerprints")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    inner = found.where("edge is null").select(*columns)
    rows = inner.unionByName(_ends(found.where("edge is not null")).select(*columns))
    if queries is None:
        return rows
    # Every document's own fingerprint: all rows but the marks of first rows, which stand twice.
    signed = F.conv("fingerprint", 16, -10).cast("long").alias("fingerprint")
    own = found.where("edge is null or edge = 'last'").select("doc_id", signed)
    near = count_near(own, own.where(queries), radius).select(F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "near_count")
    asked = rows.where(queries).join(near, "fingerprint", "left").select(*columns, "near_count")
    return asked.unionByName(rows.where(~F.coalesce(queries, F.lit(False))).withColumn("near_count", F.lit(None).cast("long")))


def _ends(edges: DataFrame) -> DataFrame:
    """The last document of each partition against the first of the next one that has rows.

    Partitions are numbered by a narrow table of their own numbers; the last of all
    goes with the first of all.
    """
    by = Window.partitionBy(F.lit(0)).orderBy("part")
    every = Window.partitionBy(F.lit(0))
    numbers = edges.where("edge = 'first'").select("part").withColumn("following", F.coalesce(F.lead("part").over(by), F.min("part").over(every)))
    first = edges.where("edge = 'first'").select(F.col("part").alias("following"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fp"))
    last = edges.where("edge = 'last'").select("doc_id", "text", "fingerprint", "part")
    pairs = last.join(numbers, "part").join(first, "following").select("doc_id", "text", "fingerprint", "next_text", "next_fp")

    def make():
        prints = per_worker("simhash", Fingerprints)

        def step(rows):
            got = [
                _row(prints, i, text, following, int(own, 16), int(other, 16))
                for i, text, following, own, other in zip(rows["doc_id"], rows["text"], rows["next_text"], rows["fingerprint"], rows["next_fp"])
            ]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            return {n: [g[k] for g in got] for k, n in enumerate(names)}

        return step

    return map_rows(pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", make)
