"""Repeated byte strings, removed by a distributed difference-cover suffix sort.

A byte goes if a string of ``LENGTH`` (100) bytes over it also starts earlier: in a
document with a smaller id or earlier in its own. What has to be known of a suffix is
only which others share its first 100 bytes, and which of those comes first.

1. *Sampled tuples.* Suffixes at places whose remainder modulo 21 is in ``COVER`` are
   the sample. Every difference modulo 21 is one of two members of ``COVER`` (a
   perfect difference cover), so two equal strings of 100 bytes have, at one common
   shift of at most 20, a sampled suffix each, and these share ``TUPLE`` (80) bytes.
   A tuple's name is a polynomial of its bytes, so running sums over a block give the
   names of all. Each block of documents sorts its names; buckets of names merge the sorted
   runs. A suffix whose tuple is nowhere else shares 100 bytes with no other one and
   leaves the sort here, as do all remaining suffixes that reach no repeated tuple.
2. *Recursion on names.* Repeated tuples meet again by their name of 96 bits, together
   with the 20 bytes before and the 20 bytes after, which settle the order that the
   name leaves open: no third level is needed, since 100 bytes are all that counts.
3. *Remaining suffixes.* The suffix that starts l bytes before a sampled one is its l
   bytes and the sampled one's name. For each l in turn the suffixes of a bucket are
   sorted by that, in document order among equals, and each is compared, byte by byte,
   with the first of its run of neighbours: all but the first are repeats.

The sort order is that of names instead of that of bytes, so a bucket is a range of
names and needs no global ranks, and equal prefixes still stand side by side.

Blocks hold whole documents and are written once, bucketed by ``lane`` (the
input partition), so that the names' and the repeats' answers join them without moving the text again. Suffixes that
are equal in all of their 120 bytes are sent once for each block. Tuples that many
blocks or one block very often hold (``HOT_BLOCKS``, ``HOT_TIMES``) are not brought
together: their strings of 100 bytes are dealt one by one, by their own names, so the
contexts of one frequent line spread over all buckets.

Defined results: null text is empty text; a text below 100 bytes loses nothing;
documents with null ids come first; rows of equal ids are ordered as they are read;
empty tables give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.llm.common import importable, materialise, shared_dir

LENGTH = 100
#: A perfect difference cover: each remainder modulo 21 is a difference of two members.
MODULUS, COVER = 21, (0, 1, 4, 14, 16)
TUPLE = LENGTH - MODULUS + 1
SIDE = MODULUS - 1
#: Bytes of text in a block, positions named at a time, names and repeats in a bucket.
BLOCK, PIECE, NAMES, REPEATS = 8 << 20, 1 << 19, 2_000_000, 400_000
HOT_BLOCKS, HOT_TIMES = 256, 64
LANES = 4096

_SAMPLED = np.zeros(MODULUS, dtype=bool)
_SAMPLED[list(COVER)] = True
_MIX, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _random(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers, the same ones in every process."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BASE = int(_random(1, 6)[0])
_BYTE, _SECOND = _random(256, 1), _random((TUPLE + 7) // 8, 2)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of pairs of names."""
    out = a * _MIX
    out += b
    out ^= out >> np.uint64(32)
    out *= _ODD
    out ^= out >> np.uint64(29)
    return out


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, dtype=np.uint64)])


def names(data: np.ndarray, at: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """The name of the ``TUPLE`` bytes from each of some places on: the polynomial of the
    bytes' random numbers, from running sums. ``up``, ``down``: powers of the base and of
    its inverse."""
    sums = _BYTE[data]
    sums *= up[: len(data)]
    np.cumsum(sums, out=sums)
    sums = np.r_[np.uint64(0), sums]
    out = (sums[at + TUPLE] - sums[at]) * down[at]
    out ^= out >> np.uint64(32)
    out *= _ODD
    out ^= out >> np.uint64(29)
    return out


class Block:
    """Documents in the order of their ids, as one run of bytes."""

    def __init__(self, body: bytes, lengths: bytes):
        self.data = np.frombuffer(zstandard.decompress(body), dtype=np.uint8)
        self.lengths = np.frombuffer(lengths, dtype=np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths

    def samples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, document and name of every sampled suffix of ``TUPLE`` bytes at least."""
        longest = int(self.lengths.max()) if len(self.lengths) else 0
        offsets = np.flatnonzero(np.resize(_SAMPLED, longest)) if longest >= TUPLE else np.zeros(0, np.int64)
        counts = np.searchsorted(offsets, self.lengths - TUPLE, side="right")
        doc = np.repeat(np.arange(len(counts)), counts)
        at = np.concatenate([offsets[:n] for n in counts.tolist()] or [offsets]) + self.starts[doc]
        found, size = np.empty(len(at), np.uint64), PIECE + TUPLE
        up, down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        for a in range(0, len(self.data), PIECE):
            part = slice(*np.searchsorted(at, (a, a + PIECE)))
            found[part] = names(self.data[a : a + size], at[part] - a, up, down)
        return at, doc, found

    def context(self, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of sampled suffixes: a second name, the bytes around the tuple, and how many
        there are on either side; what lies outside the document is 0."""
        second, sides = np.empty(len(at), np.uint32), np.empty((len(at), 2 * SIDE), np.uint8)
        before = np.minimum(SIDE, at - self.starts[doc]).astype(np.uint8)
        after = np.minimum(SIDE, self.ends[doc] - at - TUPLE).astype(np.uint8)
        room = np.concatenate([np.zeros(SIDE, np.uint8), self.data, np.zeros(SIDE + 8, np.uint8)])
        window = np.lib.stride_tricks.sliding_window_view(room, LENGTH + SIDE)
        for i in range(0, len(at), 1 << 16):
            part = slice(i, i + (1 << 16))
            rows = window[at[part]]
            words = np.zeros((len(rows), 8 * len(_SECOND)), np.uint8)
            words[:, :TUPLE] = rows[:, SIDE : SIDE + TUPLE]
            second[part] = ((words.view(np.uint64) + np.uint64(1)) * _SECOND).sum(axis=1) >> np.uint64(32)
            near = np.concatenate([rows[:, :SIDE], rows[:, SIDE + TUPLE :]], axis=1)
            hidden = np.concatenate(
                [np.arange(SIDE) < SIDE - before[part].astype(np.int64)[:, None], np.arange(SIDE) >= after[part].astype(np.int64)[:, None]], axis=1
            )
            near[hidden] = 0
            sides[part] = near
        return second, sides, before, after


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers, compressed by planes of equal significance."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    return zstandard.compress(b"".join(planes), 1)


def _unpacked(blob: bytes, n: int, *kinds) -> list[np.ndarray]:
    """What :func:`_packed` was given."""
    raw, out, at = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8), [], 0
    for kind in map(np.dtype, kinds):
        plane = raw[at : at + n * kind.itemsize].reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def _steps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of names: bucket numbers rise with the names."""
    return ((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _ranges(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The filled buckets of a sorted column."""
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=bucket.dtype))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(edges[b], edges[b + 1])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(df: DataFrame, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], fields).schema)


BLOCKS = "lane int, block long, bytes long, ids array<long>, lengths binary, body binary"
#: A part of a block for a bucket. kind: 0 tuples, 1 strings, 2 bytes known to go.
PARTS = "bucket int, kind int, lane int, block long, n int, body binary"


def write_blocks(docs: DataFrame) -> DataFrame:
    """Whole documents in blocks of about ``BLOCK`` bytes, as a table bucketed by lane."""
    spark = docs.sparkSession
    importable(spark)
    schema = _arrow(docs, BLOCKS)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    lanes = max(1, min(LANES, source.rdd.getNumPartitions()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, size, number = TaskContext.get().partitionId(), [], 0, 0

        def block() -> pa.RecordBatch:
            held.sort(key=lambda d: (d[0] is not None, d[0] or 0))
            lengths = np.array([len(t) for _, t in held], dtype=np.int64).tobytes()
            body = zstandard.compress(b"".join(t for _, t in held), 3)
            return _batch([(part, (part << 32) | number, size, [i for i, _ in held], lengths, body)], schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and size + len(text) > BLOCK:
                    yield block()
                    held, size, number = [], 0, number + 1
                held.append((doc_id, text))
                size += len(text)
        if held:
            yield block()

    name = f"galetrack_blocks_{uuid.uuid4().hex}"
    made = source.mapInArrow(run, spark.createDataFrame([], BLOCKS).schema)
    made.write.bucketBy(lanes, "lane").sortBy("lane").option("path", shared_dir(spark, "suffix-blocks")).saveAsTable(name)
    return spark.table(name)


def _send_names(blocks: DataFrame, bits: int, buckets: int) -> DataFrame:
    schema = _arrow(blocks, PARTS)
    drop = np.uint64(64 - bits)

    def run(batches):
        for batch in batches:
            for lane, block, lengths, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                mine, times = np.unique(Block(body, lengths).samples()[2] >> drop, return_counts=True)
                hot, rows = (times > 1).astype(np.uint8) + (times > HOT_TIMES), []
                for b, part in _ranges(_bucket(mine << drop, buckets), buckets):
                    rows.append((b, 0, lane, block, part.stop - part.start, _packed(_steps(mine[part]), hot[part])))
                yield _batch(rows, schema)

    return blocks.select("lane", "block", "lengths", "body").mapInArrow(run, blocks.sparkSession.createDataFrame([], PARTS).schema)


ANSWERS = "lane int, block long, bucket int, n int, body binary, repeated long"


def _merge_names(parts: DataFrame) -> DataFrame:
    """Of each block's names in a bucket: 0 held once, 1 repeated, 2 repeated very often."""
    schema = _arrow(parts, ANSWERS)

    def run(table: pa.Table) -> pa.Table:
        got = [table.column(c).to_pylist() for c in ("bucket", "lane", "block", "n", "body")]
        runs = [_unpacked(body, n, np.uint64, np.uint8) for n, body in zip(got[3], got[4])]
        every = np.concatenate([np.cumsum(steps) for steps, _ in runs])
        hot = np.concatenate([h for _, h in runs])
        by = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.r_[True, every[by][1:] != every[by][:-1]])
        blocks = np.diff(np.r_[first, len(every)])
        most = np.maximum.reduceat(hot[by], first)
        verdict = np.where((blocks > HOT_BLOCKS) | (most == 2), 2, np.where((blocks > 1) | (most == 1), 1, 0)).astype(np.uint8)
        out = np.empty(len(every), np.uint8)
        out[by] = np.repeat(verdict, blocks)
        rows, at = [], 0
        for bucket, lane, block, n in zip(*got[:4]):
            mine, at = out[at : at + n], at + n
            rows.append((lane, block, bucket, n, zstandard.compress(mine.tobytes(), 1), int(np.count_nonzero(mine))))
        return pa.Table.from_batches([_batch(rows, schema)])

    return parts.groupBy("bucket").applyInArrow(run, parts.sparkSession.createDataFrame([], ANSWERS).schema)


RECORD = (np.uint64, np.uint32, np.uint8, np.uint8, np.int64, np.int32, np.int64)
STRING = (np.uint64, np.uint32, np.int64, np.int32, np.int64)
RUN = (np.int32, np.int64, np.int64)
_NONE = np.iinfo(np.int64).min


def _own_firsts(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each distinct row of columns, and of all others."""
    by = np.lexsort(keys[::-1])
    new = np.zeros(len(by), bool)
    for k in keys:
        new[1:] |= k[by][1:] != k[by][:-1]
    new[:1] = True
    return by[new], by[~new]


def _of_block(column: str):
    """What a lane was answered, for the row's block."""
    return F.filter(column, lambda x: x["block"] == F.col("block")).alias(column)


def _send_repeats(blocks: DataFrame, answers: DataFrame, bits: int, buckets: int) -> DataFrame:
    """Repeated tuples with their surroundings, once for each block, and very frequent ones string by string."""
    schema = _arrow(blocks, PARTS)
    drop = np.uint64(64 - bits)
    told = answers.groupBy("lane").agg(F.sort_array(F.collect_list(F.struct("block", "bucket", "body"))).alias("told"))

    def run(batches):
        for batch in batches:
            for lane, block, ids, lengths, body, told in zip(*(batch.column(i).to_pylist() for i in range(6))):
                yield _batch(_repeats(Block(body, lengths), ids, told, lane, block), schema)

    def _repeats(held: Block, ids: list, told: list, lane: int, block: int) -> list[tuple]:
        at, doc, name = held.samples()
        verdict = np.frombuffer(b"".join(zstandard.decompress(t["body"]) for t in told), dtype=np.uint8)
        verdict = verdict[np.unique(name >> drop, return_inverse=True)[1]]
        keep = verdict > 0
        at, doc, name, verdict = at[keep], doc[keep], name[keep], verdict[keep]
        second, sides, before, after = held.context(at, doc)
        known, rows = [], []
        number = np.array([_NONE if i is None else i for i in ids], dtype=np.int64)
        # Ids are sent as what they are ahead of the document's place: mostly one number.
        ahead = number - np.arange(len(ids))
        usual = np.flatnonzero(verdict == 1)
        # Suffixes equal in name and surroundings: the first speaks for all; the others repeat it.
        words = np.zeros((len(usual), -(-2 * SIDE // 8) * 8), np.uint8)
        words[:, : 2 * SIDE] = sides[usual]
        words = words.view(np.uint64)
        sent, rest = _own_firsts([name[usual], second[usual], before[usual], after[usual], *words.T])
        sent, rest = usual[sent], usual[rest]
        least = SIDE - np.minimum(after[rest], SIDE).astype(np.int64)
        known.append((doc[rest], at[rest] - before[rest], at[rest] + LENGTH - least, before[rest] >= least))
        for b, part in _ranges(_bucket(name[sent], buckets), buckets):
            x = sent[part]
            numbers = _packed(_steps(name[x]), second[x], before[x], after[x], ahead[doc[x]], doc[x].astype(np.int32), at[x] - held.starts[doc[x]])
            rows.append((b, 0, lane, block, len(x), len(numbers).to_bytes(8, "little") + numbers + zstandard.compress(sides[x].tobytes(), 3)))
        hot = np.flatnonzero(verdict == 2)
        if len(hot):
            shift = np.arange(SIDE + 1)
            fits = (shift <= before[hot][:, None]) & (SIDE - shift <= after[hot][:, None])
            begin, owner = (at[hot][:, None] - shift)[fits], np.broadcast_to(doc[hot][:, None], fits.shape)[fits]
            begin, where = np.unique(begin, return_index=True)
            owner = owner[where]
            whole = np.lib.stride_tricks.sliding_window_view(held.data, LENGTH)
            one, two = np.empty(len(begin), np.uint64), np.empty(len(begin), np.uint32)
            for i in range(0, len(begin), 1 << 15):
                one[i : i + (1 << 15)], two[i : i + (1 << 15)] = string_names(whole[begin[i : i + (1 << 15)]])
            sent, rest = _own_firsts([one, two])
            known.append((owner[rest], begin[rest], begin[rest] + LENGTH, np.ones(len(rest), bool)))
            for b, part in _ranges(_bucket(one[sent], buckets), buckets):
                x = sent[part]
                rows.append((b, 1, lane, block, len(x), _packed(_steps(one[x]), two[x], ahead[owner[x]], owner[x].astype(np.int32), begin[x] - held.starts[owner[x]])))
        d, a, z, true = (np.concatenate(c) for c in zip(*known))
        if true.any():
            d, a, z = d[true], a[true] - held.starts[d[true]], z[true] - held.starts[d[true]]
            d, a, z = union(d, a, z)
            rows.append((block % buckets, 2, lane, block, len(d), _packed(d.astype(np.int32), a, z)))
        return rows

    joined = blocks.join(told, "lane").select("lane", "block", "ids", "lengths", "body", _of_block("told"))
    return joined.mapInArrow(run, blocks.sparkSession.createDataFrame([], PARTS).schema)


_WHOLE, _WHOLE2 = _random(13, 4), _random(13, 5)


def string_names(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of names of whole strings of ``LENGTH`` bytes."""
    words = np.zeros((len(rows), 104), np.uint8)
    words[:, :LENGTH] = rows
    words = words.view(np.uint64)
    words ^= words >> np.uint64(31)
    one = ((words * _WHOLE) ^ ((words * _WHOLE) >> np.uint64(29))) * _WHOLE2
    one = one.sum(axis=1)
    one ^= one >> np.uint64(32)
    one *= _ODD
    return one, ((words + np.uint64(1)) * _WHOLE2).sum(axis=1) >> np.uint64(32)


def union(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching ranges, by document."""
    if not len(doc):
        return doc, start, end
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[by]
    # One axis for all documents, with a gap between any two.
    gap = int(end.max()) + 2
    base = np.cumsum(np.r_[0, doc[1:] != doc[:-1]]) * gap
    reach = np.maximum.accumulate(end + base)
    new = np.r_[True, (start + base)[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.r_[first[1:] - 1, len(doc) - 1]] - base[first]


def _repeat_shifts(group: np.ndarray, sides: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sampled suffixes in document order: the least and the greatest l for which the
    suffix l bytes before repeats an earlier one; (SIDE + 1, -1) where none does."""
    least, most = np.full(len(group), SIDE + 1), np.full(len(group), -1)
    # Those that repeat an earlier one in all bytes around them repeat it for every l.
    whole = np.concatenate([sides, before[:, None], after[:, None]], axis=1)
    first = _first_equal(group, whole)
    again = np.flatnonzero((first != np.arange(len(group))) & (before.astype(int) + after >= SIDE))
    least[again], most[again] = SIDE - after[again].astype(int), before[again]
    # Only the others are sorted for each l, and only where a name has several.
    rest = np.flatnonzero(first == np.arange(len(group)))
    rest = rest[np.bincount(group[rest])[group[rest]] > 1]
    for shift in range(SIDE + 1):
        may = rest[(before[rest] >= shift) & (after[rest] >= SIDE - shift)]
        first = _first_equal(group[may], sides[may, SIDE - shift : 2 * SIDE - shift])
        again = may[first != np.arange(len(may))]
        least[again], most[again] = np.minimum(least[again], shift), shift
    return least, most


def _first_equal(group: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For each row the first one with equal group and bytes, compared byte by byte."""
    words = np.zeros((len(near), -(-near.shape[1] // 8) * 8), np.uint8)
    words[:, : near.shape[1]] = near
    words, salt = words.view(np.uint64), 0
    while True:
        weight = _random(words.shape[1] + 1, 100 + salt)
        key = group.astype(np.uint64) * weight[-1]
        for k in range(words.shape[1]):
            key = _joined(key, words[:, k] * weight[k])
        by = np.argsort(key)
        new = np.flatnonzero(np.r_[True, key[by][1:] != key[by][:-1]]) if len(by) else by
        first = np.empty(len(by), np.int64)
        if len(by):
            first[by] = np.repeat(np.minimum.reduceat(by, new), np.diff(np.r_[new, len(by)]))
        if (group == group[first]).all() and (words == words[first]).all():
            return first
        salt += 1  # two different ones under one key: other weights


RUNS = "lane int, block long, n int, body binary"


def _merge_repeats(parts: DataFrame) -> DataFrame:
    """What each block loses: ranges within documents."""
    schema = _arrow(parts, RUNS)

    def run(table: pa.Table) -> pa.Table:
        got = table.select(["kind", "lane", "block", "n", "body"]).to_pydict()
        parts = list(zip(*(got[c] for c in ("kind", "lane", "block", "n", "body"))))
        found = []
        if records := [p for p in parts if p[0] == 0]:
            columns, sides = [], []
            for _, _, _, n, body in records:
                size = int.from_bytes(body[:8], "little")
                columns.append(_unpacked(body[8 : 8 + size], n, *RECORD))
                columns[-1][0] = np.cumsum(columns[-1][0])
                sides.append(np.frombuffer(zstandard.decompress(body[8 + size :]), np.uint8).reshape(n, 2 * SIDE))
            name, second, before, after, number, doc, offset = (np.concatenate(c) for c in zip(*columns))
            sides, number = np.concatenate(sides), number + doc
            block = np.repeat(np.arange(len(records)), [r[3] for r in records])
            by = np.lexsort((offset, doc, np.array([r[2] for r in records])[block], number))
            pair = np.lexsort((second[by], name[by]))
            new = np.r_[True, (name[by][pair][1:] != name[by][pair][:-1]) | (second[by][pair][1:] != second[by][pair][:-1])]
            group = np.empty(len(by), np.int64)
            group[pair] = np.cumsum(new)
            least, most = _repeat_shifts(group, sides[by], before[by], after[by])
            hit = np.flatnonzero(most >= 0)
            x = by[hit]
            found += _by_block(records, block[x], doc[x], offset[x] - most[hit], offset[x] + LENGTH - least[hit])
        if strings := [p for p in parts if p[0] == 1]:
            columns = [_unpacked(body, n, *STRING) for _, _, _, n, body in strings]
            for c in columns:
                c[0] = np.cumsum(c[0])
            name, second, number, doc, offset = (np.concatenate(c) for c in zip(*columns))
            number = number + doc
            block = np.repeat(np.arange(len(strings)), [r[3] for r in strings])
            by = np.lexsort((offset, doc, np.array([r[2] for r in strings])[block], number))
            _, rest = _own_firsts([name[by], second[by]])
            x = by[rest]
            found += _by_block(strings, block[x], doc[x], offset[x], offset[x] + LENGTH)
        found += [(lane, block, n, body) for kind, lane, block, n, body in parts if kind == 2]
        return pa.Table.from_batches([_batch(found, schema)])

    return parts.groupBy("bucket").applyInArrow(run, parts.sparkSession.createDataFrame([], RUNS).schema)


def _by_block(parts: list, block: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple]:
    by, out = np.argsort(block, kind="stable"), []
    for b, part in _ranges(block[by], len(parts)):
        d, a, z = union(doc[by[part]], start[by[part]], end[by[part]])
        out.append((parts[b][1], parts[b][2], len(d), _packed(d.astype(np.int32), a, z)))
    return out


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and ``kept``, the remaining bytes."""
    spark = docs.sparkSession
    blocks = write_blocks(docs)
    sample = max(1, (blocks.agg(F.sum("bytes")).first()[0] or 0) * len(COVER) // MODULUS)
    bits, buckets = min(64, max(40, sample.bit_length() + 9)), max(1, -(-sample // NAMES))
    answers = materialise(_merge_names(_send_names(blocks, bits, buckets)), "suffix-names")
    repeats = answers.agg(F.sum("repeated")).first()[0] or 0
    into = max(1, -(-repeats // REPEATS))
    runs = materialise(_merge_repeats(_send_repeats(blocks, answers, bits, into)), "suffix-runs")
    by_lane = runs.groupBy("lane").agg(F.collect_list(F.struct("block", "n", "body")).alias("runs"))
    schema = _arrow(docs, REMOVED)

    def run(batches):
        for batch in batches:
            for ids, lengths, body, runs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held, rows, size = Block(body, lengths), [], 0
                parts = [_unpacked(r["body"], r["n"], *RUN) for r in runs or []]
                d, a, z = union(*(np.concatenate(c).astype(np.int64) for c in zip(*parts))) if parts else (np.zeros(0, np.int64),) * 3
                edge = np.searchsorted(d, np.arange(len(ids) + 1))
                for i, doc_id in enumerate(ids):
                    text, part = held.data[held.starts[i] : held.ends[i]], slice(edge[i], edge[i + 1])
                    cuts = np.r_[0, np.c_[a[part], z[part]].ravel(), len(text)].astype(np.int64)
                    kept = b"".join(text[x:y].tobytes() for x, y in zip(cuts[::2], cuts[1::2]))
                    rows.append((doc_id, len(text), len(text) - len(kept), part.stop - part.start, kept))
                    size += len(kept)
                    if size > 1 << 22:
                        yield _batch(rows, schema)
                        rows, size = [], 0
                yield _batch(rows, schema)

    joined = blocks.join(by_lane, "lane", "left").select("ids", "lengths", "body", _of_block("runs"))
    return joined.mapInArrow(run, spark.createDataFrame([], REMOVED).schema)


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id and the text that remains; bytes cut within a character become a replacement character."""
    return removed(docs).select("doc_id", F.decode("kept", "UTF-8").alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    return removed(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

