"""The prefix trie of conversations, from a Cartesian tree over sorted conversations.

A conversation is its sequence of turns (role and text). All conversations are sorted by
the digests of their turns, so that those with a common beginning stand side by side;
lcp[k] is the number of turns that conversations k - 1 and k share. A node of depth d
with several members is a range of places whose inner lcp are d at least and whose outer
ones are less: the ranges are the nodes of the Cartesian tree of lcp, nodes of equal lcp
merged. From a range's parent down to its own lcp there is a node of each depth with the
same members; a conversation goes on alone from the greater lcp beside it.

1. Sorted blocks of places (partitions) exchange one number each, the lcp at their border.
2. Each block finds, with one stack, the nearest smaller value on either side of each of
   its lcp. Ranges that lie within a block are done. Those that cross its border leave
   its prefix or suffix minima: a strictly monotone staircase, as long as conversations
   are deep at most.
3. A crossing range ends in the nearest block whose minimum is smaller; these minima, a
   few numbers for each block, are broadcast. There the staircase has the place. Smallest
   members are those of two staircases and of the whole blocks between.
4. A range's sums are differences of running sums over places, which blocks offset by
   their totals: with b(k, d) the bytes of the first d turns of k, a subtree's saved bytes
   below a node of depth d are the sum of b(k, lcp[k]) - b(k, d - 1) over all places but
   its first; its childless nodes are the places whose conversation doesn't begin the next.

Defined results: turns are ordered by turn (null first), equal ones by role and text, and
repeated rows are turns of their own; null role or text is empty; rows without a conv_id
belong to no conversation; an empty table has no nodes. A conversation is one row of 24
bytes a turn while it is sorted; its turns are numbered by a window that streams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galetrack.llm.common import importable, materialise, received, send

#: Conversations in a block, and ids of ended members that are joined to one text at a time.
BLOCK, CHUNK = 50_000, 4096


def _digest(role: Column, text: Column) -> Column:
    """A turn's key: half a SHA-256 of its role's length, role and text."""
    whole = F.concat(F.length(role.cast("binary")).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16)


def numbered_turns(talks: DataFrame) -> DataFrame:
    """conv_id, place (from 1), key and bytes of text of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = talks.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = turns.withColumn("place", F.row_number().over(order))
    return numbered.select("conv_id", "place", _digest(F.col("role"), F.col("text")).alias("key"), F.octet_length("text").cast("long").alias("size"))


def rebuilt(talks: DataFrame) -> DataFrame:
    """Every conversation with its beginning taken from the first of its five, as the contract says."""
    turns = materialise(numbered_turns(talks), "turns")
    conv = F.col("conv_id")
    taken = F.crc32(F.encode(conv.cast("string"), "UTF-8")) % 9
    every = turns.select("conv_id").distinct().select(conv, taken.alias("h"), (conv - conv % 5).alias("base"))
    heads = turns.where("place <= 8").select(F.col("conv_id").alias("base"), "place", "key", "size")
    begun = every.join(heads, "base").where("place <= h").select("conv_id", "place", "key", "size")
    # Own turns go on after the borrowed ones, however many there were.
    own = turns.withColumn("h", taken).where("place > h").select("conv_id", (F.col("place") + 8).alias("place"), "key", "size")
    parts = begun.unionByName(own).unionByName(every.select("conv_id", F.lit(None).cast("int").alias("place"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("size")))
    held = F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "key", "size"))))
    return parts.groupBy("conv_id").agg(held.alias("t")).select("conv_id", F.col("t.key").alias("keys"), F.col("t.size").alias("bytes"))


def _arrow(df: DataFrame, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], fields).schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held.clear()
    columns = list(zip(*held)) if held else [()] * len(schema)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def common(a: list, b: list) -> int:
    """How many first turns two conversations share."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


#: place: within the block. lcp: with the conversation before, -1 where it isn't known yet.
SORTED = "block int, place long, conv_id long, lcp long, n long, sums array<long>, edge array<binary>"


def sort_conversations(conversations: DataFrame, per_block: int) -> DataFrame:
    """Blocks of sorted conversations. ``sums``: bytes of the first 0, 1, ... turns;
    ``edge``: the keys of a block's first and last conversation, which its neighbours need."""
    importable(conversations.sparkSession)
    schema = _arrow(conversations, SORTED)
    rows = conversations.count()
    dealt = conversations.repartitionByRange(max(1, -(-rows // per_block)), "keys", "conv_id").sortWithinPartitions("keys", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def rows():
            block, place, before, waiting = TaskContext.get().partitionId(), 0, None, None
            for batch in batches:
                for conv, keys, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                    if waiting:
                        yield waiting
                    lcp = -1 if before is None else common(before, keys)
                    waiting = (block, place, conv, lcp, len(keys), np.r_[0, np.cumsum(sizes)].astype(np.int64).tolist(), keys if before is None else None)
                    before, place = keys, place + 1
            if waiting:
                yield waiting[:-1] + (before,)

        yield from _batches(rows(), schema)

    return dealt.mapInArrow(run, conversations.sparkSession.createDataFrame([], SORTED).schema)


def _borders(held: DataFrame) -> list[tuple]:
    """Of each block in order: its number, its conversations, and the lcp of its first with
    the last of the block before (-1 at the beginning); a row for each partition."""
    first = held.where("place = 0").select("block", F.col("edge").alias("first"))
    last = held.groupBy("block").agg(F.count("*").alias("rows"), F.max_by("edge", "place").alias("last"))
    by = Window.partitionBy(F.lit(0)).orderBy("block")  # a row for each partition
    rows = last.withColumn("before", F.lag("block").over(by)).join(first, "block")
    rows = rows.join(last.select(F.col("block").alias("before"), F.col("last").alias("ending")), "before", "left")
    same = F.zip_with("first", "ending", lambda a, b: F.coalesce(a == b, F.lit(False)))
    shared = F.coalesce(F.array_position(same, False) - 1, F.lit(-1))
    lcp = F.when(F.col("before").isNull(), F.lit(-1)).otherwise(F.when(shared < 0, F.size("first")).otherwise(shared))
    return [tuple(r) for r in rows.select("block", "rows", lcp.cast("long").alias("lcp")).orderBy("block").collect()]


#: Of a place p that bounds a range. lcp, frame: its value and its range's first place in
#: the block; least: the smallest conv_id from p to the block's end (on the left side) or
#: from the block's start to before p (on the right); n: turns of p; saved, leaves: running
#: sums of the block up to p (on the left, p's own saved bytes are in).
SIDE = "struct<place:long,lcp:long,frame:long,least:long,n:long,saved:long,leaves:long,block:int>"
#: kind: 'range' within a block, 'piece' of one that crosses a border, 'left' and 'right'
#: steps of the block's staircases (for values over v, up to top), 'one' for a
#: conversation alone, 'block' for the totals, 'ended' for ids in ``ids`` from ``place`` on.
FOUND = f"kind string, block int, v long, top long, frame long, least long, equal long, ended long, place long, l {SIDE}, r {SIDE}, sums array<long>, ids string"
_FIELDS = ("kind", "block", "v", "top", "frame", "least", "equal", "ended", "place", "l", "r", "sums", "ids")
_SIDE = ("place", "lcp", "frame", "least", "n", "saved", "leaves", "block")
FAR, NONE = (1 << 63) - 1, -1


def scan_block(block: int, start: int, lcp: list[int], after: int, convs: list[int], n: list[int], sums: list[list[int]]) -> Iterator[dict]:
    """One pass with a stack over the lcp of a block, whose first place is ``start``.

    ``after`` is the lcp at the place behind the block; only it is known of that place.
    """
    size = len(convs)
    saved, leaves = [0], [0]
    for k in range(size):
        saved.append(saved[-1] + sums[k][max(0, lcp[k])])
        leaves.append(leaves[-1] + ((lcp[k + 1] if k + 1 < size else after) < n[k]))
    to_here = np.minimum.accumulate(convs).tolist()
    from_here = np.minimum.accumulate(convs[::-1])[::-1].tolist()
    frame_of = [0] * (size + 1)
    frame_of[size] = start + size

    def left(k: int) -> dict:
        return dict(zip(_SIDE, (start + k, lcp[k], frame_of[k], from_here[k], n[k], saved[k + 1], leaves[k], block)))

    def right(k: int) -> dict:
        value = lcp[k] if k < size else after
        return dict(zip(_SIDE, (start + k, value, frame_of[k], to_here[k - 1] if k else FAR, NONE, saved[k], leaves[k], block)))

    # A frame: value, its first and last place, first member (None: before the block),
    # smallest member that no frame above holds, lcp of the value, ended ones at them.
    stack: list[list] = []
    pending, steps = [], []
    lowest = FAR
    for k in range(size + 1):
        value = lcp[k] if k < size else after
        if k == size:
            steps = [(f[0], f[2]) for f in stack]
        least, member, done = convs[k - 1] if k else FAR, k - 1 if k else None, []
        while stack and stack[-1][0] > value:
            f = stack.pop()
            least, member = min(least, f[4]), f[3]
            done.append((f, least))
        if k < size:
            if stack and stack[-1][0] == value:
                top = stack[-1]
                top[2], top[4], top[5], top[6] = k, min(top[4], least), top[5] + 1, top[6] + (n[k] == value)
            else:
                stack.append([value, k, k, member if stack or done or k else None, least, 1, int(n[k] == value)])
                if len(stack) == 1:
                    stack[0][3] = None
            frame_of[k] = start + stack[-1][1]
            if value < lowest:
                pending.append(("left", value, lowest, k))
                lowest = value
        for f, m in done:
            pending.append(("done", f, m, k))
    for kind, *what in pending:
        if kind == "left":
            value, top, k = what
            yield {"kind": "left", "v": value, "top": top, "r": right(k)}
        else:
            f, m, k = what
            yield _range(f, m, start, n, sums, left(f[3]) if f[3] is not None else None, right(k))
    for i, (value, k) in enumerate(steps):
        yield {"kind": "right", "v": value, "top": steps[i + 1][0] if i + 1 < len(steps) else FAR, "l": left(k)}
    for f in stack:
        if f[0] >= 0:
            yield _range(f, None, start, n, sums, left(f[3]) if f[3] is not None else None, None)
    yield {"kind": "block", "v": min(lcp), "least": min(convs), "place": size, "equal": saved[-1], "ended": leaves[-1]}

    # Conversations that go on alone, and those that end within a range.
    held, at, frame = [], 0, None
    for k in range(size + 1):
        following = (lcp[k + 1] if k + 1 < size else after) if k < size else None
        own = None
        if k < size:
            lo = max(lcp[k], following)
            if n[k] > lo:
                parent = frame_of[k] if lcp[k] >= following else frame_of[k + 1]
                yield {"kind": "one", "v": n[k], "top": lo, "frame": NONE if lo < 0 else parent, "least": convs[k]}
            else:
                own = frame_of[k] if lcp[k] == n[k] else frame_of[k + 1]
        if held and (own != frame or len(held) >= CHUNK):
            yield {"kind": "ended", "frame": frame, "place": start + at, "ids": ",".join(map(str, held))}
            held = []
        if own is not None:
            if not held:
                at, frame = k, own
            held.append(convs[k])


def _range(f: list, least: int | None, start: int, n: list[int], sums: list, l: dict | None, r: dict | None) -> dict:
    """A range, or what a block knows of it. ``ended`` of a piece is without the first member."""
    value, first = f[0], f[1]
    whole = l is not None and r is not None
    return {
        "kind": "range" if whole else "piece", "v": value, "frame": start + first, "least": least if whole else None,
        "equal": f[5], "ended": f[6] + (whole and n[f[3]] == value), "l": l, "r": r, "sums": sums[first][: value + 1],
    }


def scan(held: DataFrame, borders: list[tuple]) -> DataFrame:
    """:func:`scan_block` of each block."""
    schema = _arrow(held, FOUND)
    starts, at = {}, 0
    for i, (block, rows, lcp) in enumerate(borders):
        starts[block] = (i, at, lcp, borders[i + 1][2] if i + 1 < len(borders) else -1)
        at += rows
    told = send(held.sparkSession, starts)

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("place").to_pydict()
        number, start, first, after = received(told)[rows["block"][0]]
        found = scan_block(number, start, [first, *rows["lcp"][1:]], after, rows["conv_id"], rows["n"], rows["sums"])
        return pa.Table.from_batches(_batches((tuple({**row, "block": number}.get(c) for c in _FIELDS) for row in found), schema))

    columns = held.select("block", "place", "conv_id", "lcp", "n", "sums")
    return columns.groupBy("block").applyInArrow(run, held.sparkSession.createDataFrame([], FOUND).schema)


def _crossing(found: DataFrame, totals: list[tuple]) -> DataFrame:
    """Of each piece of a range that crosses borders: its frame, and the range as a whole.

    ``totals``: of each block its least lcp, least conv_id, conversations, saved bytes and
    childless places.
    """
    spark = found.sparkSession
    told = send(spark, [np.array(c, dtype=np.int64) for c in zip(*totals)])
    wanted = found.where("kind = 'piece'").select("block", "v", "frame", "equal", "ended", "l", "r", "sums")
    fields = f"block int, v long, frame long, equal long, ended long, l {SIDE}, r {SIDE}, sums array<long>, l_block int, r_block int"
    schema = _arrow(found, fields)

    def nearest(batches):
        minimum = received(told)[0]

        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    b, v = row["block"], row["v"]
                    behind = np.flatnonzero(minimum[b + 1 :] < v)
                    here = b if row["l"] else int(np.flatnonzero(minimum[:b] < v)[-1])
                    there = b if row["r"] else b + 1 + int(behind[0]) if len(behind) else len(minimum)
                    yield (*row.values(), here, there)

        yield from _batches(rows(), schema)

    sided = wanted.mapInArrow(nearest, spark.createDataFrame([], fields).schema)
    within = (F.col("over") < F.col("v")) & (F.col("v") <= F.col("upto"))
    begin = found.where("kind = 'right'").select(F.col("block").alias("l_block"), F.col("v").alias("over"), F.col("top").alias("upto"), F.col("l").alias("side"))
    close = found.where("kind = 'left'").select(F.col("block").alias("r_block"), F.col("v").alias("over"), F.col("top").alias("upto"), F.col("r").alias("side"))
    end = (sum(t[2] for t in totals), -1, NONE, FAR, NONE, 0, 0, len(totals))  # behind the last block
    close = close.unionByName(spark.createDataFrame([(len(totals), -1, FAR, end)], f"r_block int, over long, upto long, side {SIDE}"))
    sided = sided.where("l is not null").unionByName(sided.where("l is null").drop("l").join(begin, "l_block").where(within).withColumnRenamed("side", "l").drop("over", "upto"))
    sided = sided.where("r is not null").unionByName(sided.where("r is null").drop("r").join(close, "r_block").where(within).withColumnRenamed("side", "r").drop("over", "upto"))
    frames = F.collect_list("frame").alias("frames")  # one for each block at most
    whole = sided.groupBy(F.col("l.place").alias("begin"), "v").agg(
        F.sum("equal").alias("equal"), F.sum("ended").alias("ended"), F.any_value("l").alias("l"), F.any_value("r").alias("r"), F.any_value("sums").alias("sums"), frames
    ).select("v", "equal", "ended", "l", "r", "sums", "frames")
    out = f"frame long, id long, v long, least long, equal long, ended long, l {SIDE}, r {SIDE}, sums array<long>"
    made = _arrow(found, out)

    def close_up(batches):
        _, least, _, saved, leaves = received(told)
        saved, leaves = np.r_[0, np.cumsum(saved)].tolist(), np.r_[0, np.cumsum(leaves)].tolist()

        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    l, r = row["l"], row["r"]
                    members = [l["least"], r["least"]]
                    if r["block"] > l["block"] + 1:
                        members.append(int(least[l["block"] + 1 : r["block"]].min()))
                    ended = row["ended"] + (l["n"] == row["v"])
                    for side in (l, r):
                        side["saved"] += saved[side["block"]]
                        side["leaves"] += leaves[side["block"]]
                    for frame in row["frames"]:
                        yield (frame, min(row["frames"]), row["v"], min(members), row["equal"], ended, l, r, row["sums"])

        yield from _batches(rows(), made)

    return whole.mapInArrow(close_up, spark.createDataFrame([], out).schema)


def _digests(ended: DataFrame) -> DataFrame:
    """id and the SHA-256 of its ids, which come in parts: sorted, and hashed as a stream."""
    fields = "id long, ends_sha256 string"
    schema = _arrow(ended, fields)

    def run(batches):
        def rows():
            now, digest = None, None
            for batch in batches:
                for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if key != now:
                        if digest:
                            yield now, digest.hexdigest()
                        now, digest = key, hashlib.sha256(ids.encode())
                    else:
                        digest.update(b"," + ids.encode())
            if digest:
                yield now, digest.hexdigest()

        yield from _batches(rows(), schema)

    sorted_ = ended.repartition("id").sortWithinPartitions("id", "place").select("id", "ids")
    return sorted_.mapInArrow(run, ended.sparkSession.createDataFrame([], fields).schema)


def trie(conversations: DataFrame, per_block: int = BLOCK) -> DataFrame:
    """The nodes of the prefix trie of ``conversations`` (conv_id, keys, bytes)."""
    spark = conversations.sparkSession
    held = materialise(sort_conversations(conversations, per_block), "sorted-conversations")
    borders = _borders(held)
    found = materialise(scan(held, borders), "conversation-ranges")
    totals = [tuple(r) for r in found.where("kind = 'block'").orderBy("block").select("v", "least", "place", "equal", "ended").collect()]
    if not totals:
        return spark.createDataFrame([], NODES)
    crossing = materialise(_crossing(found, totals), "crossing-ranges")

    ranges = found.where("kind = 'range'").select(F.col("frame").alias("id"), "v", "least", "equal", "ended", "l", "r", "sums")
    ranges = ranges.unionByName(crossing.where("frame = id").select("id", "v", "least", "equal", "ended", "l", "r", "sums"))
    lo, left_is_parent = F.greatest("l.lcp", "r.lcp"), F.col("l.lcp") >= F.col("r.lcp")
    ranges = ranges.select(
        "id", "v", "least", "ended", "sums", lo.alias("lo"), F.when(lo >= 0, F.when(left_is_parent, F.col("l.frame")).otherwise(F.col("r.frame"))).alias("above"),
        (F.col("r.place") - F.col("l.place")).alias("n_convs"), (F.col("equal") + 1 - F.col("ended")).alias("n_children"),
        (F.col("r.leaves") - F.col("l.leaves")).alias("n_leaves"), (F.col("r.saved") - F.col("l.saved")).alias("saved"),
    )
    canon = crossing.select("frame", F.col("id").alias("canonical"))
    ended = found.where("kind = 'ended'").select("frame", "place", "ids").join(canon, "frame", "left").select(F.coalesce("canonical", "frame").alias("id"), "place", "ids")
    ranges = ranges.join(_digests(ended), "id", "left")
    ones = found.where("kind = 'one'").select(
        F.col("v"), "least", F.col("top").alias("lo"), F.when(F.col("top") >= 0, F.col("frame")).alias("above"), F.lit(1).cast("long").alias("ended"),
        F.lit(None).cast("array<bigint>").alias("sums"), F.lit(1).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"), F.sha2(F.col("least").cast("string").cast("binary"), 256).alias("ends_sha256"),
    )
    every = ranges.drop("id").unionByName(ones)
    parents = found.where("kind = 'range'").select(F.col("frame").alias("above"), F.col("least").alias("parent"))
    parents = parents.unionByName(crossing.select(F.col("frame").alias("above"), F.col("least").alias("parent")))
    nodes = every.join(parents, "above", "left").withColumn("depth", F.explode(F.sequence(F.col("lo") + 1, F.col("v"))))
    d, last = F.col("depth"), F.col("depth") == F.col("v")
    before = F.when(d > 0, F.get("sums", (d - 1).cast("int"))).otherwise(0)
    return nodes.select(
        F.col("least").alias("conv_id"), d.alias("depth"), F.when(d == 0, None).when(d > F.col("lo") + 1, F.col("least")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves",
        F.when(F.col("n_convs") > 1, F.col("saved") - (F.col("n_convs") - 1) * before).otherwise(0).alias("saved_tokens"),
        F.when(last & (F.col("ended") > 0), F.col("ends_sha256")).otherwise(F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
