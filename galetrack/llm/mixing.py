"""Mixing sources to target weights by a low-discrepancy schedule.

The points of the golden-ratio sequence ``frac(i * phi)`` are mapped through the
sources' cumulative shares, which deals the slots of the mix to sources evenly at
every prefix. A slot's rank among its source's slots says which block of the
source it takes: each source's documents are shuffled by a hash and cut into
blocks of equally many words, and the blocks are taken in turn, again from the
first when all have been taken. The last slot of a source is cut so that the
source gives its target to the word.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating; they
share the total of all sizes; a target stops at ``most`` times its source's size
and the excess is shared again by weight until none is above.

Defined results: a null text has size 0; a document of size 0 takes 0; null is a
source of its own; repeated rows are documents of their own, kept apart by their
ordinal among equal rows; without words all targets are 0. Extra columns are
ignored by the digest and kept by :func:`mix`. Reruns agree: the shuffle is a
hash of the row, and nothing depends on the partitioning.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galetrack.llm.common import materialise

#: The weights of sources, in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: The most sources of a mix, which is a list on the driver.
MOST_SOURCES = 1000
#: The circle in integer units, and the golden ratio's fraction of it.
CIRCLE = 1 << 64
GOLDEN = 0x9E3779B97F4A7C15
#: Slots whose ranks are counted together.
CHUNK = 1 << 14


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, most: float = 3.0) -> dict[str | None, float]:
    """Target words of each source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total = float(sum(sizes.values()))
    out: dict[str | None, float] = {}
    open_, left = list(order), total
    while open_:
        sum_w = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / sum_w for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            out.update(share)
            break
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in above]
    return {s: out[s] for s in order}


def needs(sizes: dict, goals: dict, block: int) -> dict:
    """Slots that each source needs for its whole rounds and the cut last one."""
    out = {}
    for s, goal in goals.items():
        size, want = sizes[s], int(round(goal))
        rounds, rest = divmod(want, size) if size else (0, 0)
        out[s] = rounds * -(-size // block) + -(-rest // block)
    return out


def schedule(spark: SparkSession, slots: int, shares: list[int]) -> DataFrame:
    """The first ``slots`` slots of the mix: slot and k, the source's place.

    ``shares`` are the sources' slots; the golden-ratio point of a slot, exact in
    decimal integers, falls into one source's stretch of their cumulative sum.
    """
    total, edges = sum(shares), []
    for s in shares[:-1]:
        edges.append((edges[-1] if edges else 0) + s * CIRCLE // total)
    point = f"pmod(cast(id as decimal(17,0)) * {GOLDEN}BD, {CIRCLE}BD)"
    # A sorted array of edges would be scanned alike; sources are few.
    pick = " + ".join([f"int({point} >= {e}BD)" for e in edges]) or "0"
    return spark.range(slots).selectExpr("id as slot", f"cast({pick} as int) as k")


def ranked(slots: DataFrame) -> DataFrame:
    """``slots`` with ``rank``, a slot's place among its source's, from 0.

    Ranks are counted in chunks of slots, so that no source's slots meet in one task.
    """
    rows = slots.withColumn("chunk", (F.col("slot") / CHUNK).cast("long"))
    inside = Window.partitionBy("chunk", "k").orderBy("slot")
    rows = rows.withColumn("n", F.row_number().over(inside).cast("long"))
    counts = rows.groupBy("chunk", "k").agg(F.count("*").alias("c"))
    before = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("chunk", "k", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    return rows.join(offsets, ["chunk", "k"]).select("slot", "k", (F.col("before") + F.col("n") - 1).alias("rank"))


def enough_slots(spark: SparkSession, need: list[int]) -> int:
    """How long the schedule must be for every source to reach its slots."""
    slots = sum(need) + 16
    while True:
        got = {r["k"]: r["n"] for r in schedule(spark, slots, need).groupBy("k").agg(F.count("*").alias("n")).collect()}
        if all(got.get(k, 0) >= n for k, n in enumerate(need)):
            return slots
        slots += max(16, slots // 8)


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = 3.0, block: int = 1024) -> DataFrame:
    """doc_id, source, size, source_size, target and taken for each document.

    The driver sees one row for each source; more than ``MOST_SOURCES`` are refused.
    """
    spark = docs.sparkSession
    narrow = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"))
    narrow = materialise(narrow, "mix-sizes")
    found = narrow.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: a mix is a list of sources, each a term of the schedule")
    by_source = {r["source"]: (r["size"], r["n"]) for r in found}
    sizes = {s: v[0] for s, v in by_source.items()}
    goals = targets(sizes, weights, most)
    need = needs(sizes, goals, block)
    order = list(goals)
    made = [(k, s, sizes[s], goals[s], int(round(goals[s])), need[s], max(1, -(-sizes[s] // block))) for k, s in enumerate(order)]
    names = ("k", "source", "source_size", "target", "want", "need", "blocks")
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
    # As an Arrow table it is part of the plan; a list would start Python workers of another kind on the executors.
    plan = spark.createDataFrame(pa.table([pa.array([r[i] for r in made], kind) for i, kind in enumerate(kinds)], names=names))
    known = narrow.join(F.broadcast(plan), narrow["source"].eqNullSafe(plan["source"])).select("doc_id", narrow["source"], "k", "size", "source_size", "target")
    plain = known.where("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    if not any(need.values()):
        return known.select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))

    # Shuffled places of the words: buckets of the hash first, then inside a bucket.
    buckets = max(1, sum(v[1] for v in by_source.values()) // 10_000)
    rows = known.where("size > 0").withColumn("h", F.xxhash64("doc_id", "size", F.lit("mix")))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    inside = Window.partitionBy("k", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    before = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = known.where("size > 0").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", F.lit("mix")), F.lit(buckets)))
    sums = sums.groupBy("k", "bucket").agg(F.sum("size").alias("words")).select("k", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("outer"))
    rows = rows.join(sums, ["k", "bucket"]).withColumn("start", F.col("outer") + F.col("inner")).drop("h", "bucket", "inner", "outer")
    pieces = rows.withColumn("j", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    pieces = pieces.withColumn("a", F.greatest("start", F.col("j") * block)).withColumn("b", F.least(F.col("start") + F.col("size"), (F.col("j") + 1) * block))

    shares = [need[s] for s in order]
    slots = ranked(schedule(spark, enough_slots(spark, shares), shares)).join(F.broadcast(plan.select("k", "want", "need", "blocks", F.col("source_size").alias("whole"))), "k").where("rank < need")
    end = F.expr(f"case when rank div blocks = want div whole then least((rank % blocks + 1) * {block}, want % whole) else (rank % blocks + 1) * {block} end")
    slots = slots.select("k", F.expr("rank % blocks").alias("j"), end.alias("end"))
    blocks = slots.groupBy("k", "j", "end").agg(F.count("*").alias("times"))
    got = pieces.join(blocks, ["k", "j"], "left").withColumn("words", F.coalesce(F.col("times") * F.greatest(F.lit(0), F.least("b", "end") - F.col("a")), F.lit(0)))
    taken = got.groupBy("doc_id", "source", "k", "size", "source_size", "target", "start").agg(F.sum("words").alias("taken"))
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken").unionByName(plain)


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken for each document."""
    return take(docs, **options).select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each as often as its taken words fill it, to the nearest.

    Rows that agree in id, source and size share their taken words evenly.
    """
    size = word_count(F.col("text").cast("string"))
    counts = take(docs.select("doc_id", "source", "text"), **options).groupBy("doc_id", "source", "size")
    counts = counts.agg(F.expr("cast(coalesce(round(sum(taken) / (count(*) * nullif(first(size), 0))), 0) as int)").alias("times")).where("times > 0")
    # The whole row is one column, so no name of the input can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("i"), F.col("source").cast("string").alias("s"), size.alias("n"))
    on = rows["i"].eqNullSafe(counts["doc_id"]) & rows["s"].eqNullSafe(counts["source"]) & (rows["n"] == counts["size"])
    repeated = rows.join(counts, on).select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("turn"))
    return repeated.select("row.*")
