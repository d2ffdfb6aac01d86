"""Language-model scores by prediction by partial matching (PPM).

A trie of byte contexts predicts each byte of a text from the ``ORDER`` bytes before
it: the longest context seen in training gives the byte's probability if it saw the
byte, else an escape probability, and the next shorter context goes on without the
bytes that the longer one had seen (symbol exclusion). With T occurrences of D
distinct bytes, a byte seen c times has (c - d) / T and an escape d D / T; the
discount d is estimated for each order from the numbers of bytes in context that
occur once and twice, n1 / (n1 + 2 n2). Below the empty context all bytes left are
equally likely.

A text is its words with one space between them, ``ORDER`` start marks before and an
end mark behind, so contexts run over the spaces from word to word and every byte has
a context of full order. Contexts of full order count occurrences; a shorter one
counts the distinct contexts one byte longer in which its byte occurred, as it only
predicts what those have not seen. All of this is one proper distribution over texts;
the score is the log10 of a text's probability.

Two forms: :func:`score_documents` with a trie pretrained on the training
documents, and :func:`adaptive_bits`, which learns each document as it reads it.

The model is two written tables, however large: the trie's (context, byte) pairs and
the words with their counts (for the base score). Each task adds up the pairs of its
texts before the shuffle; the pairs of shorter contexts follow from those of the next
longer ones. The contexts that a byte falls back to all end alike, so the pairs are
dealt into shards by the last two bytes of their context; with the pairs of order 0
and 1 (65,792 at most) a shard gives the log-probability of each of its pairs. A
text's score is the sum over its bytes. What is broadcast only spares joins and
changes no result: at most about ``max_entries`` pairs, the most used, and
``hot_words`` words; what a text has of the others is joined to it.

Defined results: null text is empty text, which is one token, its end; without
training documents the base score is that of one unseen type and every byte is
equally likely; rows with equal or null ids are scored by themselves; texts of any
length are scored whole, in pieces of a bounded size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.llm.common import fold, importable, materialise, new_token, per_worker, received, send

START, END = 9, 10
ORDER = 5
#: Bits that hold a context's bytes and the predicted byte; the order stands above.
SHIFT = 56
#: The bits of a context of five bytes and its byte.
CODE = (1 << 48) - 1
#: Bytes of a text that are looked at together.
PIECE = 1 << 20


def tokens(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


def stream(words: list[bytes], order: int = ORDER) -> bytes:
    """A text's bytes between its start marks and its end mark."""
    return b"\t" * order + b" ".join(words) + b"\n"


def full_codes(data: bytes, order: int = ORDER) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of joined streams, piece by piece: the piece's start, the places in it of all
    bytes but start marks, and their (context, byte) codes of full order."""
    buffer = np.frombuffer(data, dtype=np.uint8)
    for a in range(0, len(buffer), PIECE):
        at = np.flatnonzero(buffer[a : a + PIECE] != START)
        yield a, at, codes(buffer, order, at + a)


def codes(buffer: np.ndarray, order: int, at: np.ndarray) -> np.ndarray:
    """(order, context, byte) of the given places, packed in 64 bits."""
    out = np.full(len(at), order << SHIFT, dtype=np.int64)
    for back in range(order + 1):
        out |= buffer[at - back].astype(np.int64) << (8 * back)
    return out


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, weights
    by = np.argsort(keys, kind="stable")
    keys, weights = keys[by], weights[by]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(weights, first)


def discount(n1: float, n2: float) -> float:
    """From how many counts are 1 and 2; within bounds that keep all probabilities positive."""
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


class Trie:
    """A trie of contexts as sorted arrays. ``discounts``: one for each order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, discounts: list[float], order: int = ORDER):
        self.order, self.discounts = order, discounts
        self.keys, self.counts = _summed(keys.astype(np.int64), counts.astype(np.int64))
        context = self.keys >> 8
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.array([], dtype=np.int64)
        self.contexts = context[first]
        self.total = np.add.reduceat(self.counts, first) if len(first) else np.array([], dtype=np.int64)
        self.distinct = np.diff(np.r_[first, len(context)])
        # What a context has seen of its parent's bytes: excluded when it escapes.
        o = self.keys >> SHIFT
        parent = np.where(o > 0, ((o - 1) << SHIFT) | (self.keys & ((np.int64(1) << np.maximum(8 * o, 0)) - 1)), -1)
        at, has = self._find(self.keys, parent)
        mine = np.repeat(np.arange(len(first)), self.distinct)
        seen = np.bincount(mine, np.where(has, self.counts[at] if len(at) else 0, 0), len(first))
        kinds = np.bincount(mine, has, len(first))
        up, known = self._find(self.contexts, self._parents(self.contexts))
        self.left_total = np.where(known, (self.total[up] if len(up) else 0) - seen, 0)
        self.left_distinct = np.where(known, (self.distinct[up] if len(up) else 0) - kinds, 0)
        root = self.distinct[:1] if len(self.contexts) and self.contexts[0] == 0 else np.array([0])
        self.below = math.log(1 / max(1, 256 - int(root[0])))

    @staticmethod
    def _find(among: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(among):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
        return at, among[at] == keys

    @staticmethod
    def _parents(contexts: np.ndarray) -> np.ndarray:
        o = contexts >> (SHIFT - 8)
        return np.where(o > 0, ((o - 1) << (SHIFT - 8)) | (contexts & ((np.int64(1) << np.maximum(8 * (o - 1), 0)) - 1)), -1)

    def key_logs(self, keys: np.ndarray) -> np.ndarray:
        """Natural log-probability of each code's byte, from the code's context down."""
        wide = self.order + 1
        buffer = ((keys[:, None] >> (8 * np.arange(self.order, -1, -1))) & 255).astype(np.uint8).ravel()
        return self._places(buffer, np.arange(len(keys)) * wide + self.order, keys >> SHIFT)

    def _places(self, buffer: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at))
        open_ = np.arange(len(at))
        child = np.full(len(at), -1)
        for o in range(self.order, -1, -1):
            here = open_[place[open_] >= o]
            if not len(here):
                continue
            key = codes(buffer, o, at[here])
            ctx, has = self._find(self.contexts, key >> 8)
            entry, seen = self._find(self.keys, key)
            seen &= has
            below = child[here] >= 0
            total = np.where(below, self.left_total[child[here]], self.total[ctx] if len(ctx) else 0) if len(self.contexts) else np.zeros(len(here))
            distinct = np.where(below, self.left_distinct[child[here]], self.distinct[ctx] if len(ctx) else 0) if len(self.contexts) else np.zeros(len(here))
            if seen.any():
                c = self.counts[entry[seen]]
                out[here[seen]] += np.log((c - self.discounts[o]) / np.maximum(total[seen], c))
            missed = has & ~seen
            escape = missed & (distinct > 0) & (total > 0)
            out[here[escape]] += np.log(self.discounts[o] * distinct[escape] / total[escape])
            child[here[missed]] = ctx[missed]
            child[here[~has]] = -1
            done = np.zeros(len(at), dtype=bool)
            done[here[seen]] = True
            open_ = open_[~done[open_]]
        out[open_] += self.below
        return out


def adaptive_bits(text: str | None, order: int = ORDER) -> float:
    """Code length in bits of a whole text that the trie learns as it reads.

    Contexts run over the whole text here. Method C: an escape counts as often as
    the context has distinct bytes; only the contexts down to the one that knew
    the byte learn it (update exclusion).
    """
    trie: dict[bytes, dict[int, int]] = {}
    data, bits = (text or "").encode("utf-8", "replace"), 0.0
    for i, symbol in enumerate(data):
        barred: set[int] = set()
        p, used = 1.0, []
        for o in range(min(order, i), -1, -1):
            node = trie.setdefault(data[i - o : i], {})
            used.append(node)
            left = {s: c for s, c in node.items() if s not in barred} if barred else node
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if symbol in left:
                p *= left[symbol] / total
                break
            p *= len(left) / total
            barred |= left.keys()
        else:
            p /= 256 - len(barred)
        for node in used:
            node[symbol] = node.get(symbol, 0) + 1
        bits -= math.log2(p)
    return bits


def count_words(docs: DataFrame, flush: int = 400_000) -> DataFrame:
    """word (binary) and n, its times in the texts to ``learn`` from; each task sums before the shuffle."""
    importable(docs.sparkSession)
    arrow = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            items = list(counts.items())
            counts.clear()
            for a in range(0, len(items), 50_000):
                part = items[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())], schema=arrow)

        for b in batches:
            for text, learn in zip(b.column(0), b.column(1).to_pylist()):
                words = tokens(text.as_py())
                counts.update(words if learn else dict.fromkeys(words, 0))
                if len(counts) >= flush:
                    yield from out()
        yield from out()

    return docs.select(F.col("text").cast("string").alias("text"), "learn").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _floor(rows: DataFrame, value: str, size, most: int) -> int:
    """The smallest count at which ``size`` of the rows with at least that count is within ``most``."""
    bins = rows.groupBy(F.least(F.col(value), F.lit(1 << 20)).alias("v")).agg(F.sum(size).alias("n"))
    # Exact up to a thousand, by powers of 1.1 above: a bounded histogram.
    step = F.when(F.col("v") <= 1000, F.col("v")).otherwise(F.ceil(F.pow(F.lit(1.1), F.floor(F.log(F.col("v").cast("double")) / math.log(1.1)))))
    found = {int(r["s"]): r["n"] for r in bins.groupBy(step.alias("s")).agg(F.sum("n").alias("n")).collect()}
    least, held = 1 << 20, 0
    for s in sorted(found, reverse=True):
        held += found[s]
        if held > most:
            break
        least = s
    return least


def count_pairs(docs: DataFrame, order: int = ORDER, most: int = 1 << 20) -> DataFrame:
    """key, n and uses of all (context, byte) codes of full order in ``docs`` (text, learn):
    n is how often they occur in the texts to learn from, uses in all."""
    importable(docs.sparkSession)
    arrow = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("uses", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> Iterator[pa.RecordBatch]:
            keys, both = _summed(np.concatenate([k for k, _ in held]), np.concatenate([b for _, b in held]))
            held.clear()
            for a in range(0, len(keys), 1 << 16):
                part = both[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 16)]), pa.array(part >> 32), pa.array(part & 0xFFFFFFFF)], schema=arrow)

        def add(data: bytes, learn: bool) -> int:
            size = 0
            for _, _, found in full_codes(data, order):
                keys, n = np.unique(found, return_counts=True)
                # Counts of a part stay far below 2^31, so both sums fit one number.
                held.append((keys, n * ((1 << 32) * learn + 1)))
                size += len(keys)
            return size

        size = 0
        for b in batches:
            waiting: dict[bool, list[bytes]] = {True: [], False: []}
            length = {True: 0, False: 0}
            for text, learn in zip(b.column(0), b.column(1).to_pylist()):
                data = stream(tokens(text.as_py()), order)
                waiting[learn].append(data)
                length[learn] += len(data)
                if length[learn] >= PIECE:
                    size += add(b"".join(waiting[learn]), learn)
                    waiting[learn], length[learn] = [], 0
            for learn, parts in waiting.items():
                size += add(b"".join(parts), learn)
            if size >= most:
                keys, both = _summed(np.concatenate([k for k, _ in held]), np.concatenate([x for _, x in held]))
                held[:] = [(keys, both)]
                if len(keys) >= most:
                    yield from out()
                size = sum(len(k) for k, _ in held)
        if held:
            yield from out()

    rows = docs.select(F.col("text").cast("string").alias("text"), "learn")
    return rows.mapInArrow(run, "key long, n long, uses long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))


def contexts_of(pairs: DataFrame, order: int = ORDER) -> DataFrame:
    """``pairs`` of full order with those of all shorter contexts (uses 0)."""
    tables = [pairs]
    longer = pairs.where("n > 0").select("key")
    for o in range(order, 0, -1):
        key = F.lit((o - 1) << SHIFT).bitwiseOR(F.col("key").bitwiseAND(F.lit((1 << (8 * o)) - 1)))
        less = materialise(longer.groupBy(key.alias("key")).agg(F.count("*").alias("n")), "ppm-shorter")
        tables.append(less.select("key", "n", F.lit(0).cast("long").alias("uses")))
        longer = less.select("key")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def discounts_of(entries: DataFrame, order: int = ORDER) -> list[float]:
    """The discount of each order: a row for each comes to the driver."""
    rows = entries.groupBy(F.shiftright("key", SHIFT).alias("o")).agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).collect()
    found = {r["o"]: discount(r["n1"], r["n2"]) for r in rows}
    return [found.get(o, 0.5) for o in range(order + 1)]


def key_logs(entries: DataFrame, order: int = ORDER, shard_rows: int = 20_000) -> DataFrame:
    """key, uses and log (natural log-probability) of the codes in use, by shards of the trie."""
    importable(entries.sparkSession)
    discounts = discounts_of(entries, order)
    low = entries.where((F.col("key") < (2 << SHIFT)) & (F.col("n") > 0)).select("key", "n").toArrow()
    low_keys, low_n = low["key"].to_numpy(), low["n"].to_numpy()
    shards = entries.count() // shard_rows + 1
    schema = pa.schema([("key", pa.int64()), ("uses", pa.int64()), ("log", pa.float64())])

    def run(rows: pa.Table) -> pa.Table:
        keys, n, uses = (rows.column(c).to_numpy() for c in ("key", "n", "uses"))
        own = (n > 0) & (keys >= (2 << SHIFT))
        trie = Trie(np.r_[low_keys, keys[own]], np.r_[low_n, n[own]], discounts, order)
        asked = keys[uses > 0]
        return pa.Table.from_arrays([pa.array(asked), pa.array(uses[uses > 0]), pa.array(trie.key_logs(asked))], schema=schema)

    # Contexts of order 2 and more that a byte falls back to share their last two bytes.
    shard = F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND(0xFFFF)), F.lit(shards))
    return entries.withColumn("shard", shard).groupBy("shard").applyInArrow(run, "key long, uses long, log double")


class Model:
    """The corpus's sums, and all words' counts and pairs' log-probabilities as tables, the frequent ones at hand."""

    def __init__(self, words: DataFrame, logs: DataFrame, hot: tuple, documents: int, tokens: int, types: int):
        self.words, self.logs, self.hot, self.documents, self.tokens, self.types = words, logs, hot, documents, tokens, types


class Scorer:
    """The frequent words and pairs ready for texts; one per Python worker."""

    def __init__(self, hot: tuple, documents: int, order: int = ORDER):
        words, counts, self.keys, self.logs = hot
        self.index = {w: i for i, w in enumerate(words.to_pylist())}
        self.known = np.log10(counts + 1.0)
        self.end_known, self.documents, self.order = math.log10(documents + 1), documents, order

    def of(self, texts: list[str | None]) -> tuple[list[tuple], list[tuple[int, bytes, int]], list[tuple[int, int, int]]]:
        """For each text (tokens, known, sum of log10(c + 1), log-probability), the last
        three without what isn't at hand: (text, word, times) and (text, pair, times)."""
        index, rows, words_left, streams = self.index, [], [], []
        for k, words in enumerate(map(tokens, texts)):
            at = np.fromiter([index.get(w, -1) for w in words], dtype=np.int64, count=len(words))
            hot = at >= 0
            if not hot.all():
                words_left += [(k, w, n) for w, n in Counter([words[i] for i in np.flatnonzero(~hot)]).items()]
            rows.append((len(words) + 1, int(hot.sum()) + (self.documents > 0), float(self.known[at[hot]].sum()) + self.end_known))
            streams.append(stream(words, self.order))
        scores, pairs_left = np.zeros(len(texts)), []
        ends = np.cumsum([len(s) for s in streams])
        for a, at, found in full_codes(b"".join(streams), self.order):
            text = np.searchsorted(ends, at + a, side="right")
            # In order of the codes, each beside its place, the look-up goes through the keys once.
            for b in range(0, len(found), 1 << 16):
                both = ((found[b : b + (1 << 16)] & CODE).astype(np.uint64) << np.uint64(16)) | np.arange(min(1 << 16, len(found) - b), dtype=np.uint64)
                both.sort()
                code, own = (both >> np.uint64(16)).astype(np.int64) | (self.order << SHIFT), text[b + (both & np.uint64(0xFFFF)).astype(np.int64)]
                place, has = Trie._find(self.keys, code)
                if has.any():
                    scores += np.bincount(own[has], self.logs[place[has]], len(texts))
                pairs_left += Counter(zip(own[~has].tolist(), code[~has].tolist())).items()
        return [(*r, float(s)) for r, s in zip(rows, scores)], words_left, [(k, key, n) for (k, key), n in pairs_left]


def train(source: DataFrame, documents: int, order: int = ORDER, max_entries: int = 1_000_000, hot_words: int = 250_000) -> Model:
    """A model from the texts of ``source`` (text, learn); ``order`` is five at most."""
    if not 0 < order <= 5:
        raise ValueError(f"contexts of one to five bytes, not {order}")
    words = materialise(count_words(source), "ppm-words")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    pairs = materialise(count_pairs(source, order), "ppm-pairs")
    logs = materialise(key_logs(materialise(contexts_of(pairs, order), "ppm-contexts"), order), "ppm-logs")
    used = _floor(logs, "uses", F.lit(1), max_entries)
    common = logs.where(F.col("uses") >= used).select("key", "log").toArrow()
    order_ = np.argsort(common["key"].to_numpy())
    frequent = max(1, _floor(words, "n", F.lit(1), hot_words))
    hot = words.where(F.col("n") >= frequent).select("word", "n").toArrow()
    # As Arrow columns: the driver makes no Python object for a word.
    at_hand = (hot["word"].combine_chunks(), hot["n"].to_numpy(), common["key"].to_numpy()[order_], common["log"].to_numpy()[order_])
    return Model(words, logs, at_hand, documents, sums["n"] + documents, sums["v"] + (documents > 0))


ROWS = "uid long, doc_id long, n_tokens long, n_known long, base double, score double, word binary, key long, times long"


def score_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Learned from documents whose fold (crc32 of the id, modulo 7) is not 2; a null
    id has no fold, so it is learned from and not held out. ``options`` are those of
    :func:`train`.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learn = F.coalesce(fold(F.col("doc_id"), 7) != 2, F.lit(True))
    model = train(source.select("text", learn.alias("learn")), source.where(learn).count(), **options)
    held, token = send(spark, (model.hot, model.documents, options.get("order", ORDER))), new_token()
    importable(spark)
    schema = spark.createDataFrame([], ROWS).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        scorer = per_worker(token, lambda: Scorer(*received(held)))
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            for a in range(0, b.num_rows, 512):
                ids, texts = (b.column(i).slice(a, 512).to_pylist() for i in (0, 1))
                rows, words, pairs = scorer.of(texts)
                n, w, p = len(rows), len(words), len(pairs)
                none = [None] * (w + p)
                columns = [
                    [*range(uid, uid + n), *[uid + k for k, _, _ in words], *[uid + k for k, _, _ in pairs]], ids + none,
                    *[[r[i] for r in rows] + none for i in range(4)], [None] * n + [x[1] for x in words] + [None] * p,
                    [None] * (n + w) + [x[1] for x in pairs], [None] * n + [x[2] for x in words] + [x[2] for x in pairs],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
                uid += n

    found = materialise(source.mapInArrow(run, schema), "ppm-scores")
    times = F.col("times")
    words = found.where("word is not null").select("uid", "word", "times").join(model.words, "word").groupBy("uid").agg(
        F.sum(F.when(F.col("n") > 0, times).otherwise(0)).alias("more"), F.sum(times * F.log10(F.col("n") + 1.0)).alias("rise"),
    )
    pairs = found.where("key is not null").select("uid", "key", "times").join(model.logs.select("key", "log"), "key").groupBy("uid").agg(F.sum(times * F.col("log")).alias("others"))
    rows = found.where("word is null and key is null").join(words, "uid", "left").join(pairs, "uid", "left")
    floor = math.log10(model.tokens + model.types + 1)
    return rows.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rise", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"),
        ((F.col("score") + F.coalesce("others", F.lit(0.0))) / math.log(10)).alias("score"),
    )
