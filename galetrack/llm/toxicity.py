"""Toxicity by gradient-boosted trees over dense features, with calibration.

Features of a whole text: densities and counts of two lexicons (a fixed list, and
words that the labelled sample shows to mark toxic texts), how near second-person
words stand to lexicon words, shares of capitals, digits and punctuation, and the
rate of obfuscated words. Trees are boosted on the logistic loss; an isotonic
regression turns their output into probabilities. It is fitted on margins of all
labelled rows, each from trees (and a learned lexicon) that didn't see its part of
the sample, so that few labels are enough.

Defined results: null text counts as empty; empty texts get the score that the
trees give to all-zero features; without any label, or with labels of one class
only, the score is that class's share (0.5 without rows); repeated rows give
repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.llm.common import fold, importable, map_rows, materialise, new_token, per_worker, received, release, send, small_batches

#: Common insults, in natural order.
INSULTS = """
arse ass asshole bastard bitch bollocks bullshit clown coward creep cretin crap cunt damn degenerate
dick dimwit disgusting douche dumb dumbass dunce fag filth fool freak fuck fucking garbage halfwit hate
idiot idiotic idiots ignorant imbecile jackass jerk kill liar loser losers lowlife lunatic maggot
moron moronic morons nazi nobody parasite pathetic pig prick psycho pussy retard retarded scum scumbag
shit shithead shut sick slut stupid sucker swine terrible trash twat ugly useless vermin vile wanker
whore worthless wretched
""".split()
#: Words that address a reader, in the languages of the corpus.
SECOND_PERSON = """
you your yours yourself ur u thou thee
tu te toi ton ta tes vous votre vos
du dich dir dein deine deiner ihr euch euer
usted ustedes tú ti vosotros
""".split()
#: Characters that stand for letters in obfuscated words.
LEET = str.maketrans("013457@$!|+", "oieastasilt")

FIXED, LEARNED, PERSON, HIDDEN, STRETCHED = 1, 2, 4, 8, 16
FEATURES = (
    "insult_density", "insult_count", "learned_density", "learned_count", "distinct_hits", "near_person", "person_density",
    "capital_share", "digit_share", "punct_share", "bang_share", "hidden_rate", "stretched_rate", "log_words", "word_length", "line_rate",
)
NEAR = 4
BARE = re.compile(r"[\W_]+")
TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…“”‘’«»¡¿"
THREE = re.compile(r"(.)\1\1")


class Features:
    """Dense features of texts, with a cache of words; one per Python worker."""

    def __init__(self, insults: list[str], learned: list[str], cache_words: int = 60_000):
        self.insults, self.learned, self.limit = frozenset(insults), frozenset(learned), cache_words
        self.person = frozenset(SECOND_PERSON)
        self.cache: dict[str, int] = {}

    def kind(self, run: str) -> int:
        """Bits for a lower-case run without white space."""
        word, bits = run.strip(TRIM), 0
        if word and not word.isalpha():
            plain = BARE.sub("", word.translate(LEET))
            if plain.isalpha() and any(c.isalpha() for c in word):
                if "'" not in word and "-" not in word and "|" not in word:
                    bits |= HIDDEN
                word = plain
        if THREE.search(word):
            bits |= STRETCHED
        if word in self.insults:
            bits |= FIXED
        if word in self.learned:
            bits |= LEARNED
        if word in self.person:
            bits |= PERSON
        if len(self.cache) >= self.limit:
            self.cache.clear()
        if len(run) <= 64:
            self.cache[run] = bits
        return bits

    def of(self, text: str | None) -> list[float]:
        text = text or ""
        runs = text.lower().split()
        n = len(runs)
        if not n:
            return [0.0] * len(FEATURES)
        cache, kind = self.cache, self.kind
        bits = [cache[r] if r in cache else kind(r) for r in runs]
        marked = [i for i, b in enumerate(bits) if b] if any(bits) else []
        hits = [i for i in marked if bits[i] & (FIXED | LEARNED)]
        persons = [i for i in marked if bits[i] & PERSON]
        fixed = sum(1 for i in hits if bits[i] & FIXED)
        learned = sum(1 for i in hits if bits[i] & LEARNED)
        near, at = 0, 0
        for i in hits:
            while at < len(persons) and persons[at] < i - NEAR:
                at += 1
            near += at < len(persons) and persons[at] <= i + NEAR
        raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
        upper, lower, digits = raw[65:91].sum(), raw[97:123].sum(), raw[48:58].sum()
        punct = raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum()
        chars = len(text)
        return [
            fixed / n, float(fixed), learned / n, float(learned), float(len({runs[i].strip(TRIM) for i in hits})), near / max(1, len(hits)), len(persons) / n,
            upper / max(1, upper + lower), digits / chars, punct / chars, (raw[33] + raw[63]) / chars,
            sum(1 for i in marked if bits[i] & HIDDEN) / n, sum(1 for i in marked if bits[i] & STRETCHED) / n,
            float(np.log1p(n)), chars / n, raw[10] / n,
        ]


class Trees:
    """Boosted regression trees over binned features (logistic loss)."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, least: float = 8.0, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = min(max(y.mean(), 1e-4), 1 - 1e-4)
        self.base = float(np.log(share / (1 - share)))
        grid = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c[c != 0], grid)) if (c != 0).any() else np.array([0.0]) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)
        out = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-out))
            out += self._grow(binned, p - y, p * (1 - p))
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Adds a complete tree of the given depth; returns what it adds to each row."""
        nodes = (1 << self.depth) - 1
        feature, cut = np.zeros(nodes, int), np.full(nodes, 1 << 30)
        at = np.zeros(len(g), int)
        width = self.bins + 1
        for node in range(nodes):
            rows = np.flatnonzero(at == node)
            if len(rows):
                gr, hr, best = g[rows], h[rows], 1e-6
                whole = gr.sum() ** 2 / (hr.sum() + self.ridge)
                for f in range(b.shape[1]):
                    code = b[rows, f]
                    gl, hl = np.cumsum(np.bincount(code, gr, width)), np.cumsum(np.bincount(code, hr, width))
                    gain = gl**2 / (hl + self.ridge) + (gl[-1] - gl) ** 2 / (hl[-1] - hl + self.ridge) - whole
                    n = np.cumsum(np.bincount(code, minlength=width))
                    gain[(n < self.least) | (n[-1] - n < self.least)] = 0
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, feature[node], cut[node] = gain[k], f, k
            at[rows] = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
        leaf = at - nodes
        count = nodes + 1
        value = -self.rate * np.bincount(leaf, g, count) / (np.bincount(leaf, h, count) + self.ridge)
        self.trees.append((feature, cut, value))
        return value[leaf]

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), self.base)
        b = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            out += value[at - len(feature)]
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: right ends of the pools and their means, both rising."""
    order = np.argsort(x, kind="stable")
    ends: list[float] = []
    sums: list[list[float]] = []
    for a, b in zip(x[order], y[order]):
        if ends and ends[-1] == a:
            sums[-1][0] += b
            sums[-1][1] += 1
        else:
            ends.append(float(a))
            sums.append([float(b), 1.0])
        while len(sums) > 1 and sums[-2][0] * sums[-1][1] >= sums[-1][0] * sums[-2][1]:
            s, n = sums.pop()
            sums[-1][0] += s
            sums[-1][1] += n
            ends[-2:] = ends[-1:]
    return np.array(ends), np.array([s / n for s, n in sums])


class Model:
    """Features, trees and calibration."""

    def __init__(self, insults: list[str], learned: list[str]):
        self.insults, self.learned = list(insults), list(learned)
        self.trees, self.curve = Trees(), (np.array([]), np.array([]))

    def fit(self, x: list[np.ndarray], y: np.ndarray, part: np.ndarray) -> Model:
        """Trees on all rows, calibrated on margins that the other parts' trees give each part.

        ``x[p]`` holds all rows' features under the lexicon of the parts other than
        ``p``; the last one those under the lexicon of all.
        """
        if len(y) == 0 or y.min() == y.max():
            share = float(y.mean()) if len(y) else 0.5
            self.curve = (np.array([0.0]), np.array([share]))
            return self
        # A leaf may hold as few rows as an eighth of the rarer class has.
        least = min(8.0, max(2.0, min(y.sum(), len(y) - y.sum()) / 8))
        self.trees = Trees(least=least).fit(x[-1], y)
        margins = self.trees.margin(x[-1])
        for p in range(len(x) - 1):
            own = part == p
            if own.any() and len(set(y[~own])) == 2:
                margins[own] = Trees(least=least).fit(x[p][~own], y[~own]).margin(x[p][own])
        self.curve = isotonic(margins, y)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities: the pools' means."""
        ends, means = self.curve
        if len(means) < 2:
            return np.full(len(x), float(means[0]) if len(means) else 0.5)
        m = self.trees.margin(x)
        pool = np.minimum(np.searchsorted(ends, m, side="left"), len(ends) - 1)
        # The margin breaks ties inside a pool without leaving it.
        return np.clip(means[pool] + 1e-6 / (1 + np.exp(-m)) * (1 - 2 * means[pool]), 0, 1)


def learned_lexicons(sample: DataFrame, parts: int, most: int = 100, least: int = 4, lift: float = 3.0) -> list[list[str]]:
    """Words whose document frequency marks toxic texts, by smoothed odds: without each part, and of all.

    ``sample`` has text, toxic (0 or 1) and part. Documents are counted on the
    executors; at most ``most`` words a list come to the driver.
    """

    def make():
        release()

        def step(rows):
            out = []
            for text, toxic, part in zip(rows["text"], rows["toxic"], rows["part"]):
                words = {r.strip(TRIM) for r in text.lower().split()}
                out += [(w, toxic, part) for w in words if w.isalpha()]
            return {c: [o[i] for o in out] for i, c in enumerate(("word", "toxic", "part"))}

        return step

    found = map_rows(sample.select("text", "toxic", "part"), "word string, toxic int, part int", make)
    bad, good = F.col("toxic") == 1, F.col("toxic") == 0
    sizes = {(r["part"], r["toxic"]): r["n"] for r in sample.groupBy("part", "toxic").agg(F.count("*").alias("n")).collect()}
    held = [*range(parts), None]
    other = [F.lit(True) if p is None else F.col("part") != p for p in held]
    counts = found.groupBy("word").agg(*[F.count_if(which & o).alias(f"{n}{i}") for i, o in enumerate(other) for n, which in (("b", bad), ("g", good))])
    counts = materialise(counts.where(F.col(f"b{parts}") >= least), "toxicity-words")
    out = []
    for i, p in enumerate(held):
        nb, ng = (max(1, sum(n for (q, t), n in sizes.items() if q != p and t == label)) for label in (1, 0))
        odds = (F.col(f"b{i}") / nb) / ((F.col(f"g{i}") + 0.5) / ng)
        words = counts.where((F.col(f"b{i}") >= max(least, 0.01 * nb)) & (odds >= lift)).orderBy(odds.desc(), "word").limit(most)
        out.append([r["word"] for r in words.select("word").collect()])
    return out


def train(docs: DataFrame, labels: DataFrame, where=None, max_rows: int = 6000, insults: list[str] = INSULTS, parts: int = 4) -> Model:
    """A model from labelled documents, joined by doc_id.

    ``max_rows`` bounds the sample, chosen by a hash of the id, and the rows whose
    features come to the driver (numbers only; repeated ids can't exceed it).
    ``where`` filters the documents that may be learned from.
    """
    rows = docs if where is None else docs.where(where)
    rows = rows.where("doc_id is not null").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    hashed = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    n = marks.count()
    if n > max_rows:
        share = max_rows / n
        marks = marks.where(hashed <= int(-(1 << 63) + share * (1 << 64)))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts)).cast("int")
    sample = materialise(rows.join(F.broadcast(marks), "doc_id").select("doc_id", "text", "toxic", part.alias("part")), "toxicity-sample")
    lexicons = learned_lexicons(sample, parts)
    held = send(docs.sparkSession, (insults, lexicons))

    def make():
        insults, lexicons = received(held)
        makers = [Features(insults, words) for words in lexicons]

        def step(rows):
            return {c: rows[c] for c in ("doc_id", "h", "toxic", "part")} | {"x": [[v for m in makers for v in m.of(t)] for t in rows["text"]]}

        return step

    numbers = map_rows(sample.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("h"), "toxic", "part", "text"), "doc_id string, h long, toxic int, part int, x array<double>", make, rows=64)
    got = numbers.orderBy(F.xxhash64("doc_id"), "h").limit(max_rows + max_rows // 4).collect()
    held.destroy()
    x = np.array([r["x"] for r in got]).reshape(len(got), parts + 1, len(FEATURES))
    y, at = np.array([float(r["toxic"]) for r in got]), np.array([r["part"] for r in got], dtype=int)
    return Model(insults, lexicons[-1]).fit([x[:, i] for i in range(parts + 1)], y, at)


def _ready(model: Model) -> tuple[Model, Features]:
    return model, Features(model.insults, model.learned)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score`` and ``predicted`` for each row."""
    held, token = send(docs.sparkSession, model), new_token()
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def make():
        fitted, maker = per_worker(token, lambda: _ready(received(held)))

        def step(rows):
            p = fitted.score(np.array([maker.of(t) for t in rows["__text"]]).reshape(-1, len(FEATURES)))
            return {c: rows[c] for c in keep} | {"score": p.tolist(), "predicted": (p >= 0.5).astype(int).tolist()}

        return step

    return map_rows(source, fields + ", score double, predicted int", make)


def accept(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5."""
    held, token = send(docs.sparkSession, model), new_token()
    importable(docs.sparkSession)
    small_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def accepted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted, maker = per_worker(token, lambda: _ready(received(held)))
        for texts in batches:
            x = np.array([maker.of(t) for t in texts]).reshape(-1, len(FEATURES))
            yield pd.Series(fitted.score(x) < 0.5)

    return docs.where(accepted(F.col(f"`{text}`").cast("string")))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    Learned from documents whose fold (crc32 of the id, modulo 5) is not 0; a
    null id has no fold and no label and is not held out.
    """
    model = train(docs.select("doc_id", "text"), labels, where=fold(F.col("doc_id"), 5) != 0)
    found = score(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
