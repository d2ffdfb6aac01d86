"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public vocabulary.
The probability of a word in a language is the sum over all ways to cut the word
into pieces, which a forward algorithm adds up; a text's is the product over its
words. Piece probabilities come from expectation maximisation (forward-backward
over words) on a bounded sample of labelled documents.

Defined results: ``und`` with score 0.0 where the text is null or has no letter,
and everywhere if no row carries a label; words are runs of letters, lower case;
whole texts count, whatever their length; repeated rows give repeated results;
ties between languages go to the first in code-point order. Extra columns of the
input are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.llm.common import fold, importable, map_rows, materialise, new_token, per_worker, received, release, send, small_batches

UNDETERMINED = "und"
#: Marks a word's start, as in the vocabulary file.
START = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
#: The same without the signs of numbers that `\w` holds, such as ½ or Ⅷ; slower.
ONLY_LETTERS = re.compile(r"[^\W\d_%s]+" % "".join(c for c in map(chr, range(0x20000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()))
#: Longer words are added up in logarithms.
LONG_WORD = 40
#: A model has a table of all pieces for each language; more languages are refused.
MOST_LANGUAGES = 500


def words(text: str) -> list[str]:
    """Runs of letters."""
    found = LETTERS.findall(text)
    return found if "".join(found).isalpha() else [w for part in found for w in ONLY_LETTERS.findall(part)]


def load_pieces(path: str) -> list[str]:
    """Lower-case letter pieces of a sentencepiece file (a few tens of thousands)."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {processor.id_to_piece(i) for i in range(processor.get_piece_size()) if not processor.is_control(i)}
    return sorted(p for p in pieces if (body := p.removeprefix(START)) and body.isalpha() and body == body.lower())


class Lattice:
    """The segmentations of words into pieces of a vocabulary."""

    def __init__(self, pieces: list[str]):
        self.unknown = len(pieces)
        self.ids = dict.fromkeys((p[:i] for p in pieces for i in range(1, len(p))), -1)
        self.ids.update((p, i) for i, p in enumerate(pieces))

    def arcs(self, word: str) -> list[tuple[int, int, int]]:
        """(start, end, piece's number) by start; a lone character is always one."""
        marked, n, get, out = START + word, len(word) + 1, self.ids.get, []
        for i in range(n):
            first, lone = (2 if i == 0 else i + 1), True
            for j in range(i + 1, n + 1):
                piece = get(marked[i:j])
                if piece is None:
                    break
                if piece >= 0:
                    out.append((i, j, piece))
                    lone &= j != first
            if lone:
                out.append((i, first, self.unknown))
        return out


class Model:
    """Piece probabilities by language; the last one is that of an unknown character."""

    def __init__(self, languages: list[str], pieces: list[str], priors: list[float], counts: dict[str, dict[int, float]], smoothing: float = 0.1):
        self.languages, self.priors = languages, priors
        self.lattice = Lattice(pieces)
        size = len(pieces) + 1
        self.p: list[list[float]] = []
        for x in languages:
            own = counts.get(x, {})
            whole = sum(own.values()) + smoothing * size
            self.p.append([(own.get(i, 0.0) + smoothing) / whole for i in range(size)])

    def word(self, word: str) -> list[float]:
        """Log-probability of a word in each language, over all segmentations."""
        arcs, n = self.lattice.arcs(word), len(word) + 1
        if n > LONG_WORD:
            return [self._scaled(arcs, n, p) for p in self.p]
        out = []
        for p in self.p:
            alpha = [0.0] * (n + 1)
            alpha[0] = 1.0
            for i, j, piece in arcs:
                alpha[j] += alpha[i] * p[piece]
            out.append(math.log(alpha[n]))
        return out

    @staticmethod
    def _scaled(arcs: list[tuple[int, int, int]], n: int, p: list[float]) -> float:
        """The same for words whose probabilities would underflow: in logarithms."""
        alpha = [-math.inf] * (n + 1)
        alpha[0] = 0.0
        for i, j, piece in arcs:
            alpha[j] = _log_sum(alpha[j], alpha[i] + math.log(p[piece]))
        return alpha[n]

    def expected(self, word: str, language: int, weight: float, into: dict[int, float]) -> None:
        """Adds the expected counts of pieces in a word, by forward-backward."""
        n = len(word) + 1
        arcs, p = self.lattice.arcs(word), self.p[language]
        if n > LONG_WORD:
            self._expected_scaled(arcs, n, p, weight, into)
            return
        alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
        alpha[0] = beta[n] = 1.0
        for i, j, piece in arcs:
            alpha[j] += alpha[i] * p[piece]
        for i, j, piece in reversed(arcs):
            beta[i] += p[piece] * beta[j]
        scale = weight / alpha[n]
        for i, j, piece in arcs:
            into[piece] += alpha[i] * p[piece] * beta[j] * scale

    @staticmethod
    def _expected_scaled(arcs: list[tuple[int, int, int]], n: int, p: list[float], weight: float, into: dict[int, float]) -> None:
        """The same for long words, in logarithms."""
        alpha, beta = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
        alpha[0] = beta[n] = 0.0
        for i, j, piece in arcs:
            alpha[j] = _log_sum(alpha[j], alpha[i] + math.log(p[piece]))
        for i, j, piece in reversed(arcs):
            beta[i] = _log_sum(beta[i], beta[j] + math.log(p[piece]))
        for i, j, piece in arcs:
            into[piece] += weight * math.exp(alpha[i] + math.log(p[piece]) + beta[j] - alpha[n])


def _log_sum(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


class Scorer:
    """Scores texts with a cache of words; one per Python worker."""

    def __init__(self, model: Model, cells: int = 1_200_000):
        self.model = model
        self.limit = max(1000, min(300_000, cells // max(1, len(model.languages))))
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.model.languages)))

    def add(self, word: str) -> int:
        at = len(self.index)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = self.model.word(word)
        self.index[word] = at
        return at

    def score(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its posterior probability."""
        found = words(text.lower()) if text else []
        if not found or not self.model.languages:
            return UNDETERMINED, 0.0
        logs, index, add = np.array(self.model.priors), self.index, self.add
        for a in range(0, len(found), 500):
            if len(index) + 500 > self.limit:
                self.reset()
                index = self.index
            at = [index[w] if w in index else add(w) for w in found[a : a + 500]]
            logs += self.rows[at].sum(axis=0)
        best = int(np.argmax(logs))
        return self.model.languages[best], float(1.0 / np.exp(logs - logs[best]).sum())


def _word_counts(sample: DataFrame) -> DataFrame:
    def make():
        release()

        def step(rows):
            counts: Counter = Counter()
            for lang, text in zip(rows["lang"], rows["text"]):
                counts.update([(lang, w) for w in words(text.lower())])
            return {"lang": [k[0] for k in counts], "word": [k[1] for k in counts], "n": list(counts.values())}

        return step

    return map_rows(sample, "lang string, word string, n long", make).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    lang: str = "lang",
    where=None,
    max_docs: int = 150,
    iterations: int = 2,
) -> Model:
    """A model from labelled documents.

    ``max_docs`` bounds the sample for each language, chosen by a hash of the
    row; ``where`` filters the rows that may be learned from. What comes to the
    driver is one count for each language and piece.
    """
    spark = docs.sparkSession
    pieces = load_pieces(vocabulary)
    rows = docs if where is None else docs.where(where)
    key = ["__key"] if "doc_id" in docs.columns else []
    rows = rows.select(*[F.col("doc_id").alias(k) for k in key], F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null").withColumn("h", F.xxhash64(*key, "text"))
    per = _cuts(rows, max_docs)
    if not per:
        return Model([], pieces, [], {})
    languages = sorted(per)
    total = sum(n for n, _ in per.values())
    priors = [math.log(per[x][0] / total) for x in languages]
    picked = F.lit(False)
    for x in languages:
        picked = picked | ((F.col("lang") == x) & (F.col("h") <= per[x][1]))
    counted = materialise(_word_counts(rows.where(picked).select("lang", "text")), "language-words")
    model = Model(languages, pieces, priors, {})
    for _ in range(iterations):
        held = send(spark, model)

        def make(held=held):
            model = received(held)
            at = {x: i for i, x in enumerate(model.languages)}

            def step(rows):
                got: dict[str, dict[int, float]] = defaultdict(lambda: defaultdict(float))
                for lang, word, n in zip(rows["lang"], rows["word"], rows["n"]):
                    model.expected(word, at[lang], n, got[lang])
                flat = [(x, p, c) for x, d in got.items() for p, c in d.items()]
                return {"lang": [f[0] for f in flat], "piece": [f[1] for f in flat], "n": [f[2] for f in flat]}

            return step

        counts: dict[str, dict[int, float]] = defaultdict(dict)
        expected = map_rows(counted, "lang string, piece int, n double", make, rows=1 << 16)
        # One number for each language and piece, as columns.
        for batch in expected.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow().to_batches(1 << 16):
            for lang, piece, n in zip(*(c.to_pylist() for c in batch.columns)):
                counts[lang][piece] = n
        held.destroy()
        model = Model(languages, pieces, priors, dict(counts))
    return model


def _cuts(rows: DataFrame, max_docs: int) -> dict[str, tuple[int, int]]:
    """For each language: its number of rows, and the hash up to which a row is taken.

    Hashes are even over 64 bits, so the cut at a share of the range takes that
    share of the rows; languages with few rows are taken whole.
    """
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: each has a table of all pieces")
    out = {}
    for r in found:
        share = min(1.0, max_docs / r["n"])
        out[r["lang"]] = (r["n"], (1 << 63) - 1 if share == 1 else int(-(1 << 63) + share * (1 << 64)))
    return out


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score`` for each row."""
    held, token = send(docs.sparkSession, model), new_token()
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def make():
        scorer = per_worker(token, lambda: Scorer(received(held)))

        def step(rows):
            got = [scorer.score(t) for t in rows["__text"]]
            return {c: rows[c] for c in keep} | {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

        return step

    return map_rows(source, fields + ", lang_pred string, score double", make)


def accept(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language, with a score of at least ``least``."""
    held, token = send(docs.sparkSession, model), new_token()
    importable(docs.sparkSession)
    small_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def accepted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = per_worker(token, lambda: Scorer(received(held)))
        for texts in batches:
            found = [scorer.score(t) for t in texts]
            yield pd.Series([lang != UNDETERMINED and score >= least for lang, score in found], dtype=bool)

    return docs.where(accepted(F.col(f"`{text}`").cast("string")))


def predict(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every document.

    Learned from documents whose fold (crc32 of the id, modulo 3) is not 1; a
    null id has no fold, so it is learned from and not held out.
    """
    model = train(docs, vocabulary, where=F.coalesce(fold(F.col("doc_id"), 3) != 1, F.lit(True)))
    found = identify(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
