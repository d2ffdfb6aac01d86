"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never end up inside one
token, whatever the merges do, so every such pair marks a certain cut. A word
is cut there, the fragments are encoded independently, and their ids are
concatenated. The result equals plain BPE over the uncut word.

The vocabulary is of the kind with word ends: NFC, lower case, white space
dropped, one word per regular-expression match, ``</w>`` after the last byte.

Defined results: null text is empty text, which encodes to no ids; the texts of
special tokens become their ids; repeated rows give repeated results; extra
columns are dropped by the digest and kept by :func:`encode`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from operator import add

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.llm.common import importable, map_rows, per_worker, small_batches

#: Fixed values of the byte-level alphabet: bytes that stand for themselves.
PRINTABLE_BYTES = [range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100)]
#: Fixed value: the Unicode property White_Space, as a character class.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
#: Characters that str.split() takes for white space and the property does not.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
#: A fragment longer than this is merged with a heap rather than by rescanning.
LONG_FRAGMENT = 48
#: Longer runs are encoded but not kept.
LONGEST_CACHED = 64
NO_RANK = 1 << 60


def byte_alphabet() -> list[str]:
    """The character that stands for each byte."""
    own = {b for r in PRINTABLE_BYTES for b in r}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """What a tokenizer file of this kind holds."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern: str = splits[0]["pattern"]["Regex"]
        self.pairs: set[str] = set()
        for token in self.ids:
            body = token.removesuffix(self.end) if self.end else token
            self.pairs.update(a + b for a, b in zip(body, body[1:]))
        alphabet = byte_alphabet()
        texts = dict.fromkeys([*alphabet, *[c + self.end for c in alphabet], *[t for a, b in merges for t in (a, b, a + b)]])
        #: Symbols are numbered; ``made`` has the symbol of each merge, ``ranks`` the merge of a left symbol * size + a right one.
        self.number: dict[str, int] = {t: i for i, t in enumerate(texts)}
        self.id_of: list[int | None] = [self.ids.get(t) for t in texts]
        self.size = len(texts)
        self.ranks: dict[int, int] = {self.number[a] * self.size + self.number[b]: i for i, (a, b) in enumerate(merges)}
        self.made: list[int] = [self.number[a + b] for a, b in merges]
        #: The merge of each pair of characters that some token holds, before a word's last.
        self.first: dict[str, int] = {p: self.ranks.get(self.number.get(p[0], -1) * self.size + self.number.get(p[1], -1), NO_RANK) for p in self.pairs}


class Encoder:
    """Encodes words with a cache; one per task.

    A cache has a younger and an older half of ``cache_words`` each: a full younger
    half replaces the older one, and what is met again in the older half goes into
    the younger one, so that frequent words are never forgotten. What is kept of a
    word are its ids, four bytes each; their texts are looked up by text.
    """

    def __init__(self, vocabulary: Vocabulary, cache_words: int = 80_000):
        self.v = vocabulary
        self.limit = cache_words
        self.cache: dict[str, bytes] = {}
        self.older_cache: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older_known: dict[str, bytes] = {}
        self.alphabet = byte_alphabet()
        self.words = regex.compile(vocabulary.pattern)
        self.tokens = {i: t for t, i in [*vocabulary.ids.items(), *vocabulary.special.items()]}
        self.id_texts = {i: str(i) for i in self.tokens}
        self.split = re.compile(f"[{WHITE_SPACE}]+")
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")")

    def merged(self, symbols: list[int], ranks: list[int]) -> list[int]:
        """Merges the lowest-ranked pair, leftmost first, until none is left; ``ranks`` has the pairs' ranks."""
        if len(symbols) > LONG_FRAGMENT:
            return self._merged_by_heap(symbols)
        get, made, size = self.v.ranks.get, self.v.made, self.v.size
        while ranks and (best := min(ranks)) != NO_RANK:
            i = ranks.index(best)
            symbols[i] = new = made[best]
            del symbols[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(symbols[i - 1] * size + new, NO_RANK)
            if i < len(ranks):
                ranks[i] = get(new * size + symbols[i + 1], NO_RANK)
        return symbols

    def _merged_by_heap(self, symbols: list[int]) -> list[int]:
        ranks, made, size, n = self.v.ranks, self.v.made, self.v.size, len(symbols)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get(a * size + b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i], symbols[j] = made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := ranks.get(symbols[a] * size + symbols[b])) is not None:
                    heapq.heappush(heap, (r, a, symbols[a], symbols[b]))
        return [s for s in symbols if s >= 0]

    def word_symbols(self, word: str) -> list[int]:
        """Symbols of one regular-expression match, which is cut at every pair no token holds."""
        v = self.v
        mapped = word if word.isascii() and word.isprintable() else "".join([self.alphabet[b] for b in word.encode()])
        symbols = list(map(v.number.__getitem__, mapped))
        symbols[-1] = v.number[mapped[-1] + v.end]
        ranks = list(map(v.first.get, map(add, mapped, mapped[1:])))
        if ranks and ranks[-1] is not None:
            ranks[-1] = v.ranks.get(symbols[-2] * v.size + symbols[-1], NO_RANK)
        if None not in ranks:
            return self.merged(symbols, ranks)
        out: list[int] = []
        start = 0
        for cut in [*[i for i, rank in enumerate(ranks, 1) if rank is None], len(symbols)]:
            out += self.merged(symbols[start:cut], ranks[start : cut - 1])
            start = cut
        return out

    def word(self, word: str) -> bytes:
        """Ids of one match."""
        got = self.known.get(word)
        if got is None:
            got = self.older_known.get(word)
            if got is None:
                got = array("i", map(self.v.id_of.__getitem__, self.word_symbols(word))).tobytes()
            if len(self.known) >= self.limit:
                self.known, self.older_known = {}, self.known
            if len(word) <= LONGEST_CACHED:
                self.known[word] = got
        return got

    def lookup(self, raw: str) -> bytes:
        """Ids of a run without white space."""
        got = self.cache.get(raw)
        if got is None:
            got = self.older_cache.get(raw)
            if got is None:
                got = self.run(raw)
            if len(self.cache) >= self.limit:
                self.cache, self.older_cache = {}, self.cache
            if len(raw) <= LONGEST_CACHED:
                self.cache[raw] = got
        return got

    def run(self, raw: str) -> bytes:
        """The same, not looked up."""
        text = raw.lower()
        if not raw.isascii():
            # Each character by itself: a sigma at a word's end stays a plain one.
            text = "".join([c.lower() for c in unicodedata.normalize("NFC", raw)])
        if text.isalpha():
            return self.word(text)
        if text[-1] in ".,!?;:" and text[:-1].isalpha():
            words = [text[:-1], text[-1]]
        else:
            words = self.words.findall(text)
        if len(words) == 1:
            return self.word(words[0])
        return b"".join([self.word(w) for w in words])

    def runs(self, text: str) -> list[str]:
        """Runs without white space, as ``\\s`` of the tokenizer sees it."""
        if any(c in text for c in SEPARATORS):
            return [r for r in self.split.split(text) if r]
        return text.split()

    def array(self, text: str | None) -> np.ndarray:
        """Ids of a whole text, four bytes each."""
        found: list[bytes] = []
        if text and "<|" in text:
            for part in self.special.split(text):
                if part in self.v.special:
                    found.append(array("i", [self.v.special[part]]).tobytes())
                else:
                    found += [self.lookup(r) for r in self.runs(part)]
        elif text:
            cache, lookup = self.cache, self.lookup
            found = [cache.get(r) or lookup(r) for r in self.runs(text)]
        return np.frombuffer(b"".join(found), dtype=np.int32)

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Count, ids and tokens (each joined by a space) of a whole text."""
        ids = self.encode(text)
        return len(ids), " ".join([self.id_texts[i] for i in ids]), " ".join([self.tokens[i] for i in ids])

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text."""
        return self.array(text).tolist()

    def decode(self, ids: list[int] | None) -> str:
        """Tokens joined by a space: what a tokenizer file without a decoder gives."""
        return " ".join(self.tokens[i] for i in (ids if ids is not None else ()))

    def restore(self, ids: list[int] | None) -> str:
        """Readable text: bytes decoded, word ends as spaces."""
        byte = {c: b for b, c in enumerate(self.alphabet)}
        out = bytearray()
        for i in ids if ids is not None else ():
            token = self.tokens[i]
            if token in self.v.special:
                out += token.encode()
                continue
            ends = bool(self.v.end) and token.endswith(self.v.end)
            out += bytes(byte[c] for c in (token.removesuffix(self.v.end) if ends else token))
            out += b" " * ends
        return out.decode("utf-8", "replace")


def worker_encoder(text: str) -> Encoder:
    """The encoder of this Python worker for a tokenizer file's text."""
    return per_worker(text, lambda: Encoder(Vocabulary(text)))


def _shared(df: DataFrame, path: str):
    """The vocabulary file's text (a few MB, fixed), for every executor."""
    importable(df.sparkSession)
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a column ``out`` of ids (array<int>); replaces one of that name."""
    held = _shared(docs, path)
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != out]

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = worker_encoder(held.value)
        for texts in batches:
            yield pd.Series([encoder.array(t) for t in texts], dtype=object)

    return docs.select(*[F.col(f"`{c}`") for c in kept], ids(F.col(f"`{text}`")).alias(out))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the tokens of ``ids`` joined by a space; null ids give empty text."""
    held = _shared(df, path)
    kept = [c for c in df.columns if c != out]

    @F.pandas_udf("string")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = worker_encoder(held.value)
        for rows in batches:
            yield rows.map(encoder.decode)

    return df.select(*[F.col(f"`{c}`") for c in kept], tokens(F.col(f"`{ids}`")).alias(out))


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_tokens, ids_sha256 and decoded_sha256.

    One pass without a shuffle: a document is encoded, decoded and hashed where
    it is read.
    """
    held = _shared(docs, path)
    columns = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def make():
        encoder = worker_encoder(held.value)

        def step(rows):
            got = [encoder.digest(t) for t in rows["text"]]
            return {
                "doc_id": rows["doc_id"],
                "n_tokens": [g[0] for g in got],
                "ids_sha256": [hashlib.sha256(g[1].encode()).hexdigest() for g in got],
                "decoded_sha256": [hashlib.sha256(g[2].encode()).hexdigest() for g in got],
            }

        return step

    return map_rows(columns, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
