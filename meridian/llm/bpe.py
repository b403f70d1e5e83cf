"""Byte-pair encoding with a segment tree, and decoding, for vocabularies with ends of words.

A word's adjacent pairs are leaves that hold (rank, position); inner nodes hold the least of their children, so the root
is the leftmost pair of lowest rank. A merge sets three leaves, each in logarithmic time, until the root is empty. Words
repeat, so pieces between white space are kept, up to a bound, with their ids.

Letters, numbers and lower case come from Python's tables where these agree with the vocabulary's library, which is asked
once for each sign. A text with a sign on which they differ, or that Python's tables don't know, is normalised and split by
the library; its words are merged here all the same.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import frugal, keeps, table

#: Fixed values of this vocabulary's splitting rule: contractions, runs of letters, single digits, runs of other signs.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
LETTER = regex.compile(r"\p{L}")
SPACES = regex.compile(r"\s+")
#: White space to str.split() but not to the vocabulary's rule.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Combining marks of several classes, which tell whether another mark is put in order before or after them.
MARKS = "\u0334\u3099\u094d\u0327\u0316\u0301\u0345"
NONE = 1 << 62


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def merged(symbols: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """symbols after all merges; pairs: first << 20 | second -> (rank, merged id)."""
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    get = pairs.get
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        if found := get(symbols[i] << 20 | symbols[i + 1]):
            tree[size + i] = found[0] << 32 | i
    for p in range(size - 1, 0, -1):
        a, b = tree[2 * p], tree[2 * p + 1]
        tree[p] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(at: int, value: int) -> None:
        p = size + at
        if tree[p] == value:
            return
        tree[p] = value
        p >>= 1
        while p:
            a, b = tree[2 * p], tree[2 * p + 1]
            least = a if a < b else b
            if tree[p] == least:
                return
            tree[p] = least
            p >>= 1

    while (top := tree[1]) != NONE:
        i = top & 0xFFFFFFFF
        j = after[i]
        symbols[i] = get(symbols[i] << 20 | symbols[j])[1]
        symbols[j] = -1
        k, h = after[j], before[i]
        after[i] = k
        value = NONE
        if k < n:
            before[k] = i
            if found := get(symbols[i] << 20 | symbols[k]):
                value = found[0] << 32 | i
        if j < n - 1:
            put(j, NONE)
        put(i, value)
        if h >= 0:
            found = get(symbols[h] << 20 | symbols[i])
            put(h, found[0] << 32 | h if found else NONE)
    return [s for s in symbols if s >= 0]


class WordBpe:
    """A vocabulary file's encoder and decoder. ``keep``: words, and pieces between white space, in memory.

    Both are held in two generations of that size: when the young one is full it becomes the old one.
    """

    def __init__(self, path: str, keep: int = 150_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"]
        letters = _byte_letters()
        self.plain = [vocab.get(c, -1) for c in letters]
        self.last = [vocab.get(c + suffix, -1) for c in letters]
        self.pairs = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs[vocab[a] << 20 | vocab[b]] = (rank, vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max(*vocab.values(), *self.special.values()))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.marks = tuple(self.special)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.keep = keep
        self.path, self.library = path, None
        self.safe: set[str] = set()

    def _agrees(self, c: str) -> bool:
        """Whether this module's Unicode tables treat a sign as the vocabulary's library does.

        A sign that they don't know yet never counts as safe: it might combine with its neighbours.
        """
        if self.library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        if unicodedata.category(c) in ("Cn", "Cs") or (c.isalpha() and not LETTER.match(c)):
            return False
        marked = [x for m in MARKS for x in (f"a{c}{m}", f"a{m}{c}")] if unicodedata.combining(c) else []
        return all(self._split(x) == self._pieces(x) for x in (*marked, c, f"a{c}a", f"1{c}1", f"!{c}!", f"' {c}'s", f"a{c}", f"{c}1"))

    def _split(self, text: str) -> list[str]:
        """The words by the library's normalizer and splitting rule."""
        if not text:
            return []
        plain = self.library.normalizer.normalize_str(text)
        return [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def _chunks(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return SPACES.split(text) if any(c in text for c in SEPARATORS) else text.split()

    def _pieces(self, text: str) -> list[str]:
        return [w for chunk in self._chunks(text) for w in PIECES.findall(chunk)]

    def _odd(self, text: str) -> bool:
        """Whether a text has a sign on which the tables differ; signs that were found safe are kept."""
        for c in set(text) - self.safe:
            if not self._agrees(c):
                return True
            self.safe.add(c)
        return False

    def word(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "replace")
        symbols = [self.plain[b] for b in data[:-1]] + [self.last[data[-1]]]
        if -1 in symbols:
            symbols = [s for s in symbols if s >= 0]
        return array("I", merged(symbols, self.pairs)).tobytes() if sys.byteorder == "little" else np.array(merged(symbols, self.pairs), "<u4").tobytes()

    def _word(self, piece: str) -> bytes:
        own = self.old_words.get(piece)
        if own is None:
            own = self.word(piece)
            if len(piece) > 255:
                return own
        if len(self.words) >= self.keep:
            self.old_words, self.words = self.words, {}
        self.words[piece] = own
        return own

    def _piece(self, chunk: str) -> bytes:
        out = self.old.get(chunk)
        if out is None:
            get, new = self.words.get, self._word
            out = b"".join([get(w) or new(w) for w in ((chunk,) if chunk.isalpha() else PIECES.findall(chunk))])
        if len(chunk) < 256:
            if len(self.known) >= self.keep:
                self.old, self.known = self.known, {}
            self.known[chunk] = out
        return out

    def _plain(self, text: str) -> bytes:
        if not text.isascii() and self._odd(text):
            return b"".join([self.words.get(w) or self._word(w) for w in self._split(text)])
        return b"".join([self._piece(c) if (own := self.known.get(c)) is None else own for c in self._chunks(text)])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if any(mark in text for mark in self.marks):
            parts = self.split.split(text)
            return b"".join(self.special[p].to_bytes(4, "little") if i % 2 else self._plain(p) for i, p in enumerate(parts))
        return self._plain(text)

    def decode(self, ids: bytes) -> str:
        """Tokens in their written form, with a space between them."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


keeps("bpe", vocabulary.cache_clear)


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, ids array<int>); null and empty texts have no ids, repeated rows and null ids stay."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal("bpe")
        bpe = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = [np.frombuffer(bpe.encode(t), "<i4") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) -> (doc_id, text)."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal("bpe")
        bpe = vocabulary(path)
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes and decodes whole texts; a row a document with the digests of both."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal("bpe")
        bpe = vocabulary(path)
        for batch in batches:
            made = []
            for t in batch.column(1).to_pylist():
                ids = bpe.encode(t)
                made.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()))
            n, a, b = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents' whole texts, encoded and decoded: null and empty texts have no ids, repeated and null doc_ids keep a row
    each, an empty table gives no rows, other columns are ignored."""
    return digests(table(spark, sf_dir, "documents"))
