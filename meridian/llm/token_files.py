"""Token-id files: bit-plane shuffled, compressed id blocks with a chunk index.

Documents are range-sorted by id; each partition cuts its run into files of about ``ids_per_file`` ids. A file:

    magic "MTOK", version, planes a block, ids a block, documents, ids (little-endian)
    the documents' ids and token counts, zstandard
    chunk index: offset and length of every plane of every block, then the planes

A block of ids is a matrix of 32 bits an id, transposed to byte planes or bit planes; each plane is a zstandard frame of
its own, so that a reader can fetch a block, or the high planes alone, by the index. Files are rows of a Parquet table in
the session's shared folder, which any store that Spark reaches can hold.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.bpe import default_path
from meridian.llm.common import frugal, keeps, stored, table, trimmed

MAGIC, VERSION = b"MTOK", 1
HEAD = struct.Struct("<4sHHIQQQ")
UNITS = regex.compile(r"\s*\S+|\s+")
#: Texts for the general rule: empty ones, white space at the ends, doubled, or other than the blank and the line end.
ODD = r"^$|^[ \n]|[ \n]$|[ \n][ \n]|[\x00-\x09\x0b-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
FIRST = "\x00"  # stands before a text's first unit, which no blank precedes
#: Signs that often end a word; between a letter and one of them the vocabulary's rule always cuts.
TAIL = ".,;:!?#$%&*()|\"'"


@dataclass(frozen=True)
class Layout:
    """planes: 4 (bytes) or 32 (bits) of an id. block: ids in a block. ids_per_file: at which a file is closed."""

    planes: int = 4
    block: int = 1 << 16
    ids_per_file: int = 1 << 20
    level: int = 1
    end_id: int = 0


class Known:
    """Ids by text, in two generations: when the young one is full it becomes the old one, whose entries go if unused."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.old.get(key)
        if found is not None:
            self.young[key] = found
        return found

    def turn(self) -> None:
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}


class Encoder:
    """Ids of byte-level BPE texts. The library encodes each unit (white space, then other signs) once while it is known.

    The vocabulary's rule never joins signs before white space with those after it, nor a letter with a sign after it, so
    a text's ids are its units' ids. Texts that may hold a special token go to the library whole. ``keep``: units in memory
    in each of two generations.
    """

    def __init__(self, path: str, keep: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.sizes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(n)])  # one letter stands for a byte
        self.spaced, self.bare = Known(keep), Known(keep)  # units after a blank (left out of the key) or line end; others

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_bare(self, new: set[str]) -> None:
        new = [u for u in new if self.bare.get(u) is None]
        self.bare.young.update(zip(new, self._whole(new)))

    def _learn_spaced(self, new: list[str]) -> None:
        known, recall, split, stems = self.spaced.young, self.spaced.get, [], set()
        for u in new:
            if recall(u) is None:
                stem = u.rstrip(TAIL)
                if not stem or not stem[-1].isalpha():
                    stem = u
                if stem != u:
                    split.append((u, stem))
                if stem not in known and (stem == u or recall(stem) is None):
                    stems.add(stem)
        fresh = list(stems)
        full = [u if u[0] == "\n" else f" {u}" for u in fresh]
        groups = [full[at : at + 1000] for at in range(0, len(full), 1000)]
        done = self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)
        for g, (part, e) in enumerate(zip(groups, done)):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum([len(u) if u.isascii() else len(u.encode("utf-8", "replace")) for u in part])
            cuts = [0, *(4 * np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 4).tolist()]
            raw = ids.tobytes()
            known.update(zip(fresh[g * 1000 : g * 1000 + 1000], [raw[a:b] for a, b in zip(cuts, cuts[1:])]))
        self._learn_bare({u[len(stem) :] for u, stem in split}.difference(self.bare.young))
        tails = self.bare.young
        known.update((u, known[stem] + tails[u[len(stem) :]]) for u, stem in split)

    def _plain(self, texts: pa.Array) -> list[bytes]:
        """Texts whose white space is single blanks and line ends between other signs, at once: a word is looked up once a batch."""
        marked = pc.binary_join_element_wise(FIRST, pc.replace_substring(texts, "\n", " \n"), "")
        lists = pc.split_pattern(marked, " ")
        units = lists.values.dictionary_encode()
        words, codes = units.dictionary.to_pylist(), units.indices.to_numpy()
        spaced, bare = self.spaced.young, self.bare.young
        heads = {w[1:] for w in words if w[0] == FIRST}
        self._learn_bare(heads.difference(bare))
        self._learn_spaced([w for w in words if w not in spaced and w[0] != FIRST])
        found = [bare[w[1:]] if w[0] == FIRST else spaced[w] for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        own = sizes[codes]
        stops = np.cumsum(own)
        shift = ((np.cumsum(sizes) - sizes)[codes] - (stops - own)).astype(np.int32)
        at = np.repeat(shift, own)
        at += np.arange(len(at), dtype=np.int32)
        ids = flat[at]
        ends = np.concatenate([[0], stops])[lists.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null texts have none."""
        self.spaced.turn()
        self.bare.turn()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD)
        for m in self.marks:
            odd = pc.or_(odd, pc.match_substring(texts, m))
        plain = iter(self._plain(texts.filter(pc.invert(odd))))
        split = [(t, None if any(m in t for m in self.marks) else UNITS.findall(t)) for t in texts.filter(odd).to_pylist()]
        self._learn_bare({u for _, x in split if x for u in x}.difference(self.bare.young))
        known = self.bare.young.__getitem__
        others = iter([self._whole([t])[0] if x is None else b"".join(map(known, x)) for t, x in split])
        return [next(others if o else plain) for o in odd.to_pylist()]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


keeps("token files", encoder.cache_clear)


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """Byte planes, low first, or bit planes, bit 0 first and eight ids a byte."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [p.tobytes() for p in np.ascontiguousarray(raw.T)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [p.tobytes() for p in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)).view("<u4")[:, 0]
    bits = np.unpackbits(np.stack([np.frombuffer(p, np.uint8) for p in planes]), axis=1, bitorder="little")[:, :n]
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4")[:, 0]


def write_file(doc_ids: list[int], counts: list[int], ids: bytes, layout: Layout) -> bytes:
    """One file's bytes. A null document id is written as the least 64-bit integer."""
    pack = zstandard.ZstdCompressor(level=layout.level).compress
    flat = np.frombuffer(ids, "<u4")
    docs = pack(np.array([doc_ids, counts], "<i8").tobytes())
    chunks = [pack(p) for at in range(0, len(flat), layout.block) for p in to_planes(flat[at : at + layout.block], layout.planes)]
    index = np.cumsum([0, *map(len, chunks)]).astype("<u8").tobytes()
    head = HEAD.pack(MAGIC, VERSION, layout.planes, layout.block, len(doc_ids), len(flat), len(docs))
    return b"".join([head, docs, index, *chunks])


def read_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A file's document ids, their token counts and all ids, by its chunk index."""
    magic, version, planes, block, n_docs, n_ids, docs_size = HEAD.unpack_from(data)
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a token file of this version")
    unpack = zstandard.ZstdDecompressor().decompress
    doc_ids, counts = np.frombuffer(unpack(data[HEAD.size : HEAD.size + docs_size]), "<i8").reshape(2, n_docs)
    blocks = -(-n_ids // block)
    index = np.frombuffer(data, "<u8", blocks * planes + 1, HEAD.size + docs_size)
    base = HEAD.size + docs_size + index.nbytes
    chunk = lambda i: unpack(data[base + int(index[i]) : base + int(index[i + 1])])
    parts = [from_planes([chunk(b * planes + p) for p in range(planes)], min(block, n_ids - b * block)) for b in range(blocks)]
    return doc_ids, counts, np.concatenate([*parts, np.zeros(0, "<u4")])


NULL_ID = -(1 << 63)
BATCH_BYTES = 20 << 20  # of texts that are encoded at once, about
#: Files whose starts are broadcast, at 16 bytes each; more of them are joined by a shuffle.
MOST_BROADCAST = 500_000


def files(docs: DataFrame, layout: Layout = Layout(), path: str | None = None) -> DataFrame:
    """(doc_id, text, ...) -> (part, seq, n_ids, file): in ascending doc_id order, an end id after every document.

    A document lies in one file; one of more ids than ``ids_per_file`` has a file to itself, which must fit in a cell of 2 GB.

    Null ids come first, null texts have the end id alone, and rows of one id follow the order of their texts.
    """
    path = path or default_path("byte_bpe_50k.json")
    end = layout.end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal("token files")
        from pyspark import TaskContext

        part, seq, make = TaskContext.get().partitionId(), 0, encoder(path)
        ids, counts, held, size = [], [], [], 0

        def close():
            row = [part, seq, size, write_file(ids, counts, b"".join(held), layout)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], ["part", "seq", "n_ids", "file"])

        for batch in batches:
            step = max(1, min(8192, BATCH_BYTES * batch.num_rows // max(1, batch.column(1).nbytes)))
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                for doc, own in zip(rows.column(0).to_pylist(), make.encode_batch(rows.column(1))):
                    ids.append(NULL_ID if doc is None else doc)
                    counts.append(len(own) // 4 + 1)
                    held += (own, end)
                    size += counts[-1]
                    if size >= layout.ids_per_file:
                        yield close()
                        seq, ids, counts, held, size = seq + 1, [], [], [], 0
        if ids:
            yield close()
        trimmed()

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = plain.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "part int, seq int, n_ids long, file binary")


def read_back(written: DataFrame) -> DataFrame:
    """Stored files -> (doc_id, start, n_tokens, ids_crc32): the start counts all ids of the documents before."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for i in range(batch.num_rows):
                start, (doc_ids, counts, ids) = batch.column(0)[i].as_py(), read_file(batch.column(1)[i].as_py())
                ends = np.cumsum(counts)
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                docs = pa.array([None if d == NULL_ID else d for d in doc_ids.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([docs, pa.array(start + ends - counts), pa.array(counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    if starts.count() <= MOST_BROADCAST:  # a row a file: joined without moving the files
        starts = F.broadcast(starts)
    return written.join(starts, ["part", "seq"]).select("start", "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    """All documents' whole texts in token files, read back: nulls, empty texts and repeats as ``files`` states it; an empty
    table gives no rows, other columns are ignored."""
    return read_back(stored(files(table(spark, sf_dir, "documents")), "tokens"))
