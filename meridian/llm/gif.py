"""GIF media columns: a lossless 8-bit form for payloads, and a decoder with palettes, timing, transparency and disposal.

Writing: samples become indexes of a grey palette in frames 192 pixels wide, compressed with GIF's LZW. Reading: sub-blocks
are joined, codes of 9 to 12 bits are cut out of a run between clear codes all at once, strings are expanded, and each
frame is drawn on the canvas under its disposal and transparency rules; colour histograms are of the canvas as it is shown.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from meridian.llm.common import frugal, stored, table

WIDTH, ROWS, DELAY_MS = 192, 256, 40
BINS = 16
_GREYS = bytes(v for v in range(256) for _ in range(3))


def _widths(n: int, size: int) -> np.ndarray:
    """Bits of the n codes after a clear code, for a minimum code size: the table has one entry more from the third on."""
    entries = (1 << size) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.clip(np.floor(np.log2(entries)).astype(np.int64) + 1, size + 1, 12)


_WIDTHS8 = _widths(4096, 8)
_OFFSETS8 = np.concatenate([[0], np.cumsum(_WIDTHS8)])


def lzw_codes(data: bytes) -> list[list[int]]:
    """Runs of codes for 8-bit samples, each run ended by a clear code (256), the last by the end code (257)."""
    runs: list[list[int]] = []
    out: list[int] = []
    known: dict[int, int] = {}
    get, add, free = known.get, out.append, 258
    at = iter(data)
    prev = next(at)
    for b in at:
        key = prev << 8 | b
        code = get(key)
        if code is None:
            add(prev)
            if free < 4096:
                known[key] = free
                free += 1
            else:
                add(256)
                runs.append(out)
                out = []
                add, free = out.append, 258
                known.clear()
            prev = b
        else:
            prev = code
    add(prev)
    add(257)
    return [*runs, out]


def lzw_encode(data: bytes) -> bytes:
    """The code stream, least significant bit first, with a clear code in front."""
    runs = [[256], *lzw_codes(data)]
    codes = np.array([c for run in runs for c in run], dtype="<u2")
    widths = np.concatenate([_WIDTHS8[: len(run)] for run in runs])
    bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
    return np.packbits(bits[np.arange(16) < widths[:, None]], bitorder="little").tobytes()


def _expand(codes: list[int], size: int, base: list[bytes], out: list[bytes]) -> None:
    """Strings of a run of codes that follows a clear code."""
    if not codes:
        return
    strings = base.copy()
    put, emit = strings.append, out.append
    prev = strings[codes[0]]
    emit(prev)
    have = len(strings)
    for c in codes[1:]:
        own = strings[c] if c < have else prev + prev[:1]
        emit(own)
        if have < 4096:
            put(prev + own[:1])
            have += 1
        prev = own


def lzw_decode(stream: bytes, size: int = 8, limit: int | None = None) -> bytes:
    """Indexes of a code stream: until the end code, the stream's end or ``limit`` indexes."""
    clear, end = 1 << size, (1 << size) + 1
    base = [bytes([i]) for i in range(clear)] + [b"", b""]
    data = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int32)
    total, at, out = len(stream) * 8, 0, []
    widths, offsets = (_WIDTHS8, _OFFSETS8) if size == 8 else (None, None)
    while at + size + 1 <= total:
        most = min(4096, (total - at) // (size + 1))
        while True:
            if size == 8 and most <= 4096:
                w, o = widths[:most], offsets[:most] + at
            else:
                w = _widths(most, size)
                o = np.concatenate([[0], np.cumsum(w)[:-1]]) + at
            fits = int(np.searchsorted(o + w, total, "right"))
            w, o = w[:fits], o[:fits]
            byte = o >> 3
            codes = ((data[byte] | data[byte + 1] << 8 | data[byte + 2] << 16) >> (o & 7)) & ((1 << w) - 1)
            stops = np.nonzero((codes == clear) | (codes == end))[0]
            if len(stops) or fits < most or (at + int(o[-1] + w[-1] - at)) + 12 > total:
                break
            most *= 2  # a full table that goes on without a clear code
        n = int(stops[0]) if len(stops) else len(codes)
        _expand(codes[:n].tolist(), size, base, out)
        if not len(stops) or codes[n] == end:
            break
        at = int(o[n] + w[n])
        if limit is not None and sum(map(len, out)) >= limit:
            break
    return b"".join(out)[:limit]


def _blocks(data: bytes) -> bytes:
    whole = len(data) // 255
    rows = np.frombuffer(data[: whole * 255], np.uint8).reshape(whole, 255)
    rest = data[whole * 255 :]
    return np.hstack([np.full((whole, 1), 255, np.uint8), rows]).tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def write_gif(samples: bytes) -> bytes:
    """Samples, a positive multiple of 192 in number, as frames of at most 256 rows; index v is the grey (v, v, v)."""
    if not samples or len(samples) % WIDTH:
        raise ValueError("the samples must fill rows of 192")
    height = min(ROWS, len(samples) // WIDTH)
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, height, 0xF7, 0, 0), _GREYS]
    for at in range(0, len(samples), WIDTH * ROWS):
        part = samples[at : at + WIDTH * ROWS]
        out.append(b"\x21\xf9\x04" + struct.pack("<BHBB", 1 << 2, DELAY_MS // 10, 0, 0))
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, WIDTH, len(part) // WIDTH, 0) + b"\x08")
        out.append(_blocks(lzw_encode(part)))
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    """Where a frame lies, when (ms from the start, and how long), its indexes and palette, and its transparent index."""

    left: int
    top: int
    width: int
    height: int
    start_ms: int
    delay_ms: int
    disposal: int
    transparent: int | None
    palette: np.ndarray
    index: np.ndarray

    @property
    def opaque(self) -> np.ndarray:
        """The palette with full alpha."""
        return np.hstack([self.palette, np.full((256, 1), 255, np.uint8)])


def _sub_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        parts.append(data[at + 1 : at + 1 + n])
        at += 1 + n
    return b"".join(parts), at + 1


def _colours(data: bytes, at: int, flags: int) -> tuple[np.ndarray, int]:
    n = 3 << ((flags & 7) + 1)
    return np.frombuffer(data[at : at + n], np.uint8).reshape(-1, 3), at + n


#: Pixels of a canvas or a frame beyond which a file is not read: a few bytes can ask for any size.
MOST_PIXELS = 1 << 26


def read_frames(data: bytes, most_pixels: int = MOST_PIXELS) -> tuple[tuple[int, int], list[Frame]]:
    """Canvas (width, height) and frames. Indexes beyond a palette are black; short streams leave index 0."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    if width * height > most_pixels:
        raise ValueError("canvas too large")
    at, shared, frames, clock = 13, np.zeros((0, 3), np.uint8), [], 0
    if flags & 0x80:
        shared, at = _colours(data, at, flags)
    delay, disposal, transparent = 0, 0, None
    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            if data[at + 1] == 0xF9:
                bits, hundredths, index = struct.unpack_from("<BHB", data, at + 3)
                delay, disposal, transparent = hundredths * 10, bits >> 2 & 7, index if bits & 1 else None
            _, at = _sub_blocks(data, at + 2)
        elif data[at] == 0x2C:
            left, top, w, h, bits = struct.unpack_from("<HHHHB", data, at + 1)
            if w * h > most_pixels:
                raise ValueError("frame too large")
            at += 10
            palette = shared
            if bits & 0x80:
                palette, at = _colours(data, at, bits)
            palette = np.vstack([palette, np.zeros((256 - len(palette), 3), np.uint8)])
            size = data[at]
            if not 1 <= size <= 8:
                raise ValueError(f"code size {size}")
            stream, at = _sub_blocks(data, at + 1)
            pixels = np.frombuffer(lzw_decode(stream, size, w * h).ljust(w * h, b"\0"), np.uint8).reshape(h, w)
            if bits & 0x40:
                rows = np.concatenate([np.arange(s, h, step) for s, step in ((0, 8), (4, 8), (2, 4), (1, 2))])
                pixels = pixels[np.argsort(rows)]
            frames.append(Frame(left, top, w, h, clock, delay, disposal, transparent, palette, pixels))
            clock += delay
            delay, disposal, transparent = 0, 0, None
        else:
            raise ValueError(f"unknown block {data[at]:#x}")
    return (width, height), frames


def drawn(size: tuple[int, int], frames: list[Frame]) -> Iterator[np.ndarray]:
    """Each frame's canvas (height, width, 4): disposal 2 clears a frame's area afterwards, 3 puts back what was there.

    The array is drawn on for the next frame; a caller that keeps it takes a copy.
    """
    canvas = np.zeros((size[1], size[0], 4), np.uint8)
    for f in frames:
        area = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        before = area.copy() if f.disposal == 3 else None
        index = f.index[: area.shape[0], : area.shape[1]]
        if f.transparent is None:
            area[:] = f.opaque[index]
        else:
            seen = index != f.transparent
            area[seen] = f.opaque[index[seen]]
        yield canvas
        if f.disposal == 2:
            area[:] = 0
        elif f.disposal == 3:
            area[:] = before


def read_samples(data: bytes) -> bytes:
    """The samples that ``write_gif`` stored: the grey levels of each frame's area on the canvas."""
    size, frames = read_frames(data)
    return b"".join(_area(canvas, f)[..., 0].tobytes() for f, canvas in zip(frames, drawn(size, frames)))


def _area(canvas: np.ndarray, f: Frame) -> np.ndarray:
    return canvas[f.top : f.top + f.height, f.left : f.left + f.width]


def histogram(canvas: np.ndarray) -> np.ndarray:
    """(3, BINS): red, green and blue counts of a canvas's pixels, those that nothing was drawn on left out."""
    packed = canvas.view("<u4")[..., 0].ravel()
    shown = packed if (canvas[..., 3] == 255).all() else packed[canvas[..., 3].ravel() == 255]
    return np.stack([np.bincount((shown >> at & 0xF).astype(np.uint8), minlength=BINS) for at in (4, 12, 20)])


def payload(text: str | None) -> tuple[bytes, int]:
    data = (text or "").encode("utf-8", "replace")
    return data + b" " * (-len(data) % WIDTH if data else WIDTH), len(data)


MEDIA = "doc_id long, n_bytes long, media binary"
PLACE = ("start_ms", "delay_ms", "left", "top", "width", "height", "disposal")
FRAMES = f"array<struct<{','.join(f'{n}:int' for n in PLACE)},transparent:int,red:array<bigint>,green:array<bigint>,blue:array<bigint>>>"
READ = f"frames {FRAMES}, red array<bigint>, green array<bigint>, blue array<bigint>, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, error string"


def encoded(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, n_bytes, media): every row's text as a GIF; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = [payload(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for _, n in made], pa.int64()), pa.array([write_gif(p) for p, _ in made], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, MEDIA)


def _told(data: bytes | None) -> dict:
    """A file's frames, histograms and digests as READ names them; where it can't be read, the reason alone."""
    if data is None:
        return {"error": "no media"}
    try:
        size, frames = read_frames(data)
        told, total, parts = [], np.zeros((3, BINS), np.int64), []
        for f, canvas in zip(frames, drawn(size, frames)):
            bins = histogram(canvas)
            total += bins
            red, green, blue = bins.tolist()
            told.append({**{n: getattr(f, n) for n in PLACE}, "transparent": f.transparent, "red": red, "green": green, "blue": blue})
            parts.append(_area(canvas, f)[..., 0].tobytes())
    except (ValueError, IndexError, struct.error) as error:
        return {"error": f"{type(error).__name__}: {error}", "media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest()}
    samples, (red, green, blue) = b"".join(parts), total.tolist()
    return {
        "frames": told, "red": red, "green": green, "blue": blue, "payload_bytes": len(samples), "payload_sha256": hashlib.sha256(samples).hexdigest(),
        "tail_crc32": zlib.crc32(samples[-16:]), "media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest(),
    }


def frames_of(media: DataFrame) -> DataFrame:
    """(..., media) -> the same rows with the columns of READ, whose names must be free.

    frames: each frame's time, area, disposal, transparent index and colour histogram of the canvas as it is shown, that is
    with palettes, transparency and the disposal of the frames before applied; red, green, blue: sums over the frames in 16
    bins; payload: the red levels of the frames' areas. error: why a file can't be read, its columns being null; null media
    too. Repeated rows stay, an empty table gives no rows.
    """
    clash = [n for n in to_arrow_schema(StructType.fromDDL(READ)).names if n in media.columns]
    if clash:
        raise ValueError(f"columns {clash} are there already")
    names, out = media.columns, StructType([*media.schema.fields, *StructType.fromDDL(READ).fields])
    at, added = names.index("media"), list(to_arrow_schema(StructType.fromDDL(READ)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = [_told(d) for d in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array([r.get(f.name) for r in rows], f.type) for f in added]], [*names, *[f.name for f in added]])

    return media.mapInArrow(run, out)


def shown(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, media, ...) -> (key, nth, start_ms, delay_ms, width, height, rgba): a row a frame, its canvas as it is shown.

    rgba: height * width * 4 bytes, compressed by zlib. Files that can't be read give no rows; ``frames_of`` tells why.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for own, data in zip(batch.column(0), batch.column(1).to_pylist()):
                try:
                    size, frames = read_frames(data) if data is not None else ((0, 0), [])
                except (ValueError, IndexError, struct.error):
                    continue
                for n, (f, canvas) in enumerate(zip(frames, drawn(size, frames))):
                    row = [n, f.start_ms, f.delay_ms, *size, zlib.compress(canvas.tobytes(), 1)]
                    kinds = [*[pa.int32()] * 5, pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([own.as_py()], batch.column(0).type), *[pa.array([x], k) for x, k in zip(row, kinds)]], ["key", "nth", "start_ms", "delay_ms", "width", "height", "rgba"])

    kind = media.schema[key].dataType.simpleString()
    return media.select(F.col(key).alias("key"), "media").mapInArrow(run, f"key {kind}, nth int, start_ms int, delay_ms int, width int, height int, rgba binary").withColumnRenamed("key", key)


def op4_gif(spark, sf_dir: str) -> DataFrame:
    """All documents' texts stored as GIF files and read back; the feature is made of the frame and histogram columns.

    Null texts count as empty, repeated and null doc_ids keep a row each, an empty table gives no rows.
    """
    read = frames_of(stored(encoded(table(spark, sf_dir, "documents")), "gif"))
    feature = F.concat(F.size("frames").cast("string"), F.lit("x"), F.col("frames")[0]["delay_ms"].cast("string"), F.lit("ms:"), F.array_join(F.transform("red", lambda v: v.cast("string")), ","))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))
