"""GIF media columns: write, decode and describe animations.

The decoder reads GIF87a and GIF89a: colour tables, graphic control (delay, transparency, disposal), interlacing and
LZW code streams of any length, always through the code table. Frames are composed on a canvas by the rules of disposal
and transparency, one after the other, and come out as timed frames with their colour histograms.

To store a payload losslessly its bytes become the palette indices of frames of up to TALL rows of SIDE samples, in LZW
codes of up to 12 bits with a clear code whenever the dictionary is full. Frames of ASCII take a local palette of 128
colours and shorter codes; others take the global one, in which PAD, a byte that UTF-8 never holds, is transparent.
Every frame gives its area back to the background before the next.

Defined cases: a null or empty text is stored as one frame of padding; equal texts give equal media and features;
repeated rows stay separate; very long texts take more frames, each written, read, composed and measured by itself; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import text_of
from tallyloom.session import ship, table

#: Samples of a row, and rows of the tallest frame.
SIDE = 24
TALL = 64 * SIDE
BLOCK = SIDE * SIDE
PAD = 255
#: Centiseconds that a frame is shown.
DELAY = 4
#: Codes have 12 bits at most, so a dictionary has as many entries.
WIDEST = 12
FULL = 1 << WIDEST
#: Bytes of rows that a task hands on at a time.
BATCH_BYTES = 8 << 20
GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).reshape(256, 3)
LEVEL = np.arange(0, 256, 2, dtype=np.uint8)
TINTED = np.stack([LEVEL, LEVEL, 255 - LEVEL], axis=1)


def pad(raw: bytes, multiple: int = BLOCK) -> bytes:
    """raw with bytes 255 up to a positive multiple."""
    return raw + bytes([PAD]) * (max(-(-len(raw) // multiple), 1) * multiple - len(raw))


def widths(first: int, n: int, least: int) -> np.ndarray:
    """Bits of n codes, the first of which is the first-th after a clear code: the dictionary grows by one with each."""
    newest = (1 << least) + 1 + np.arange(first, first + n)
    return np.minimum(np.frexp(newest.astype(np.float64))[1], WIDEST)


def lzw_codes(samples: bytes, least: int) -> list[int]:
    """The codes of samples: clear, then each longest known string, and clear again when the dictionary is full."""
    clear = 1 << least
    codes, known, free = [clear], {}, clear + 2
    emit, find = codes.append, known.get
    word = samples[0]
    for b in memoryview(samples)[1:]:
        key = word << 8 | b
        if longer := find(key):
            word = longer
            continue
        emit(word)
        known[key] = free
        free += 1
        word = b
        if free == FULL:
            emit(clear)
            known.clear()
            free = clear + 2
    emit(word)
    emit(clear + 1)
    return codes


def pack_codes(codes: list[int], least: int) -> bytes:
    held = np.array(codes, np.uint16)
    begin = np.flatnonzero(held[:-1] == 1 << least) + 1
    bits = np.concatenate([[least + 1], *(widths(0, n, least) for n in np.diff(np.append(begin, len(held))))])
    at = np.arange(WIDEST)
    return np.packbits(((held[:, None] >> at) & 1).astype(bool)[at < bits[:, None]], bitorder="little").tobytes()


def frame_bytes(samples: bytes, delay: int) -> bytes:
    """Graphic control, image descriptor and code stream of one frame."""
    plain = samples.isascii()
    least, tall = 7 if plain else 8, len(samples) // SIDE
    control = b"\x21\xf9\x04" + struct.pack("<BHBB", 2 << 2 | (not plain), delay, 0 if plain else PAD, 0)
    where = b"\x2c" + struct.pack("<HHHHB", 0, 0, SIDE, tall, 0x86 if plain else 0)
    packed = pack_codes(lzw_codes(samples, least), least)
    parts = [control, where, TINTED.tobytes() if plain else b"", bytes([least])]
    for i in range(0, len(packed), 255):
        part = packed[i : i + 255]
        parts += [bytes([len(part)]), part]
    return b"".join([*parts, b"\0"])


def write_gif(payload: bytes, delay: int = DELAY) -> bytes:
    """An animation whose palette indices are the payload's bytes."""
    step = SIDE * TALL
    tall = min(len(payload) // SIDE, TALL)
    out = bytearray(b"GIF89a" + struct.pack("<HHBBB", SIDE, tall, 0xF7, 0, 0) + GREY.tobytes())
    out += b"\x21\xff\x0bNETSCAPE2.0\x03\x01\x00\x00\x00"
    for at in range(0, len(payload), step):
        out += frame_bytes(payload[at : at + step], delay)
    out += b"\x3b"
    return bytes(out)


@dataclass
class Block:
    """A frame as it is stored."""

    left: int
    top: int
    width: int
    height: int
    table: np.ndarray
    delay: int
    disposal: int
    clear: int | None
    interlaced: bool
    least: int
    codes: bytes


def read_blocks(gif: bytes) -> tuple[int, int, Iterator[Block]]:
    """Width and height of the canvas, and the frames in order; a stream cut short ends after its last whole frame."""
    if gif[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", gif, 6)
    return width, height, _blocks(gif, flags)


def _blocks(gif: bytes, flags: int) -> Iterator[Block]:
    at = 13

    def colours(flags: int) -> np.ndarray:
        nonlocal at
        n = 2 << (flags & 7)
        found = np.frombuffer(gif, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
        return found

    def joined() -> bytes:
        nonlocal at
        parts = []
        while n := gif[at]:
            parts.append(gif[at + 1 : at + 1 + n])
            at += n + 1
        at += 1
        return b"".join(parts)

    base = colours(flags) if flags & 0x80 else np.zeros((2, 3), np.uint8)
    delay, disposal, clear = 0, 0, None
    while at < len(gif) and gif[at] != 0x3B:
        try:
            if gif[at] == 0x21:
                label = gif[at + 1]
                at += 2
                body = joined()
                if label == 0xF9:
                    how, delay, index = struct.unpack_from("<BHB", body)
                    disposal, clear = how >> 2 & 7, index if how & 1 else None
                continue
            left, top, w, h, how = struct.unpack_from("<HHHHB", gif, at + 1)
            at += 10
            own = colours(how) if how & 0x80 else base
            least = gif[at]
            at += 1
            block = Block(left, top, w, h, own, delay, disposal, clear, bool(how & 0x40), least, joined())
        except (IndexError, struct.error, ValueError):
            return
        yield block
        delay, disposal, clear = 0, 0, None


def read_codes(stream: bytes, least: int) -> Iterator[tuple[bool, list[int]]]:
    """The codes between two clear codes, in pieces: (whether the piece follows a clear code, codes)."""
    raw = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.uint32)
    clear, end, at, first = 1 << least, 8 * len(stream), 0, 0
    while at < end:
        size = widths(first, FULL, least)
        stop = at + np.cumsum(size)
        n = int(np.searchsorted(stop, end, side="right"))
        start, size, stop = stop[:n] - size[:n], size[:n], stop[:n]
        held = raw[start >> 3] | raw[(start >> 3) + 1] << 8 | raw[(start >> 3) + 2] << 16
        codes = (held >> (start & 7).astype(np.uint32)) & ((1 << size) - 1).astype(np.uint32)
        marks = np.flatnonzero((codes == clear) | (codes == clear + 1))
        last = int(marks[0]) if len(marks) else n
        yield first == 0, codes[:last].tolist()
        if len(marks) == 0 and n < FULL or len(marks) and codes[last] == clear + 1:
            return
        at, first = (int(stop[last]), 0) if len(marks) else (int(stop[-1]), first + n)


def lzw(stream: bytes, least: int, n: int) -> np.ndarray:
    """n indices from a variable-width LZW code stream; missing ones are 0."""
    literals = [bytes([i]) for i in range(1 << least)] + [b"", b""]
    entries, last, out, have = list(literals), b"", [], 0
    for fresh, codes in read_codes(stream, least):
        if fresh:
            entries, last = list(literals), b""
        add = entries.append
        for code in codes:
            if code < len(entries):
                found = entries[code]
            elif last:
                found = last + last[:1]
            else:
                break
            if last and len(entries) < FULL:
                add(last + found[:1])
            out.append(found)
            last = found
        have += sum(map(len, out[-len(codes) :])) if codes else 0
        if have >= n:
            break
    return np.frombuffer(b"".join(out)[:n].ljust(n, b"\0"), np.uint8)


def indices(b: Block) -> np.ndarray:
    """A frame's palette indices, height by width."""
    rows = lzw(b.codes, b.least, b.width * b.height).reshape(b.height, b.width)
    if b.interlaced:
        order = [y for start, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(start, b.height, step)]
        straight = np.empty_like(rows)
        straight[order] = rows
        return straight
    return rows


def compose(width: int, height: int, blocks: Iterator[Block]) -> Iterator[tuple[np.ndarray, Block, np.ndarray]]:
    """Yield each shown picture (height, width, 3), its block and the block's indices; pictures are drawn over."""
    canvas = np.zeros((height, width, 3), np.uint8)
    for b in blocks:
        rows = indices(b)
        before = canvas.copy() if b.disposal == 3 else None
        seen = rows[: max(height - b.top, 0), : max(width - b.left, 0)]
        area = canvas[b.top : b.top + seen.shape[0], b.left : b.left + seen.shape[1]]
        colours = b.table[np.minimum(seen, len(b.table) - 1)]
        area[...] = colours if b.clear is None else np.where((seen == b.clear)[:, :, None], area, colours)
        yield canvas, b, rows
        if b.disposal == 2:
            area[...] = 0
        elif b.disposal == 3:
            canvas = before


def histogram(picture: np.ndarray) -> np.ndarray:
    """Counts of 4 x 4 x 4 colours."""
    c = picture >> 6
    return np.bincount((c[:, :, 0] << 4 | c[:, :, 1] << 2 | c[:, :, 2]).reshape(-1), minlength=64)


def timed_frames(gif: bytes) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Each shown picture as (start_cs, delay_cs, place, size and colour histogram), its indices and the picture."""
    width, height, blocks = read_blocks(gif)
    start = 0
    for picture, b, rows in compose(width, height, blocks):
        bins = histogram(picture)
        held = [{"colour": int(i), "n": int(bins[i])} for i in np.flatnonzero(bins)]
        yield {"start_cs": start, "delay_cs": b.delay, "left": b.left, "top": b.top, "width": b.width, "height": b.height, "histogram": held}, rows, picture
        start += b.delay


def describe(gif: bytes, frames: list[dict]) -> str:
    """Canvas, frames, centiseconds and the colour histogram over the composed pictures, as text."""
    total = np.zeros(64, np.int64)
    for f in frames:
        for b in f["histogram"]:
            total[b["colour"]] += b["n"]
    bins = ",".join(f"{i}:{v}" for i, v in enumerate(total.tolist()) if v)
    width, height = struct.unpack_from("<HH", gif, 6)
    return f"{width}x{height};frames={len(frames)};cs={sum(f['delay_cs'] for f in frames)};hist={bins}"


def batched(rows: Iterator[tuple[int, dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(bytes, row) to record batches of about BATCH_BYTES."""
    held, size = [], 0
    for n, row in rows:
        held.append(row)
        size += n
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each whole text stored as an animation."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).cast("binary").alias("raw"))

    def encode(batches):
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field("id").type), ("n_bytes", pa.int64()), ("media", pa.binary())])

            def each(batch=batch):
                for i in range(batch.num_rows):
                    raw = batch.column("raw")[i].as_py()
                    media = write_gif(pad(raw))
                    yield len(media), {"id": batch.column("id")[i].as_py(), "n_bytes": len(raw), "media": media}

            yield from batched(each(), schema)

    return rows.mapInArrow(encode, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, media binary")


BIN = "struct<colour:int,n:bigint>"
TIMED = f"struct<start_cs:bigint,delay_cs:int,left:int,top:int,width:int,height:int,histogram:array<{BIN}>>"
_TIMED = pa.struct([("start_cs", pa.int64()), *[(n, pa.int32()) for n in ("delay_cs", "left", "top", "width", "height")], ("histogram", pa.list_(pa.struct([("colour", pa.int32()), ("n", pa.int64())])))])


def decode_media(media: DataFrame) -> DataFrame:
    """media (id, n_bytes, media) read back: (id, n_bytes, the payload's and the media's measures, feature, frames)."""

    def measured(gif: bytes) -> dict:
        frames, size, digest, tail = [], 0, hashlib.sha256(), b""
        for frame, rows, _ in timed_frames(gif):
            part = rows.tobytes()
            frames.append(frame)
            digest.update(part)
            size, tail = size + len(part), (tail + part[-32:])[-32:]
        return {
            "payload_bytes": size, "payload_sha256": digest.hexdigest(), "tail_crc32": zlib.crc32(tail), "media_bytes": len(gif),
            "media_sha256": hashlib.sha256(gif).hexdigest(), "feature": describe(gif, frames), "frames": frames,
        }

    def decode(batches):
        for batch in batches:
            whole = [("id", batch.schema.field("id").type), *[(n, pa.int64()) for n in ("n_bytes", "payload_bytes", "tail_crc32", "media_bytes")]]
            schema = pa.schema([*whole, *[(n, pa.string()) for n in ("payload_sha256", "media_sha256", "feature")], ("frames", pa.list_(_TIMED))])

            def each(batch=batch):
                for i in range(batch.num_rows):
                    found = measured(batch.column("media")[i].as_py())
                    yield 512 * (1 + len(found["frames"])), {"id": batch.column("id")[i].as_py(), "n_bytes": batch.column("n_bytes")[i].as_py(), **found}

            yield from batched(each(), schema)

    kind = media.schema["id"].dataType.simpleString()
    return media.mapInArrow(
        decode, f"id {kind}, n_bytes bigint, payload_bytes bigint, tail_crc32 bigint, media_bytes bigint, "
        f"payload_sha256 string, media_sha256 string, feature string, frames array<{TIMED}>",
    )


def frame_rows(media: DataFrame) -> DataFrame:
    """A row for each shown picture of (id, media): (id, frame, start_cs, delay_cs, pixels, histogram)."""
    ship(media.sparkSession)

    def explode(batches):
        for batch in batches:
            bins = pa.list_(pa.struct([("colour", pa.int32()), ("n", pa.int64())]))
            schema = pa.schema([("id", batch.schema.field("id").type), ("frame", pa.int32()), ("start_cs", pa.int64()), ("delay_cs", pa.int32()), ("pixels", pa.binary()), ("histogram", bins)])

            def each(batch=batch):
                for i in range(batch.num_rows):
                    key = batch.column("id")[i].as_py()
                    for n, (frame, _, picture) in enumerate(timed_frames(batch.column("media")[i].as_py())):
                        row = {k: frame[k] for k in ("start_cs", "delay_cs", "histogram")}
                        yield picture.size, {"id": key, "frame": n, "pixels": picture.tobytes(), **row}

            yield from batched(each(), schema)

    kind = media.schema["id"].dataType.simpleString()
    return media.select("id", "media").mapInArrow(
        explode, f"id {kind}, frame int, start_cs bigint, delay_cs int, pixels binary, histogram array<{BIN}>"
    )


def op4_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_media(encode_media(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


QUERIES = {"op4_gif_media": op4_gif_media}
