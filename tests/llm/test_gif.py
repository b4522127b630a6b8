import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import gif_media

SCHEMA = "doc_id long, text string, media string, id int"
LONG = "".join(random.Random(9).choices("ab cdé\n", k=90_000))
TEXTS = [(1, "plain text " * 30), (2, "naïve ünï " * 40), (3, None), (4, ""), (5, "plain text " * 30), (5, "plain text " * 30), (None, "x"), (6, LONG), (7, "a" * 100_000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "y", 9) for i, t in TEXTS], SCHEMA)


def plain_lzw(stream, least):
    """A decoder that reads bit by bit."""
    bits = "".join(f"{b:08b}"[::-1] for b in stream)
    at, size, table, last, out = 0, least + 1, {}, None, b""
    while True:
        code = int(bits[at : at + size][::-1], 2)
        at += size
        if code == 1 << least:
            table, size, last = {i: bytes([i]) for i in range(1 << least)}, least + 1, None
            continue
        if code == (1 << least) + 1:
            return out
        word = table[code] if code in table else last + last[:1]
        if last is not None and len(table) + 2 < 4096:
            table[len(table) + 2] = last + word[:1]
            if len(table) + 2 == 1 << size and size < 12:
                size += 1
        out, last = out + word, word


def plain_feature(gif):
    """The feature and the payload, pixel by pixel, of an animation whose frames start at the top left and are cleared."""
    w, h = int.from_bytes(gif[6:8], "little"), int.from_bytes(gif[8:10], "little")
    base, at, seen, frames, time, payload = gif[13 : 13 + 768], 13 + 768 + 19, Counter(), 0, 0, b""
    while gif[at] != 0x3B:
        control, at = gif[at : at + 8], at + 8
        tall, how = int.from_bytes(gif[at + 7 : at + 9], "little"), gif[at + 9]
        at += 10
        colours, at = (gif[at : at + 384], at + 384) if how & 0x80 else (base, at)
        least, at, stream = gif[at], at + 1, b""
        while n := gif[at]:
            stream, at = stream + gif[at + 1 : at + 1 + n], at + 1 + n
        at += 1
        rows = plain_lzw(stream, least)
        payload += rows
        assert len(rows) == tall * w
        shown = [(0, 0, 0) if control[3] & 1 and v == control[6] else tuple(colours[3 * v : 3 * v + 3]) for v in rows] + [(0, 0, 0)] * ((h - tall) * w)
        seen.update((r >> 6) * 16 + (g >> 6) * 4 + (b >> 6) for r, g, b in shown)
        frames, time = frames + 1, time + int.from_bytes(control[4:6], "little")
    return f"{w}x{h};frames={frames};cs={time};hist=" + ",".join(f"{k}:{seen[k]}" for k in sorted(seen)), payload


def test_gif_round_trip(docs):
    got = gif_media.decode_media(gif_media.encode_media(docs)).collect()
    assert len(got) == len(TEXTS)
    want = Counter((i, (t or "").encode()) for i, t in TEXTS)
    for r in got:
        found = next(k for k in want if k[0] == r.id and len(k[1]) == r.n_bytes)
        payload = gif_media.pad(found[1])
        media = gif_media.write_gif(payload)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        assert plain_feature(media) == (r.feature, payload)
    assert len({(r.media_sha256, r.feature) for r in got if r.id in (1, 5)}) == 1
    assert gif_media.decode_media(gif_media.encode_media(docs.filter("false"))).count() == 0


def test_query_over_a_table(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = gif_media.op4_gif_media(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in TEXTS)
    by = {r.doc_id: r for r in got}
    assert by[6].feature == plain_feature(gif_media.write_gif(gif_media.pad(LONG.encode())))[0]
    assert len(by[6].frames) == by[6].frames[-1].start_cs // gif_media.DELAY + 1 > 2


def test_timed_frames(docs):
    frames = gif_media.frame_rows(gif_media.encode_media(docs.filter("doc_id = 6"))).orderBy("frame").collect()
    assert [f.start_cs for f in frames] == [i * gif_media.DELAY for i in range(len(frames))] and len(frames) > 2
    assert all(sum(b.n for b in f.histogram) * 3 == len(f.pixels) for f in frames)


def test_every_stream_goes_through_the_code_table(monkeypatch):
    calls, whole = [], gif_media.lzw
    monkeypatch.setattr(gif_media, "lzw", lambda *a: calls.append(1) or whole(*a))
    for text in ("", "a" * 5000, LONG):
        media = gif_media.write_gif(gif_media.pad(text.encode()))
        before = len(calls)
        assert len(list(gif_media.timed_frames(media))) == len(calls) - before > 0
    codes = gif_media.lzw_codes(LONG.encode()[: gif_media.SIDE * gif_media.TALL], 8)
    assert max(codes) > gif_media.FULL // 2 and codes.count(256) > 1


def lzw_encode(data, least):
    table, width, out, bits, n = {bytes([i]): i for i in range(1 << least)}, least + 1, bytearray(), 0, 0

    def put(code):
        nonlocal bits, n
        bits |= code << n
        n += width
        while n >= 8:
            out.append(bits & 255)
            bits, n = bits >> 8, n - 8

    clear, word, size = 1 << least, b"", (1 << least) + 2
    put(clear)
    for b in data:
        if word + bytes([b]) in table:
            word += bytes([b])
            continue
        put(table[word])
        if size < 4096:
            table[word + bytes([b])] = size
            size += 1
            if size - 1 == 1 << width and width < 12:
                width += 1
        word = bytes([b])
    put(table[word])
    put(clear + 1)
    if n:
        out.append(bits & 255)
    return bytes(out)


def test_gif_codes_palette_disposal_transparency():
    data = bytes(random.Random(2).choices(range(4), k=3000)) + b"\1" * 2000
    assert gif_media.lzw(lzw_encode(data, 2), 2, len(data)).tobytes() == data

    def frame(x, y, w, h, pixels, disposal, clear, delay, interlaced=False):
        codes = lzw_encode(bytes(pixels), 2)
        control = b"\x21\xf9\x04" + bytes([disposal << 2 | (clear is not None)]) + delay.to_bytes(2, "little") + bytes([clear or 0, 0])
        size = b"".join(v.to_bytes(2, "little") for v in (x, y, w, h))
        return control + b"\x2c" + size + bytes([0x40 if interlaced else 0, 2, len(codes)]) + codes + b"\0"

    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    head = b"GIF89a" + (2).to_bytes(2, "little") * 2 + bytes([0x81, 0, 0]) + palette
    gif = head + frame(0, 0, 2, 2, [1, 1, 1, 1], 1, None, 10) + frame(0, 0, 2, 1, [2, 0], 3, 0, 20) + frame(1, 1, 1, 1, [3], 2, None, 30) + frame(0, 0, 1, 1, [2], 0, None, 5) + b"\x3b"
    w, h, blocks = gif_media.read_blocks(gif)
    shown = [(p.copy().reshape(-1, 3).tolist(), b.delay) for p, b, _ in gif_media.compose(w, h, blocks)]
    red, green, blue, black = [255, 0, 0], [0, 255, 0], [0, 0, 255], [0, 0, 0]
    assert shown == [([red] * 4, 10), ([green, red, red, red], 20), ([red, red, red, blue], 30), ([green, red, red, black], 5)]
    rows = gif_media.indices(gif_media.Block(0, 0, 1, 9, np.zeros((4, 3)), 0, 0, None, True, 2, lzw_encode(bytes([0, 1, 2, 3, 0, 1, 2, 3, 0]), 2)))
    assert rows[:, 0].tolist() == [0, 1, 3, 2, 2, 3, 0, 0, 1]
