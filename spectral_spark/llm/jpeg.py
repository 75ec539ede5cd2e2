"""Progressive JPEG columns: a baseline-precision decoder for progressive scans, and a writer that carries bytes without loss.

The decoder accumulates the scans of spectral selection and successive approximation into one array of coefficients for
each component, transforms them back in numpy, upsamples the chroma and gives an RGB tensor.

The writer puts byte b of a payload into a coefficient, with quantisation by one: b itself in a block's first place and
from 128 up, else b - 255. So every other coefficient is non-zero and of one size: a first scan, at half precision, holds
b >> 1 in eight bits for each, which Parquet's compression can still pack, and the coded scans are regular. The decoder
recognises such scans and reads them as arrays; all others go through its general loops.
"""

import re
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 192
#: The shift of the first scans.
SHIFT = 1
MOST_ROWS = 4000
_NOTE = b"payload bytes "


def _zigzag() -> np.ndarray:
    """Natural (row-major) positions in zigzag order."""
    return np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, (p // 8 if (p // 8 + p % 8) % 2 else p % 8))))


def _basis() -> np.ndarray:
    """Row k: the 64 pixels of zigzag coefficient k, in steps of 2**-40, so that their sums are exact and do not depend on the order."""
    x = np.arange(8)
    c = np.array([[(np.sqrt(0.125) if u == 0 else 0.5) * np.cos((2 * i + 1) * u * np.pi / 16) for i in x] for u in x])
    return np.rint(np.einsum("ui,vj->uvij", c, c).reshape(64, 64)[_ZIGZAG] * 2.0**40) / 2.0**40


_ZIGZAG = _zigzag()
_BASIS = _basis()


# --- writing


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _huffman(kind: int, slot: int, symbols: list[int], length: int) -> bytes:
    """A table whose symbols all have codes of one length."""
    return _segment(0xC4, bytes([kind << 4 | slot]) + bytes(len(symbols) if n == length else 0 for n in range(1, 17)) + bytes(symbols))


def _scan(parts: list[tuple[int, int, int]], first: int, last: int, high: int, low: int, data: bytes) -> bytes:
    """A scan of (component, DC table, AC table)."""
    return _segment(0xDA, bytes([len(parts)]) + b"".join(bytes([c, d << 4 | a]) for c, d, a in parts) + bytes([first, last, high << 4 | low])) + data.replace(b"\xff", b"\xff\x00")


def _packed(bits: np.ndarray) -> bytes:
    """Bits as bytes; unused bits of the last one are ones."""
    spare = -len(bits) % 8
    return np.packbits(np.concatenate([bits, np.ones(spare, np.uint8)]) if spare else bits).tobytes()


def _dc_bits(differences: np.ndarray) -> np.ndarray:
    """Four-bit codes of the sizes, each with the bits of the difference."""
    size = np.zeros(len(differences), np.int64)
    magnitude = np.abs(differences)
    for k in range(9):
        size[magnitude >= (1 << k)] = k + 1
    value = (size << size) | np.where(differences < 0, differences + (1 << size) - 1, differences)
    length = 4 + size
    which = np.repeat(np.arange(len(length)), length)
    place = np.repeat(np.cumsum(length), length) - 1 - np.arange(len(which))
    return ((value[which] >> place) & 1).astype(np.uint8)


_TABLES = _segment(0xDB, b"\x00" + b"\x01" * 64) + _huffman(0, 0, list(range(10)), 4) + _huffman(1, 0, [7], 1) + _huffman(1, 1, [0], 1)


def encode_bytes(payload: bytes) -> bytes:
    """A progressive 4:2:0 JPEG whose coefficients are the payload's bytes; the payload is a positive multiple of 192 bytes."""
    if not payload or len(payload) % UNIT:
        raise ValueError(f"the payload is not a positive multiple of {UNIT} bytes")
    units = ceil(len(payload) / 384)
    cols = ceil(units / MOST_ROWS)
    rows = ceil(units / cols)
    values = np.zeros(rows * cols * 384, np.uint8)
    values[: len(payload)] = np.frombuffer(payload, np.uint8)
    mcu = values.reshape(rows, cols, 6, 64)
    luma = mcu[:, :, :4].reshape(rows, cols, 2, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 64)
    parts = [luma, mcu[:, :, 4].reshape(-1, 64), mcu[:, :, 5].reshape(-1, 64)]
    out = [b"\xff\xd8", _segment(0xFE, _NOTE + str(len(payload)).encode()), _segment(0xC2, b"\x08" + (rows * 16).to_bytes(2, "big") + (cols * 16).to_bytes(2, "big") + b"\x03\x01\x22\x00\x02\x11\x00\x03\x11\x00"), _TABLES]
    dc = mcu[:, :, :, 0].reshape(-1, 6)
    high = dc.astype(np.int64) >> SHIFT
    steps = np.empty_like(high)
    luma_dc = high[:, :4].ravel()
    steps[:, :4] = np.diff(luma_dc, prepend=0).reshape(-1, 4)
    steps[:, 4], steps[:, 5] = np.diff(high[:, 4], prepend=0), np.diff(high[:, 5], prepend=0)
    out.append(_scan([(1, 0, 0), (2, 0, 0), (3, 0, 0)], 0, 0, 0, SHIFT, _packed(_dc_bits(steps.ravel()))))
    for k, blocks in enumerate(parts):
        top = blocks >> 1  # the code of size seven, one bit 0, and then the seven bits of (b or b - 255) at half precision
        for a, b in ((1, 5), (6, 63)):
            out.append(_scan([(k + 1, 0, 0)], a, b, 0, SHIFT, top[:, a : b + 1].tobytes()))
    out.append(_scan([(1, 0, 0), (2, 0, 0), (3, 0, 0)], 0, 0, SHIFT, 0, _packed((dc & 1).ravel())))
    for k, blocks in enumerate(parts):
        bits = (blocks & 1) ^ (blocks < 128)
        bits[:, 0] = 0  # the code that ends the band; each coefficient's last bit follows
        out.append(_scan([(k + 1, 0, 1)], 1, 63, SHIFT, 0, _packed(bits.ravel())))
    return b"".join(out) + b"\xff\xd9"


# --- reading


class _Table:
    """Codes by the next sixteen bits: symbol and length, made where the general loops need them."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.counts, self.symbols, self._look = counts, symbols, None

    def codes(self) -> dict[int, tuple[int, int]]:
        """symbol: (code, length)"""
        out, code, k = {}, 0, 0
        for length, n in enumerate(self.counts, 1):
            for _ in range(n):
                out.setdefault(self.symbols[k], (code, length))
                code, k = code + 1, k + 1
            code <<= 1
        return out

    def look(self) -> list[int]:
        if self._look is None:
            table = [0] * 65536
            code, k = 0, 0
            for length, n in enumerate(self.counts, 1):
                for _ in range(n):
                    a = code << (16 - length)
                    table[a : a + (1 << (16 - length))] = [length << 8 | self.symbols[k]] * (1 << (16 - length))
                    code, k = code + 1, k + 1
                code <<= 1
            self._look = table
        return self._look


class _Bits:
    """The bits of one stretch of coded data; ones follow its end."""

    def __init__(self, data: bytes):
        b = np.frombuffer(data + b"\xff" * 8, np.uint8).astype(np.uint32)
        self.words, self.at = ((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]).tolist(), 0

    def peek(self) -> int:
        return (self.words[self.at >> 3] >> (16 - (self.at & 7))) & 0xFFFF if (self.at >> 3) < len(self.words) else 0xFFFF

    def take(self, n: int) -> int:
        if not n:
            return 0
        v = self.peek() >> (16 - n)
        self.at += n
        return v

    def symbol(self, look: list[int]) -> int:
        v = look[self.peek()]
        if not v:
            raise ValueError("no such code")
        self.at += v >> 8
        return v & 0xFF


def _signed(v: int, n: int) -> int:
    return v if not n or v >> (n - 1) else v - (1 << n) + 1


def _dc_first(bits: _Bits, tables, order, comps, low: int) -> None:
    last = [0] * len(comps)
    looks = [t.look() for t in tables]
    found: list[list[int]] = [[] for _ in comps]
    for k in order[0].tolist():
        n = bits.symbol(looks[k])
        if n:
            last[k] += _signed(bits.take(n), n)
        found[k].append(last[k] << low)
    for k, c in enumerate(comps):
        c.flat[order[1][order[0] == k], 0] = found[k]


def _ac_first(bits: _Bits, table: _Table, flat: np.ndarray, blocks: np.ndarray, a: int, b: int, low: int) -> None:
    look, run = table.look(), 0
    for i in blocks.tolist():
        if run:
            run -= 1
            continue
        k = a
        while k <= b:
            s = bits.symbol(look)
            r, n = s >> 4, s & 15
            if n:
                k += r
                flat[i, k] = _signed(bits.take(n), n) << low
                k += 1
            elif r == 15:
                k += 16
            else:
                run = (1 << r) + bits.take(r) - 1
                break


def _ac_refine(bits: _Bits, table: _Table, flat: np.ndarray, blocks: np.ndarray, a: int, b: int, low: int) -> None:
    look, run, unit = table.look(), 0, 1 << low

    def correct(row, k):
        if bits.take(1):
            row[k] += unit if row[k] > 0 else -unit

    for i in blocks.tolist():
        row, k = flat[i], a
        if not run:
            while k <= b:
                s = bits.symbol(look)
                r, n = s >> 4, s & 15
                new = 0
                if n:
                    new = unit if bits.take(1) else -unit
                elif r < 15:
                    run = (1 << r) + bits.take(r)
                    break
                while k <= b:
                    if row[k]:
                        correct(row, k)
                    elif r:
                        r -= 1
                    else:
                        if new:
                            row[k] = new
                        k += 1
                        break
                    k += 1
        if run:
            for j in range(k, b + 1):
                if row[j]:
                    correct(row, j)
            run -= 1


def _regular_first(data: bytes, table: _Table, n: int) -> np.ndarray | None:
    """n coefficients of one size without runs, if that is what the data holds: each one a code and a value."""
    if len(data) * 8 < n or not n:
        return None
    start = int.from_bytes(data[:2].ljust(2, b"\xff"), "big")
    hit = next(((s, c, ln) for s, (c, ln) in table.codes().items() if 0 < s < 16 and start >> (16 - ln) == c), None)
    if hit is None:
        return None
    size, code, length = hit
    field = length + size
    if len(data) * 8 < n * field:
        return None
    if field == 8:
        v = np.frombuffer(data, np.uint8, n)
        if (v >> size != code).any():
            return None
        v = (v & ((1 << size) - 1)).astype(np.int32)
        return np.where(v >> (size - 1), v, v - (1 << size) + 1)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * field).reshape(n, field)
    if any((bits[:, k] != (code >> (length - 1 - k)) & 1).any() for k in range(length)):
        return None
    wide = np.zeros((n, 16), np.uint8)
    wide[:, 16 - size :] = bits[:, length:]
    v = np.packbits(wide, axis=1).view(">u2").ravel().astype(np.int32)
    return np.where(v >> (size - 1), v, v - (1 << size) + 1)


def _regular_refine(data: bytes, table: _Table, rows: np.ndarray, a: int, b: int) -> np.ndarray | None:
    """Correction bits of blocks whose coefficients are all non-zero and that each begin with the end-of-band code."""
    code, length = table.codes().get(0, (0, 0))
    field = length + b - a + 1
    if not length or len(data) * 8 < len(rows) * field or not rows.all():
        return None
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=len(rows) * field).reshape(len(rows), field)
    if any((bits[:, k] != (code >> (length - 1 - k)) & 1).any() for k in range(length)):
        return None
    return bits[:, length:]


class _Component:
    def __init__(self, h: int, v: int, quant: int):
        self.h, self.v, self.quant = h, v, quant


_table = lru_cache(maxsize=256)(_Table)
_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def decode_coefficients(data: bytes):
    """(height, width, components, quantisation tables, note): components hold coefficients in zigzag order as flat (blocks, 64)."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, quant, tables, restart, note = 2, {}, {}, 0, b""
    comps: dict[int, _Component] = {}
    height = width = 0
    while True:
        marker = data[at + 1]
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        if marker == 0xD9:
            break
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            note = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.float64)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = _table(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            restart = int.from_bytes(body, "big")
        elif marker == 0xC2:
            height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            for k in range(body[5]):
                c = body[6 + 3 * k : 9 + 3 * k]
                comps[c[0]] = _Component(c[1] >> 4, c[1] & 15, c[2])
            most_h, most_v = max(c.h for c in comps.values()), max(c.v for c in comps.values())
            mcu_rows, mcu_cols = ceil(height / 8 / most_v), ceil(width / 8 / most_h)
            for c in comps.values():
                c.rows, c.cols = mcu_rows * c.v, mcu_cols * c.h
                c.own_rows, c.own_cols = ceil(ceil(height * c.v / most_v) / 8), ceil(ceil(width * c.h / most_h) / 8)
                c.flat = np.zeros((c.rows * c.cols, 64), np.int32)
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("not a progressive Huffman JPEG")
        elif marker == 0xDA:
            end = _MARKER.search(data, at).start()
            n = body[0]
            part = [(comps[body[1 + 2 * k]], body[2 + 2 * k]) for k in range(n)]
            a, b, high, low = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
            pieces = [x.replace(b"\xff\x00", b"\xff") for x in (_RESTART.split(data[at:end]) if restart else [data[at:end]])]
            at = end
            if n == 1:
                c = part[0][0]
                index = (np.arange(c.own_rows)[:, None] * c.cols + np.arange(c.own_cols)[None, :]).ravel()
                which, per = np.zeros(len(index), np.int64), 1
            else:
                grid = []
                for k, (c, _) in enumerate(part):
                    r = (np.arange(mcu_rows) * c.v)[:, None, None, None] + np.arange(c.v)[None, None, :, None]
                    q = (np.arange(mcu_cols) * c.h)[None, :, None, None] + np.arange(c.h)[None, None, None, :]
                    grid.append((r * c.cols + q).reshape(mcu_rows * mcu_cols, -1))
                which = np.tile(np.repeat(np.arange(n), [g.shape[1] for g in grid]), mcu_rows * mcu_cols)
                index, per = np.concatenate(grid, axis=1).ravel(), sum(g.shape[1] for g in grid)
            step = restart * per if restart else len(index)
            for k, piece in enumerate(pieces):
                here, kind = index[k * step : (k + 1) * step], which[k * step : (k + 1) * step]
                if a == 0 and high == 0:
                    _dc_first(_Bits(piece), [tables[t >> 4] for _, t in part], (kind, here), [c for c, _ in part], low)
                elif a == 0:
                    got = np.unpackbits(np.frombuffer(piece, np.uint8), count=len(here)).astype(np.int32) << low
                    for j, (c, _) in enumerate(part):
                        c.flat[here[kind == j], 0] |= got[kind == j]
                elif high == 0:
                    c, table = part[0][0], tables[16 | part[0][1] & 15]
                    v = _regular_first(piece, table, len(here) * (b - a + 1))
                    if v is None:
                        _ac_first(_Bits(piece), table, c.flat, here, a, b, low)
                    else:
                        c.flat[here, a : b + 1] = v.reshape(len(here), -1) << low
                else:
                    c, table = part[0][0], tables[16 | part[0][1] & 15]
                    rows = c.flat[here, a : b + 1]
                    v = _regular_refine(piece, table, rows, a, b)
                    if v is None:
                        _ac_refine(_Bits(piece), table, c.flat, here, a, b, low)
                    else:
                        c.flat[here, a : b + 1] = rows + np.where(rows > 0, 1, -1) * (v.astype(np.int32) << low)
        elif not 0xE0 <= marker <= 0xEF:
            raise ValueError(f"marker {marker:02x} is not supported")
    return height, width, list(comps.values()), quant, note


def to_rgb(height: int, width: int, comps: list, quant: dict) -> np.ndarray:
    """Dequantise, transform back, upsample to full resolution and convert: (height, width, 3) bytes, or one channel thrice."""
    most_h, most_v = max(c.h for c in comps), max(c.v for c in comps)
    planes = []
    for c in comps:
        scale = quant[c.quant]
        pixels = (c.flat if (scale == 1).all() else c.flat * scale) @ _BASIS
        pixels += 128
        pixels = np.clip(np.rint(pixels, out=pixels), 0, 255, out=pixels).astype(np.uint8)
        plane = pixels.reshape(c.rows, c.cols, 8, 8).transpose(0, 2, 1, 3).reshape(c.rows * 8, c.cols * 8)
        if most_v != c.v or most_h != c.h:
            plane = np.repeat(np.repeat(plane, most_v // c.v, 0), most_h // c.h, 1)
        planes.append(plane[:height, :width])
    if len(planes) == 1:
        return np.repeat(planes[0][:, :, None], 3, 2)
    y, cb, cr = planes[0].astype(np.float32), planes[1].astype(np.float32) - 128, planes[2].astype(np.float32) - 128
    rgb = np.empty((height, width, 3), np.uint8)
    for k, mixed in enumerate((y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb)):
        rgb[:, :, k] = np.clip(np.rint(mixed, out=mixed), 0, 255, out=mixed)
    return rgb


def payload_of(height: int, width: int, comps: list, note: bytes) -> bytes:
    """The bytes that encode_bytes stored."""
    rows, cols = height // 16, width // 16
    luma, *chroma = ((c.flat - (c.flat < 0)).astype(np.uint8) for c in comps)
    mcu = np.empty((rows, cols, 6, 64), np.uint8)
    mcu[:, :, :4] = luma.reshape(rows, 2, cols, 2, 64).transpose(0, 2, 1, 3, 4).reshape(rows, cols, 4, 64)
    for k, c in enumerate(chroma):
        mcu[:, :, 4 + k] = c.reshape(rows, cols, 64)
    return mcu.tobytes()[: int(note[len(_NOTE) :])]


# --- columns


def padded(text: str | None) -> bytes:
    """UTF-8 of a text (null: empty), with blanks up to a positive multiple of 192 bytes."""
    data = (text or "").encode()
    return data.ljust(max(1, ceil(len(data) / UNIT)) * UNIT)


def _stored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield pd.Series([encode_bytes(padded(x)) for x in t], dtype=object)


_TENSOR = "height int, width int, rgb binary, mean array<double>, payload binary"


def _tensors(media: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for m in media:
        rows = []
        for x in m:
            if x is None:
                rows.append((None,) * 5)
                continue
            height, width, comps, quant, note = decode_coefficients(x)
            rgb = to_rgb(height, width, comps, quant)
            rows.append((height, width, rgb.tobytes(), rgb.reshape(-1, 3).mean(0), payload_of(height, width, comps, note) if note.startswith(_NOTE) else None))
        yield pd.DataFrame(rows, columns=["height", "width", "rgb", "mean", "payload"])


def store_texts(docs: DataFrame, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """docs with a column of progressive JPEGs that carry the texts' bytes. Rows pass one by one; a null text counts as empty, a column of that name is replaced."""
    return docs.withColumn(media_col, F.pandas_udf(_stored, "binary")(F.col(text_col).cast("string")))


def read_tensors(media: DataFrame, media_col: str = "media") -> DataFrame:
    """media with a struct column `image`, or in place of it: height, width, rgb (row-major bytes, full resolution), mean (of each channel) and payload (null for other JPEGs).

    Null media have null fields; bytes that are no progressive JPEG raise an error.
    """
    return media.withColumn("image", F.pandas_udf(_tensors, _TENSOR)(F.col(media_col)))


def describe(media: DataFrame, media_col: str = "media") -> DataFrame:
    """media with what is read back from its stored bytes: payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, and feature: size, mean colour and checksum of the tensor."""
    image, bytes_ = F.col("image"), F.col(media_col)
    colour = F.array_join(F.transform(image["mean"], lambda x: F.format_string("%.3f", x)), ",")
    return read_tensors(media, media_col).withColumns({
        "payload_bytes": F.octet_length(image["payload"]).cast("long"),
        "payload_sha256": F.sha2(image["payload"], 256),
        "tail_crc32": F.crc32(F.substring(image["payload"], -16, 16)),
        "media_bytes": F.octet_length(bytes_).cast("long"),
        "media_sha256": F.sha2(bytes_, 256),
        "feature": F.concat_ws(":", F.concat_ws("x", image["height"], image["width"]), colour, F.lower(F.hex(F.crc32(image["rgb"])))),
    }).drop("image")
