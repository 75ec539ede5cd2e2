import hashlib
import zlib

import numpy as np
import pytest

from spectral_spark.llm import jpeg as J
from spectral_spark.llm import queries
from spectral_spark.llm.common import stash


class Bits:
    def __init__(self):
        self.out = []

    def put(self, value, n):
        self.out += [(value >> (n - 1 - k)) & 1 for k in range(n)]


def size_of(v):
    return int(abs(v)).bit_length()


def raw(v, n):
    return v if v >= 0 else v + (1 << n) - 1


def huffman(symbols):
    """Canonical codes of 8 or fewer bits a symbol, all of one length that leaves the all-ones code free."""
    length = max(1, (len(symbols)).bit_length())
    return {s: (k, length) for k, s in enumerate(symbols)}, length


def general_jpeg(coefficients, sampling, height, width, restart=0, quant=1):
    """A progressive JPEG with runs, ends of band and refinements, by the textbook's encoder. coefficients: per component (rows, cols, 64) in zigzag order."""
    most_h, most_v = max(h for h, _ in sampling), max(v for _, v in sampling)
    out = [b"\xff\xd8", J._segment(0xDB, b"\x00" + bytes([quant]) * 64), J._segment(0xC2, b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(sampling)]) + b"".join(bytes([k + 1, h << 4 | v, 0]) for k, (h, v) in enumerate(sampling)))]
    if restart:
        out.append(J._segment(0xDD, restart.to_bytes(2, "big")))
    parts = range(1, len(sampling) + 1)
    mcu_rows, mcu_cols = -(-height // (8 * most_v)), -(-width // (8 * most_h))

    def mcus():
        for r in range(mcu_rows):
            for c in range(mcu_cols):
                for k, (h, v) in enumerate(sampling):
                    for i in range(v):
                        for j in range(h):
                            yield k, coefficients[k][r * v + i, c * h + j]

    per = sum(h * v for h, v in sampling)
    dc_codes, n = huffman(list(range(12)))
    out.append(J._huffman(0, 0, list(range(12)), n))

    def emit(parts_, a, b, high, low, pieces):
        body = b""
        for k, bits in enumerate(pieces):
            body += np.packbits(np.array(bits.out + [1] * (-len(bits.out) % 8), np.uint8)).tobytes().replace(b"\xff", b"\xff\x00")
            if k < len(pieces) - 1:
                body += bytes([0xFF, 0xD0 + k % 8])
        out.append(J._segment(0xDA, bytes([len(parts_)]) + b"".join(bytes([p, 0]) for p in parts_) + bytes([a, b, high << 4 | low])) + body)

    def dc(high, low):
        pieces, bits, last = [], Bits(), [0] * len(sampling)
        for i, (k, block) in enumerate(mcus()):
            if restart and i and i % (restart * per) == 0:
                pieces.append(bits)
                bits, last = Bits(), [0] * len(sampling)
            v = int(block[0]) >> low
            if high:
                bits.put(v & 1, 1)
                continue
            d = v - last[k]
            last[k] = v
            bits.put(*dc_codes[size_of(d)])
            bits.put(raw(d, size_of(d)), size_of(d))
        emit(parts, 0, 0, high, low, [*pieces, bits])

    def point(v, low):
        return int(np.sign(v)) * (abs(int(v)) >> low)

    def ac(k, a, b, high, low):
        h, v = sampling[k]
        rows, cols = -(-(-(-height * v // most_v)) // 8), -(-(-(-width * h // most_h)) // 8)
        blocks = [coefficients[k][r, c] for r in range(rows) for c in range(cols)]
        symbols = [r << 4 | s for r in range(16) for s in range(1, 11)] + [0xF0] + [r << 4 for r in range(15)]
        codes, n = huffman(symbols)
        out.append(J._huffman(1, 0, symbols, n))
        pieces, bits = [], Bits()
        run, pending = 0, []

        def flush():
            nonlocal run, pending
            if run:
                e = run.bit_length() - 1
                bits.put(*codes[e << 4])
                bits.put(run - (1 << e), e)
            for x in pending:
                bits.put(x, 1)
            run, pending = 0, []

        for i, block in enumerate(blocks):
            if restart and i and i % restart == 0:
                flush()
                pieces.append(bits)
                bits = Bits()
            values = [point(x, low) for x in block[a : b + 1]]
            if not high:
                zeros = 0
                for pos, x in enumerate(values):
                    if not x:
                        zeros += 1
                        continue
                    flush()
                    while zeros > 15:
                        bits.put(*codes[0xF0])
                        zeros -= 16
                    s = size_of(x)
                    bits.put(*codes[zeros << 4 | s])
                    bits.put(raw(x, s), s)
                    zeros = 0
                if zeros:
                    run += 1
            else:
                old = [point(x, high) for x in block[a : b + 1]]
                fresh = [p for p, x in enumerate(values) if x and not old[p]]
                end = fresh[-1] if fresh else -1
                zeros, wait = 0, []
                for p, x in enumerate(values):
                    if p > end:
                        if old[p]:
                            wait.append(abs(x) & 1)
                        continue
                    if not x:
                        zeros += 1
                        continue
                    while zeros > 15 and p <= end:
                        flush()
                        bits.put(*codes[0xF0])
                        for y in wait:
                            bits.put(y, 1)
                        zeros, wait = zeros - 16, []
                    if old[p]:
                        wait.append(abs(x) & 1)
                        continue
                    flush()
                    bits.put(*codes[zeros << 4 | 1])
                    bits.put(int(x > 0), 1)
                    for y in wait:
                        bits.put(y, 1)
                    zeros, wait = 0, []
                if end < len(values) - 1:
                    run += 1
                    pending += wait
            if run == 0x7FFF:
                flush()
        flush()
        emit([k + 1], a, b, high, low, [*pieces, bits])

    dc(0, 1)
    for k in range(len(sampling)):
        ac(k, 1, 5, 0, 2)
        ac(k, 6, 63, 0, 2)
        ac(k, 1, 63, 2, 1)
    dc(1, 0)
    for k in range(len(sampling)):
        ac(k, 1, 63, 1, 0)
    return b"".join(out) + b"\xff\xd9"


def random_blocks(rng, rows, cols, density):
    c = rng.integers(-60, 61, (rows, cols, 64))
    c[rng.random(c.shape) > density] = 0
    c[:, :, 0] = rng.integers(-300, 300, (rows, cols))
    return c


@pytest.mark.parametrize("sampling,height,width", [([(2, 2), (1, 1), (1, 1)], 48, 64), ([(2, 1), (1, 1), (1, 1)], 40, 56), ([(1, 1)], 33, 17), ([(1, 1)] * 3, 16, 24), ([(2, 2), (1, 1), (1, 1)], 25, 37)])
@pytest.mark.parametrize("density", [0.02, 0.3, 0.95])
@pytest.mark.parametrize("restart", [0, 3])
def test_general_scans(sampling, height, width, density, restart):
    rng = np.random.default_rng(7)
    most_h, most_v = max(h for h, _ in sampling), max(v for _, v in sampling)
    rows, cols = -(-height // (8 * most_v)), -(-width // (8 * most_h))
    blocks = [random_blocks(rng, rows * v, cols * h, density) for h, v in sampling]
    h_, w_, comps, quant, _ = J.decode_coefficients(general_jpeg(blocks, sampling, height, width, restart))
    assert (h_, w_) == (height, width)
    for c, b, (h, v) in zip(comps, blocks, sampling):
        own_r, own_c = -(-(-(-height * v // most_v)) // 8), -(-(-(-width * h // most_h)) // 8)
        got = c.flat.reshape(c.rows, c.cols, 64)
        assert (got[:own_r, :own_c] == b[:own_r, :own_c]).all() and (got[:, :, 0] == b[:, :, 0]).all()
    assert J.to_rgb(h_, w_, comps, quant).shape == (height, width, 3)


def test_inverse_transform_of_flat_colours():
    """A block whose only coefficient is 8 v is flat: 128 + v; chroma is upsampled and converted."""
    y, cb, cr = np.zeros((2, 2, 64), int), np.zeros((1, 1, 64), int), np.zeros((1, 1, 64), int)
    y[:, :, 0], cb[:, :, 0], cr[:, :, 0] = np.array([[80, -80], [160, 0]]), 40, -80
    h, w, comps, quant, _ = J.decode_coefficients(general_jpeg([y, cb, cr], [(2, 2), (1, 1), (1, 1)], 16, 16))
    rgb = J.to_rgb(h, w, comps, quant).astype(int)
    for (r, c), v in {(0, 0): 138, (0, 8): 118, (8, 0): 148, (8, 8): 128}.items():
        want = [v + 1.402 * -10, v - 0.344136 * 5 - 0.714136 * -10, v + 1.772 * 5]
        assert abs(rgb[r : r + 8, c : c + 8] - np.rint(want)).max() == 0


def test_inverse_transform_against_the_definition():
    rng = np.random.default_rng(3)
    c = rng.integers(-40, 40, 64)
    natural = np.zeros(64)
    natural[J._ZIGZAG] = c
    f, out = natural.reshape(8, 8), np.zeros((8, 8))
    for x in range(8):
        for y in range(8):
            for u in range(8):
                for v in range(8):
                    k = (0.5**0.5 if u == 0 else 1) * (0.5**0.5 if v == 0 else 1) / 4
                    out[x, y] += k * f[u, v] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16)
    assert np.allclose(c @ J._BASIS, out.ravel())
    assert list(J._ZIGZAG[:10]) == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24]


def test_payload_round_trip():
    rng = np.random.default_rng(0)
    for units in (1, 2, 3, 7, 500, 9001):
        p = rng.integers(0, 256, 192 * units, np.uint8).tobytes()
        h, w, comps, _, note = J.decode_coefficients(J.encode_bytes(p))
        assert J.payload_of(h, w, comps, note) == p
    for bad in (b"", b"x" * 191):
        with pytest.raises(ValueError):
            J.encode_bytes(bad)


def test_regular_scans_equal_the_general_loops(monkeypatch):
    """The same file through the arrays, through the loops, and by the definition of what the writer stores."""
    p = np.random.default_rng(1).integers(0, 256, 192 * 9, np.uint8).tobytes()
    data = J.encode_bytes(p)
    fast = J.decode_coefficients(data)
    monkeypatch.setattr(J, "_regular_first", lambda *a: None)
    monkeypatch.setattr(J, "_regular_refine", lambda *a: None)
    slow = J.decode_coefficients(data)
    assert all((a.flat == b.flat).all() for a, b in zip(fast[2], slow[2])) and J.payload_of(*slow[:3], slow[4]) == p
    b = np.frombuffer(p[:64], np.uint8).astype(int)
    assert slow[2][0].flat[0].tolist() == [b[0], *np.where(b[1:] < 128, b[1:] - 255, b[1:])]
    assert (J.to_rgb(*fast[:4]) == J.to_rgb(*slow[:4])).all()


def by_definition(data):
    """Colours of a stored text's JPEG from its coefficients by sums of cosines, in plain numpy and without the module's transform."""
    height, width, comps, _, _ = J.decode_coefficients(data)
    k = np.arange(8)
    wave = np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16) * np.where(k == 0, 0.5**0.5, 1)[:, None] / 2
    planes = []
    for c in comps:
        plane = np.zeros((c.rows * 8, c.cols * 8))
        for i, block in enumerate(c.flat):
            f = np.zeros(64)
            f[J._ZIGZAG] = block
            plane[i // c.cols * 8 :, i % c.cols * 8 :][:8, :8] = wave.T @ f.reshape(8, 8) @ wave + 128
        plane = np.clip(np.rint(plane), 0, 255)
        planes.append(np.kron(plane, np.ones((height // plane.shape[0], width // plane.shape[1]))))
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    return np.clip(np.rint(np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], 2)), 0, 255).astype(int)


def test_broken_files_are_refused():
    for bad in (b"", b"\x89PNG", b"\xff\xd8\xff\xc0\x00\x11" + bytes(15)):
        with pytest.raises((ValueError, IndexError)):
            J.decode_coefficients(bad)


def test_query_and_edges(spark, sf_dir, sample, tmp_path):
    texts = {r.doc_id: r.text for r in sample.collect()}
    for k, r in enumerate(queries.op8_jpeg(spark, sf_dir).collect()):
        p = J.padded(texts[r.doc_id])
        data = J.encode_bytes(p)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(texts[r.doc_id].encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
        assert (r.media_bytes, r.media_sha256) == (len(data), hashlib.sha256(data).hexdigest())
        if k < 20 and len(p) < 50_000:
            size, means, crc = r.feature.split(":")
            rgb = by_definition(data)
            assert size == f"{rgb.shape[0]}x{rgb.shape[1]}" and int(crc, 16) < 1 << 32
            assert np.allclose(rgb.reshape(-1, 3).mean(0), [float(x) for x in means.split(",")], atol=0.01)
    rows = [(1, None), (2, ""), (3, "é" * 96), (3, "é" * 96), (None, "x" * 400_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as media", "2 as image")
    got = J.read_tensors(stash(J.store_texts(df), "media", "zstd")).collect()
    assert sorted(bytes(r.image.payload) for r in got) == sorted(J.padded(t) for _, t in rows)
    assert all(len(r.image.rgb) == 3 * r.image.height * r.image.width for r in got)
    accents = next(r for r in got if r.doc_id == 3)
    assert (np.frombuffer(accents.image.rgb, np.uint8).reshape(16, 16, 3).astype(int) - by_definition(J.encode_bytes(J.padded("é" * 96)))).__abs__().max() <= 1
    assert J.describe(J.store_texts(df.limit(0))).count() == 0
    assert [r.feature for r in J.describe(spark.createDataFrame([(1, None)], "doc_id long, media binary")).collect()] == [""]
