"""Progressive JPEG in numpy: coefficients to scans and back, and to full-resolution RGB.

Every image of a batch is coded and decoded at once. Decoding runs in lockstep over the
restart segments of a scan: lane i reads the next symbol of segment i, so the steps are as
many as a segment's coefficients while each step is a vector over all segments of all
images. A file without restart markers is one lane a scan: slow, but right.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from functools import cache

import numpy as np

#: Row-major position of the k-th coefficient in zigzag order.
ZIGZAG = np.array([
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
])
#: Symbols of the encoder's two tables, the first ones with the shortest codes: (run << 4) | size.
_DC_SYMBOLS = list(range(12))
_AC_SYMBOLS = [0x00, 0x06, 0x05, 0x04, 0x03, 0x01, 0x02, 0x07, 0xF0] + [r << 4 | s for r in range(16) for s in range(1, 11) if (r, s) > (0, 7)]
#: Bytes of the marker segments that one image may have before its scans; scans of one image.
BITS = 16


class Huffman:
    """A table as counts of code lengths and symbols; codes and a 16-bit look-up."""

    def __init__(self, counts: list[int], symbols: list[int]):
        self.counts, self.symbols = counts, symbols
        self.code, self.size = np.zeros(256, np.uint64), np.zeros(256, np.int64)
        self.look = np.zeros(1 << BITS, np.uint16)  # length << 8 | symbol; length 0: no code
        code, at = 0, 0
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                s = symbols[at]
                self.code[s], self.size[s] = code, length
                lo = code << (BITS - length)
                self.look[lo : lo + (1 << (BITS - length))] = length << 8 | s
                code, at = code + 1, at + 1
            code <<= 1
        # what 16 bits say if they hold a whole value: its bits, its run, and itself
        symbol, length = (self.look & 0xFF).astype(np.int64), (self.look >> 8).astype(np.int64)
        size = symbol & 15
        whole = (length > 0) & (size > 0) & (length + size <= BITS)
        extra = np.arange(1 << BITS) >> np.where(whole, BITS - length - size, 0) & ((1 << size) - 1)
        self.fast_bits = np.where(whole, length + size, 0).astype(np.uint8)
        self.fast_run = (symbol >> 4).astype(np.uint8)
        self.fast_value = np.where(whole, _signed(extra, size), 0).astype(np.int32)


def _signed(extra: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(extra < (1 << size >> 1), extra - (1 << size) + 1, extra)


@cache
def own_table(kind: int) -> Huffman:
    """The encoder's table for DC (0) or AC (1): a few short codes, then codes of one length."""
    symbols = _AC_SYMBOLS if kind else _DC_SYMBOLS
    counts = [0] * 16
    if kind:
        counts[2], counts[4], counts[10] = 6, 3, len(symbols) - 9
    else:
        counts[3] = len(symbols)
    return Huffman(counts, symbols)


@cache
def _dense() -> tuple[np.ndarray, np.ndarray]:
    """(bits, sizes) of AC values -128 to 127 that follow a value, at 128 more."""
    v = np.arange(-128, 128)
    size, extra = _magnitude(v)
    table = own_table(1)
    return table.code[size] << size.astype(np.uint64) | extra, table.size[size] + size


#: The encoder's scans: (components, first and last coefficient, bits known before, bit position).
SCRIPT = [((0, 1, 2), 0, 0, 0, 1)] + [((c,), lo, hi, 0, 1) for lo, hi in ((1, 5), (6, 63)) for c in range(3)] + [((0, 1, 2), 0, 0, 1, 0)] + [((c,), 1, 63, 1, 0) for c in range(3)]
#: Blocks of luma and chroma in a unit of 16 x 16 pixels, in coding order: (component, row, column).
UNIT = [(0, 0, 0), (0, 0, 1), (0, 1, 0), (0, 1, 1), (1, 0, 0), (2, 0, 0)]


def grid(units: int) -> tuple[int, int]:
    """(rows, columns) of units of an image that holds so many: nearly square."""
    columns = max(1, int(np.ceil(np.sqrt(units))))
    return -(-units // columns), columns


def _pack(values: np.ndarray, sizes: np.ndarray, lanes: np.ndarray, n_lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes of each lane) of bit strings in order; each lane is filled up with ones to a byte."""
    bits = np.bincount(lanes, sizes, n_lanes).astype(np.int64)
    fill = -bits % 8
    nbytes = (bits + fill) // 8
    start = (np.cumsum(nbytes) - nbytes) * 8
    inside = np.cumsum(sizes) - sizes
    at = inside - (np.cumsum(bits) - bits)[lanes] + start[lanes]
    values = np.concatenate([values, ((1 << fill) - 1).astype(np.uint64)])
    sizes = np.concatenate([sizes, fill])
    at = np.concatenate([at, start + bits])
    word, off = at >> 5, at & 31
    put = values << (64 - off - sizes).astype(np.uint64)
    put[sizes == 0] = 0
    total = int(nbytes.sum())
    words = total // 4 + 3
    high = np.bincount(word, (put >> np.uint64(32)).astype(np.float64), words)
    low = np.bincount(word + 1, (put & np.uint64(0xFFFFFFFF)).astype(np.float64), words + 1)[:words]
    return (high + low).astype(np.uint64).astype(">u4").view(np.uint8)[:total], nbytes


def _magnitude(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, extra bits) of signed values: a negative one's bits are those of v - 1."""
    size = np.frexp(np.abs(v).astype(np.float32))[1].astype(np.int64)
    return size, np.where(v < 0, v + (1 << size) - 1, v).astype(np.uint64)


def _dc_first(blocks: np.ndarray, low: int, per_lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of DC values; blocks (lanes * per_lane) in coding order, of component as in UNIT."""
    v = (blocks[:, 0] >> low).reshape(-1, per_lane)
    diff = v.copy()
    diff[:, 1:4] -= v[:, 0:3]  # luma blocks follow each other, chroma blocks are alone in a lane
    size, extra = _magnitude(diff.ravel())
    table = own_table(0)
    return table.code[size] << size.astype(np.uint64) | extra, table.size[size] + size, np.repeat(np.arange(len(v)), per_lane)


def _ac_first(blocks: np.ndarray, lo: int, hi: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a band of AC values; each block is a lane."""
    band = blocks[:, lo : hi + 1]
    v = np.where(band < 0, -(-band >> low), band >> low)
    dense = v.all(1) & (np.abs(v).max(1) < 128) if len(v) else np.zeros(0, bool)
    if dense.any():
        return _joined(_ac_dense(v[dense]), np.flatnonzero(dense), _ac_sparse(v[~dense], lo, hi), np.flatnonzero(~dense))
    return _ac_sparse(v, lo, hi)


def _joined(a: tuple, at_a: np.ndarray, b: tuple, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of some lanes and of the others, in the order of lanes."""
    lanes = np.concatenate([at_a[a[2]], at_b[b[2]]])
    order = np.argsort(lanes, kind="stable") if len(at_b) else slice(None)
    return np.concatenate([a[0], b[0]])[order], np.concatenate([a[1], b[1]])[order], lanes[order]


def _ac_dense(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of bands without zeros, two values in each: 24 bits at most."""
    code, bits = _dense()
    at = v + 128
    value, size = code[at], bits[at]
    even = v.shape[1] // 2 * 2
    pair = (value[:, 0:even:2] << size[:, 1:even:2].astype(np.uint64)) | value[:, 1:even:2]
    width = size[:, 0:even:2] + size[:, 1:even:2]
    if even < v.shape[1]:
        pair, width = np.concatenate([pair, value[:, even:]], 1), np.concatenate([width, size[:, even:]], 1)
    return pair.ravel(), width.ravel(), np.repeat(np.arange(len(v)), pair.shape[1])


def _ac_sparse(v: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of any bands."""
    lane, k = np.nonzero(v)
    prev = np.concatenate([[-1], k[:-1]])
    new = np.ones(len(lane), bool)
    new[1:] = lane[1:] != lane[:-1]
    prev[new] = -1
    run = k - prev - 1
    size, extra = _magnitude(v[lane, k])
    table = own_table(1)
    symbol = (run & 15) << 4 | size
    values, sizes = table.code[symbol] << size.astype(np.uint64) | extra, table.size[symbol] + size
    order = (lane * 64 + k) * 4 + 3
    long = np.flatnonzero(run > 15)
    far = np.repeat(long, run[long] >> 4)
    last = np.full(len(v), -1)
    last[lane] = k  # the last non-zero of a lane, as positions ascend
    open_ = np.flatnonzero(last < hi - lo)
    values = np.concatenate([values, np.full(len(far), table.code[0xF0]), np.full(len(open_), table.code[0])])
    sizes = np.concatenate([sizes, np.full(len(far), table.size[0xF0]), np.full(len(open_), table.size[0])])
    order = np.concatenate([order, order[far] - 1, open_ * 256 + 255])
    lanes = np.concatenate([lane, lane[far], open_])
    sort = np.argsort(order, kind="stable") if len(far) or len(open_) else slice(None)
    return values[sort], sizes[sort], lanes[sort]


def _ac_refine(blocks: np.ndarray, lo: int, hi: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the next bit of a band; each block is a lane.

    A value that becomes non-zero is coded with the zeros before it; the bits of values that
    are non-zero already follow the symbol in whose stretch they lie.
    """
    band = blocks[:, lo : hi + 1]
    mag = np.abs(band) >> low
    dense = (mag > 1).all(1)
    if dense.any():
        return _joined(_refine_dense(mag[dense] & 1), np.flatnonzero(dense), _refine_sparse(band[~dense], mag[~dense]), np.flatnonzero(~dense))
    return _refine_sparse(band, mag)


def _refine_dense(bit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of bands whose values are all known: the end of the band, then a bit for each value, up to 21 in a token."""
    table = own_table(1)
    values, sizes = [np.full(len(bit), table.code[0])], [int(table.size[0])]
    for k in range(0, bit.shape[1], 21):
        part = bit[:, k : k + 21]
        values.append((part @ (1 << np.arange(part.shape[1] - 1, -1, -1, dtype=np.int64))).astype(np.uint64))
        sizes.append(part.shape[1])
    return np.stack(values, 1).ravel(), np.tile(sizes, len(bit)), np.repeat(np.arange(len(bit)), len(sizes))


def _refine_sparse(band: np.ndarray, mag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of any bands."""
    n, width = mag.shape
    known, fresh = mag > 1, mag == 1
    table = own_table(1)
    zero = ~known & ~fresh
    # zeros since the last fresh value, at each fresh one
    lane_f, k_f = np.nonzero(fresh)
    zeros = np.cumsum(zero, 1)
    before = zeros[lane_f, k_f]
    prev = np.zeros(len(lane_f), np.int64)
    same = np.zeros(len(lane_f), bool)
    same[1:] = lane_f[1:] == lane_f[:-1]
    prev[1:][same[1:]] = before[:-1][same[1:]]
    run = before - prev
    last = np.full(n, -1)
    last[lane_f] = k_f
    # a stretch of 16 zeros before a fresh value is a symbol of its own, which ends at its 16th zero
    lane_z, k_z = np.nonzero(zero)
    z_rank = zeros[lane_z, k_z]
    base = np.zeros((n, width), np.int64)
    base[lane_f, k_f] = before
    base = np.maximum.accumulate(base, 1)
    place = z_rank - base[lane_z, k_z]
    nxt = np.full((n, width), -1)
    nxt[lane_f, k_f] = run
    nxt = np.flip(np.maximum.accumulate(np.flip(np.where(nxt >= 0, np.arange(width)[::-1] * 64 + nxt, -1), 1), 1), 1)
    ahead = np.where(nxt[lane_z, k_z] >= 0, nxt[lane_z, k_z] % 64, -1)
    cut = (place % 16 == 0) & (ahead >= 0) & (place <= (ahead >> 4) * 16)
    # each symbol stands before its stretch: order by (lane, stretch, symbol first, then bits by place)
    stops = np.zeros((n, width), np.int64)
    stops[lane_f, k_f] = 1
    stops[lane_z[cut], k_z[cut]] = 1
    stretch = np.cumsum(stops, 1) - stops  # the stretch that a place lies in
    tail = last < width - 1
    key = lambda lane, s, k: (lane * 65 + s) * 128 + k
    symbol = (run & 15) << 4 | 1
    sign = (band[lane_f, k_f] > 0).astype(np.uint64)
    lane_k, k_k = np.nonzero(known)
    end = np.flatnonzero(tail)
    values = np.concatenate([table.code[symbol] << np.uint64(1) | sign, np.full(int(cut.sum()), table.code[0xF0]), np.full(len(end), table.code[0]), (mag[lane_k, k_k] & 1).astype(np.uint64)])
    sizes = np.concatenate([table.size[symbol] + 1, np.full(int(cut.sum()), table.size[0xF0]), np.full(len(end), table.size[0]), np.ones(len(lane_k), np.int64)])
    lanes = np.concatenate([lane_f, lane_z[cut], end, lane_k])
    total = stops.sum(1)
    order = np.concatenate([key(lane_f, stretch[lane_f, k_f], 0), key(lane_z[cut], stretch[lane_z[cut], k_z[cut]], 0), key(end, total[end], 0), key(lane_k, stretch[lane_k, k_k], k_k + 1)])
    sort = np.argsort(order)
    return values[sort], sizes[sort], lanes[sort]


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header(rows: int, columns: int, note: bytes) -> bytes:
    tables = b"".join(bytes([kind << 4]) + bytes(own_table(kind).counts) + bytes(own_table(kind).symbols) for kind in (0, 1))
    frame = struct.pack(">BHHB", 8, rows * 16, columns * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    return b"\xff\xd8" + _segment(0xFE, note) + _segment(0xDB, bytes([0]) + bytes([1] * 64)) + _segment(0xC2, frame) + _segment(0xC4, tables) + _segment(0xDD, struct.pack(">H", 1))


def encode(blocks: np.ndarray, units: np.ndarray, notes: list[bytes]) -> list[bytes]:
    """Progressive files of images with 4:2:0 chroma, one restart segment for each unit or block.

    ``blocks`` (n, 64) int: coefficients in zigzag order, in coding order of the units of all
    images; ``units``: units of each image, that fill its grid; ``notes``: comments.
    """
    n_units = int(units.sum())
    part = blocks.reshape(n_units, 6, 64).astype(np.int64)
    owner = np.repeat(np.arange(len(units)), units)
    ends = np.cumsum(units)
    # blocks of a component in raster order of the whole image
    raster = []
    nth = np.arange(n_units) - np.repeat(ends - units, units)
    columns = np.array([grid(int(u))[1] for u in units])[owner]
    row, column = nth // columns, nth % columns
    for c in range(3):
        if c:
            raster.append((part[:, 3 + c], owner))
            continue
        key = [owner * (1 << 40) + ((row * 2 + r) * (columns * 2) + column * 2 + k) for _, r, k in UNIT[:4]]
        order = np.argsort(np.stack(key, 1).ravel(), kind="stable")
        raster.append((part[:, :4].reshape(-1, 64)[order], np.repeat(owner, 4)))
    files: list[list[bytes]] = [[_header(*grid(int(u)), note)] for u, note in zip(units, notes)]
    for comps, lo, hi, high, low in SCRIPT:
        if lo == 0:
            lane_owner = owner
            flat = part.reshape(-1, 64)
            if high:
                bit = ((flat[:, 0] >> low) & 1).astype(np.uint64)
                tokens = bit, np.ones(len(bit), np.int64), np.repeat(np.arange(n_units), 6)
            else:
                tokens = _dc_first(flat, low, 6)
        else:
            some, lane_owner = raster[comps[0]]
            tokens = _ac_refine(some, lo, hi, low) if high else _ac_first(some, lo, hi, low)
        n_lanes = len(lane_owner)
        data, nbytes = _pack(*tokens, n_lanes)
        # restart markers between the segments of an image, and a zero after each 0xFF
        first = np.ones(n_lanes, bool)
        first[1:] = lane_owner[1:] != lane_owner[:-1]
        begin = np.flatnonzero(first)
        number = np.arange(n_lanes) - np.repeat(begin, np.diff(np.append(begin, n_lanes)))
        full = data == 0xFF
        stuffed = np.bincount(np.repeat(np.arange(n_lanes), nbytes)[full], minlength=n_lanes)
        gap = np.where(first, 0, 2)
        size = nbytes + stuffed + gap
        out = np.zeros(int(size.sum()), np.uint8)
        at = np.arange(len(data)) + np.cumsum(full) - full + np.repeat(np.cumsum(gap), nbytes)
        out[at] = data
        mark = (np.cumsum(size) - size)[~first]
        out[mark] = 0xFF
        out[mark + 1] = 0xD0 + ((number[~first] - 1) & 7)
        cut = np.append((np.cumsum(size) - size)[begin], len(out))
        head = _segment(0xDA, bytes([len(comps)]) + b"".join(bytes([c + 1, 0 if lo == 0 else 0x00]) for c in comps) + bytes([lo, hi, high << 4 | low]))
        held = out.tobytes()
        for i, (s, e) in enumerate(zip(cut[:-1], cut[1:])):
            files[i] += [head, held[s:e]]
    return [b"".join(f) + b"\xff\xd9" for f in files]


class Image:
    """What the headers of a file say, and its coefficients: for each component (blocks, 64) in zigzag order."""

    def __init__(self) -> None:
        self.height = self.width = 0
        self.sampling: list[tuple[int, int]] = []
        self.ids: list[int] = []
        self.quant: list[int] = []
        self.tables: dict[int, np.ndarray] = {}
        self.note = b""
        self.blocks: list[np.ndarray] = []
        self.shape: list[tuple[int, int]] = []

    def begin(self) -> None:
        h, v = max(s[0] for s in self.sampling), max(s[1] for s in self.sampling)
        self.units = (-(-self.height // (8 * v)), -(-self.width // (8 * h)))
        self.shape = [(self.units[0] * s[1], self.units[1] * s[0]) for s in self.sampling]
        self.own = [(-(-self.height * s[1] // (8 * v)), -(-self.width * s[0] // (8 * h))) for s in self.sampling]


class _Scan:
    def __init__(self, image: int, comps: list[int], lo: int, hi: int, high: int, low: int, dc: list[Huffman | None], ac: Huffman | None, every: int, start: int, end: int):
        self.image, self.comps, self.lo, self.hi, self.high, self.low = image, comps, lo, hi, high, low
        self.dc, self.ac, self.every, self.start, self.end = dc, ac, every, start, end

    def kind(self) -> tuple:
        return (len(self.comps) if self.lo == 0 else 1, self.lo, self.hi, self.high, self.low, tuple(map(id, self.dc)), id(self.ac))


_tables: dict[bytes, Huffman] = {}


def _table(body: bytes) -> Huffman:
    if body not in _tables:
        if len(_tables) > 256:
            _tables.clear()
        _tables[body] = Huffman(list(body[:16]), list(body[16:]))
    return _tables[body]


def parse(data: np.ndarray, offsets: np.ndarray) -> tuple[list[Image], list[list[_Scan]]]:
    """Headers and scans of each file; positions are those in ``data``."""
    ff = np.flatnonzero(data[:-1] == 0xFF) if len(data) else np.zeros(0, np.int64)
    nxt = data[ff + 1]
    real = ff[(nxt != 0) & (nxt != 0xFF) & ((nxt < 0xD0) | (nxt > 0xD7))].tolist()
    held = data.tobytes()
    images, scans = [], []
    for i in range(len(offsets) - 1):
        at, stop = int(offsets[i]), int(offsets[i + 1])
        image, own = Image(), []
        huff: dict[int, Huffman] = {}
        every = 0
        if held[at : at + 2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        at += 2
        while at + 1 < stop:
            marker = held[at + 1]
            if marker == 0xD9:
                break
            if marker == 0xFF:
                at += 1
                continue
            size = int.from_bytes(held[at + 2 : at + 4], "big")
            body = held[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xFE:
                image.note = body
            elif marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    n = 128 if wide else 64
                    image.tables[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int64)
                    body = body[1 + n :]
            elif marker == 0xC2:
                precision, image.height, image.width, n = struct.unpack(">BHHB", body[:6])
                if precision != 8:
                    raise ValueError("only 8-bit samples")
                for c in range(n):
                    cid, hv, q = body[6 + 3 * c : 9 + 3 * c]
                    image.ids.append(cid)
                    image.sampling.append((hv >> 4, hv & 15))
                    image.quant.append(q)
                image.begin()
            elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("only progressive Huffman frames")
            elif marker == 0xC4:
                while body:
                    n = 17 + sum(body[1:17])
                    huff[body[0]] = _table(body[1:n])
                    body = body[n:]
            elif marker == 0xDD:
                every = int.from_bytes(body, "big")
            elif marker == 0xDA:
                n = body[0]
                comps = [image.ids.index(body[1 + 2 * c]) for c in range(n)]
                select = [body[2 + 2 * c] for c in range(n)]
                lo, hi, bits = body[1 + 2 * n : 4 + 2 * n]
                k = bisect_left(real, at)
                end = real[k] if k < len(real) else stop
                dc = [huff.get(s >> 4) for s in select] if lo == 0 and not bits >> 4 else []
                own.append(_Scan(i, comps, lo, hi, bits >> 4, bits & 15, dc, huff.get(0x10 | select[0] & 15) if lo else None, every, at, min(end, stop)))
                at = min(end, stop)
        images.append(image)
        scans.append(own)
    return images, scans


class _Bits:
    """Positions, in bits, of lanes in bytes without stuffing; reads for some lanes at once."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        n = len(padded) - 8
        self.window = np.ndarray((n,), ">u8", padded.tobytes(), 0, (1,)).astype(np.uint64)
        self.short = (self.window >> np.uint64(32)).astype(np.uint32)
        self.at = at * 8

    def sixteen(self, lanes: np.ndarray) -> np.ndarray:
        p = self.at[lanes]
        return (self.short[np.minimum(p >> 3, len(self.short) - 1)] << (p & 7).astype(np.uint32)) >> np.uint32(16)

    def peek(self, lanes: np.ndarray | slice, bits: int) -> np.ndarray:
        p = self.at[lanes]
        return (self.window[np.minimum(p >> 3, len(self.window) - 1)] << (p & 7).astype(np.uint64)) >> np.uint64(64 - bits)

    def symbol(self, lanes: np.ndarray | slice, table: Huffman) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, extra bits) where the symbol's low half is the number of those."""
        p = self.at[lanes]
        w = self.window[np.minimum(p >> 3, len(self.window) - 1)] << (p & 7).astype(np.uint64)
        found = table.look[(w >> np.uint64(48)).astype(np.int64)]
        if not (found >> 8).all():
            raise ValueError("damaged JPEG: no such code")
        return self.more(lanes, w, found & 0xFF, found >> 8)

    def more(self, lanes, w, symbol, length):  # noqa: ANN001
        size = (symbol & 15).astype(np.int64)
        return symbol.astype(np.int64), self._extra(lanes, w, size, length.astype(np.int64))

    def _extra(self, lanes, w, size, length):  # noqa: ANN001
        w = w << length.astype(np.uint64)
        extra = (w >> np.uint64(1)) >> (63 - size).astype(np.uint64)
        self.at[lanes] += length + size
        return extra.astype(np.int64)

    def end_run(self, lanes: np.ndarray, run: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Blocks that an end-of-band symbol covers; its extra bits are as many as its run."""
        more = np.flatnonzero(run)
        out = np.ones(len(lanes), np.int64)
        if len(more):
            own = lanes[more]
            p = self.at[own]
            w = self.window[p >> 3] << (p & 7).astype(np.uint64)
            n = run[more]
            out[more] = (1 << n) + ((w >> np.uint64(1)) >> (63 - n).astype(np.uint64)).astype(np.int64)
            self.at[own] += n
        return out


def _segments(data: np.ndarray, scans: list[_Scan]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes without stuffing, start of each segment, scan of each segment)."""
    sizes = np.array([s.end - s.start for s in scans])
    owner = np.repeat(np.arange(len(scans)), sizes)
    where = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat([s.start for s in scans], sizes)
    raw = data[where]
    after_ff = np.zeros(len(raw), bool)
    after_ff[1:] = (raw[:-1] == 0xFF) & (owner[1:] == owner[:-1])
    mark = after_ff & (raw >= 0xD0) & (raw <= 0xD7)
    drop = (after_ff & (raw == 0)) | mark
    drop[:-1] |= mark[1:]
    kept = np.cumsum(~drop)
    base = np.cumsum(sizes) - sizes
    starts = np.concatenate([np.where(base > 0, kept[np.maximum(base - 1, 0)], 0), kept[np.flatnonzero(mark)]])
    scan = np.concatenate([np.arange(len(scans)), owner[mark]])
    order = np.lexsort((starts, scan))
    return raw[~drop], starts[order], scan[order]


def decode_scans(data: np.ndarray, images: list[Image], scans: list[list[_Scan]]) -> None:
    """Fill the coefficients of all images: the n-th scans of the files together, where they are of one kind."""
    total = 0
    base = []  # first block of each component of each image in one array
    for image in images:
        own = []
        for h, w in image.shape:
            own.append(total)
            total += h * w
        base.append(own)
    coef = np.zeros((total, 64), np.int32)
    todo = [list(s) for s in scans]
    while any(todo):
        heads = [s[0] for s in todo if s]
        kind = heads[0].kind()
        group = [s for s in heads if s.kind() == kind]
        # scans of other components of the same files and of the same kind run in the same pass
        taken = {id(s) for s in group}
        for own in todo:
            if own and id(own[0]) in taken:
                used = set(own[0].comps)
                for s in own[1:]:
                    if s.kind() != kind or used & set(s.comps) or s.lo == 0:
                        break
                    used |= set(s.comps)
                    group.append(s)
                    taken.add(id(s))
        todo = [[s for s in own if id(s) not in taken] for own in todo]
        _decode_group(data, images, base, coef, group)
    for image, own in zip(images, base):
        image.blocks = [coef[b : b + h * w] for b, (h, w) in zip(own, image.shape)]


@cache
def _places(shape: tuple[int, int], own: tuple[int, int]) -> np.ndarray:
    """Blocks of a component in raster order, as a scan of it alone has them."""
    return (np.arange(own[0])[:, None] * shape[1] + np.arange(own[1])).ravel()


@cache
def _unit_places(units: tuple[int, int], sampling: tuple[tuple[int, int], ...], comps: tuple[int, ...], starts: tuple[int, ...]) -> np.ndarray:
    """Blocks of an image in the order of a scan of several components."""
    y, x = np.divmod(np.arange(units[0] * units[1]), units[1])
    return np.stack([starts[c] + (y * sampling[c][1] + r) * (units[1] * sampling[c][0]) + x * sampling[c][0] + k for c in comps for r in range(sampling[c][1]) for k in range(sampling[c][0])], 1).ravel()


def _block_lists(images: list[Image], base: list[list[int]], scans: list[_Scan]) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """(block of each place in coding order, places of each scan, blocks of a unit, component slot of each block of a unit)."""
    lists, per, slots = [], 1, np.zeros(1, np.int64)
    for s in scans:
        image = images[s.image]
        if len(s.comps) == 1:
            c = s.comps[0]
            lists.append(base[s.image][c] + _places(image.shape[c], image.own[c]))
            continue
        cells = [j for j, c in enumerate(s.comps) for _ in range(image.sampling[c][0] * image.sampling[c][1])]
        per, slots = len(cells), np.array(cells)
        first = base[s.image][0]
        lists.append(first + _unit_places(image.units, tuple(image.sampling), tuple(s.comps), tuple(b - first for b in base[s.image])))
    return np.concatenate(lists), np.array([len(x) for x in lists]), per, slots


def _decode_group(data: np.ndarray, images: list[Image], base: list[list[int]], coef: np.ndarray, scans: list[_Scan]) -> None:
    if len({tuple(images[s.image].sampling) for s in scans}) > 1 and len(scans[0].comps) > 1:
        for s in scans:
            _decode_group(data, images, base, coef, [s])
        return
    clean, starts, owner = _segments(data, scans)
    blocks, sizes, per, slots = _block_lists(images, base, scans)
    begin = np.cumsum(sizes) - sizes
    nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
    every = np.array([s.every for s in scans])[owner] * per
    every = np.where(every > 0, every, sizes[owner])
    first = begin[owner] + nth * every
    count = np.minimum(every, (begin + sizes)[owner] - first)
    live = count > 0
    starts, first, count = starts[live], first[live], count[live]
    bits = _Bits(clean, starts)
    scan = scans[0]
    n = len(starts)
    pred = np.zeros((n, max(slots) + 1), np.int64)
    end_run = np.zeros(n, np.int64)
    for step in range(int(count.max()) if n else 0):
        lanes = np.flatnonzero(count > step) if count.min() <= step else np.arange(n)
        block = blocks[first[lanes] + step]
        if scan.lo == 0 and scan.high:
            coef[block, 0] |= (bits.peek(lanes, 1) << np.uint64(scan.low)).astype(np.int32)
            bits.at[lanes] += 1
        elif scan.lo == 0:
            slot = slots[step % per]
            size, extra = bits.symbol(lanes, scan.dc[slot])
            pred[lanes, slot] += _signed(extra, size)
            coef[block, 0] = pred[lanes, slot] << scan.low
        elif scan.high:
            _refine(bits, coef, scan, lanes, block, end_run)
        else:
            _band(bits, coef, scan, lanes, block, end_run)


def _band(bits: _Bits, coef: np.ndarray, scan: _Scan, lanes: np.ndarray, block: np.ndarray, end_run: np.ndarray) -> None:
    """The first bits of a band of one block in each lane."""
    waiting = end_run[lanes] > 0
    if waiting.any():
        end_run[lanes[waiting]] -= 1
        lanes, block = lanes[~waiting], block[~waiting]
    flat = coef.reshape(-1)
    k = np.full(len(lanes), scan.lo)
    while len(lanes):
        found = bits.sixteen(lanes)
        used = scan.ac.fast_bits[found]
        if used.all():
            run = scan.ac.fast_run[found]
            k = k + run if run.any() else k
            flat[block * 64 + k] = scan.ac.fast_value[found] << scan.low
            bits.at[lanes] += used
            k = k + 1
            go = k <= scan.hi
            if not go.all():
                lanes, block, k = lanes[go], block[go], k[go]
            continue
        symbol, extra = bits.symbol(lanes, scan.ac)
        size, run = symbol & 15, symbol >> 4
        end = (size == 0) & (run < 15)
        k = k + run
        put = size > 0
        if put.all():
            flat[block * 64 + k] = _signed(extra, size) << scan.low
        else:
            flat[block[put] * 64 + k[put]] = _signed(extra[put], size[put]) << scan.low
        k = k + 1
        if end.any():
            end_run[lanes[end]] = bits.end_run(lanes[end], run[end], extra) - 1
        go = ~end & (k <= scan.hi)
        if not go.all():
            lanes, block, k = lanes[go], block[go], k[go]


def _refine(bits: _Bits, coef: np.ndarray, scan: _Scan, lanes: np.ndarray, block: np.ndarray, end_run: np.ndarray) -> None:
    """One more bit of a band of one block in each lane: all lanes walk the band together."""
    one = np.int64(1 << scan.low)
    width = scan.hi - scan.lo + 1
    now = coef[block, scan.lo : scan.hi + 1]
    if width > 1 and scan.ac.size[0] and not end_run[lanes].any():
        # an end of the band at once, then a bit for each value, as all are known
        length = int(scan.ac.size[0])
        plain = (now != 0).all(1) & (bits.peek(lanes, length) == scan.ac.code[0])
        own = lanes[plain]
        if len(own):
            bits.at[own] += length
            part = []
            for k in range(0, width, 32):
                n = min(32, width - k)
                part.append((bits.peek(own, n)[:, None] >> np.arange(n - 1, -1, -1, dtype=np.uint64)) & np.uint64(1))
                bits.at[own] += n
            old = now[plain]
            coef[block[plain], scan.lo : scan.hi + 1] = old + np.where(old > 0, one, -one) * np.concatenate(part, 1).astype(np.int64)
            lanes, block = lanes[~plain], block[~plain]
            if not len(lanes):
                return
    n = len(lanes)
    ended = end_run[lanes] > 0
    need = ~ended
    run = np.zeros(n, np.int64)
    value = np.zeros(n, np.int64)
    for k in range(scan.lo, scan.hi + 1):
        if need.any():
            at = np.flatnonzero(need)
            symbol, extra = bits.symbol(lanes[at], scan.ac)
            size, r = symbol & 15, symbol >> 4
            run[at] = r
            value[at] = np.where(size > 0, np.where(extra > 0, one, -one), 0)
            end = (size == 0) & (r < 15)
            if end.any():
                own = at[end]
                end_run[lanes[own]] = bits.end_run(lanes[own], r[end], extra)
                ended[own] = True
            need[:] = False
        now = coef[block, k]
        known = now != 0
        if known.all():
            bit = bits.peek(lanes, 1).astype(np.int64)
            bits.at[lanes] += 1
            coef[block, k] = now + np.where(now > 0, one, -one) * bit
            continue
        at = np.flatnonzero(known)
        if len(at):
            bit = bits.peek(lanes[at], 1).astype(np.int64)
            bits.at[lanes[at]] += 1
            coef[block[at], k] = now[at] + np.where(now[at] > 0, one, -one) * bit
        free = ~known & ~ended
        stop = free & (run == 0)
        coef[block[stop], k] = value[stop]
        need = stop
        run[free & ~stop] -= 1
    over = end_run[lanes] > 0
    end_run[lanes[over]] -= 1


@cache
def _basis() -> np.ndarray:
    """Samples from coefficients in zigzag order, times 2**20, as whole numbers.

    Products and sums of whole numbers below 2**53 are exact in doubles, in any order, so a
    block's samples do not depend on the blocks beside it.
    """
    u = np.arange(8)
    c = np.cos((2 * u[:, None] + 1) * u[None] * np.pi / 16) / 2
    c[:, 0] /= np.sqrt(2)
    full = np.einsum("yv,xu->vuyx", c, c).reshape(64, 64)
    return np.rint(full[ZIGZAG] * (1 << 20))


def samples(coef: np.ndarray, quant: np.ndarray) -> np.ndarray:
    """(n, 8, 8) samples 0 to 255 of blocks of coefficients."""
    flat = (coef * quant).astype(np.float64) @ _basis()
    return np.clip(np.floor(flat / (1 << 20) + 0.5) + 128, 0, 255).astype(np.uint8).reshape(-1, 8, 8)


def _to_rgb(y: np.ndarray, cb: np.ndarray, cr: np.ndarray) -> np.ndarray:
    """RGB of full-size planes, in fixed-point arithmetic of 16 bits."""
    y = y.astype(np.int32) << 16
    cb, cr = cb.astype(np.int32) - 128, cr.astype(np.int32) - 128
    half = 1 << 15
    out = np.empty((*y.shape, 3), np.uint8)
    out[..., 0] = np.clip((y + 91881 * cr + half) >> 16, 0, 255)
    out[..., 1] = np.clip((y - 22554 * cb - 46802 * cr + half) >> 16, 0, 255)
    out[..., 2] = np.clip((y + 116130 * cb + half) >> 16, 0, 255)
    return out


def to_rgb(images: list[Image]) -> list[np.ndarray]:
    """(height, width, 3) of each image; chroma is repeated to the size of luma."""
    out: list[np.ndarray | None] = [None] * len(images)
    alike: dict[tuple, list[int]] = {}
    for i, image in enumerate(images):
        key = tuple(image.sampling), tuple(image.tables[q].tobytes() for q in image.quant)
        alike.setdefault(key, []).append(i)
    for (sampling, tables), some in alike.items():
        high = max(s[0] for s in sampling), max(s[1] for s in sampling)
        planes = []  # of each component, all units of the images as squares of full size
        for c, ((h, v), table) in enumerate(zip(sampling, tables)):
            coef = np.concatenate([images[i].blocks[c].reshape(images[i].units[0], v, images[i].units[1], h, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 64) for i in some])
            tile = samples(coef, np.frombuffer(table, np.int64)).reshape(-1, v, h, 8, 8).transpose(0, 1, 3, 2, 4).reshape(-1, v * 8, h * 8)
            planes.append(tile.repeat(high[1] // v, 1).repeat(high[0] // h, 2))
        units = _to_rgb(*planes) if len(planes) == 3 else np.repeat(planes[0][..., None], 3, -1)
        at = 0
        for i in some:
            (rows, columns), image = images[i].units, images[i]
            own = units[at : at + rows * columns].reshape(rows, columns, *units.shape[1:])
            at += rows * columns
            full = own.transpose(0, 2, 1, 3, 4).reshape(rows * units.shape[1], columns * units.shape[2], 3)
            out[i] = full[: image.height, : image.width]
    return out
