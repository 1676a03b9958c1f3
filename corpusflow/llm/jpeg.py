"""Progressive JPEG: scans into coefficient arrays, and coefficients into full-resolution RGB.

Entropy-coded segments (the data between restart markers) depend on nothing but what earlier scans left,
so all segments of like scans, of one image or of many, are decoded in step: each pass over numpy arrays
reads one symbol of every segment.  Both directions know spectral selection and successive approximation,
interleaved and single-component scans, subsampling and restarts.

Coefficients are held as int16 rows of 64 in zigzag order, a row a block, components one after the other,
each in raster order over whole MCUs.  The inverse transform multiplies by an integer matrix in float64,
so sums are exact and do not depend on how blocks are batched.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np

FRACTION = 13
#: Spectral selection and successive approximation: (single component?, first, last, high, low).
SCRIPT = ((False, 0, 0, 0, 1), (True, 1, 5, 0, 1), (True, 6, 63, 0, 0), (False, 0, 0, 1, 0), (True, 1, 5, 1, 0))
_SCAN_END = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def zigzag() -> np.ndarray:
    """Raster position of each zigzag position."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = zigzag()


def _transform() -> np.ndarray:
    """(zigzag coefficient, raster pixel) of the inverse cosine transform, scaled to integers."""
    x, u = np.meshgrid(np.arange(8), np.arange(8))
    c = np.where(u == 0, np.sqrt(0.5), 1.0) * np.cos((2 * x + 1) * u * np.pi / 16) / 2
    both = np.einsum("vy,ux->vuyx", c, c).reshape(64, 64)
    return np.rint(both * (1 << FRACTION))[ZIGZAG]


TRANSFORM = _transform()


@dataclass(frozen=True)
class Component:
    ident: int
    h: int
    v: int
    table: int


@dataclass(frozen=True)
class Frame:
    width: int
    height: int
    components: tuple[Component, ...]

    @cached_property
    def mcus(self) -> tuple[int, int]:
        """(rows, columns) of MCUs in an interleaved scan."""
        hm, vm = max(c.h for c in self.components), max(c.v for c in self.components)
        return -(-self.height // (8 * vm)), -(-self.width // (8 * hm))

    def grid(self, k: int) -> tuple[int, int]:
        """(rows, columns) of stored blocks of component k."""
        rows, cols = self.mcus
        return rows * self.components[k].v, cols * self.components[k].h

    @cached_property
    def offsets(self) -> list[int]:
        """Where each component's blocks begin, and the end."""
        out = [0]
        for k in range(len(self.components)):
            r, c = self.grid(k)
            out.append(out[-1] + r * c)
        return out


@lru_cache(4096)
def frame_of(width: int, height: int, components: tuple[Component, ...]) -> Frame:
    return Frame(width, height, components)


def scan_blocks(frame: Frame, which: tuple[int, ...]) -> tuple[np.ndarray, int, np.ndarray]:
    """(blocks in coding order, blocks an MCU, component of each block) of a scan over the components ``which``."""
    held = frame.__dict__.setdefault("_scans", {})
    if which not in held:
        blocks, per = _scan_blocks(frame, which)
        held[which] = blocks, per, np.searchsorted(frame.offsets, blocks, side="right") - 1
    return held[which]


def _scan_blocks(frame: Frame, which: tuple[int, ...]) -> tuple[np.ndarray, int]:
    at = frame.offsets
    if len(which) == 1:
        k = which[0]
        c, (_, cols) = frame.components[k], frame.grid(k)
        hm, vm = max(x.h for x in frame.components), max(x.v for x in frame.components)
        rows, used = -(-(-(-frame.height * c.v // vm)) // 8), -(-(-(-frame.width * c.h // hm)) // 8)
        return (at[k] + np.arange(rows)[:, None] * cols + np.arange(used)).ravel(), 1
    rows, cols = frame.mcus
    parts = []
    for k in which:
        c = frame.components[k]
        y = np.arange(rows)[:, None, None, None] * c.v + np.arange(c.v)[:, None]
        x = np.arange(cols)[:, None, None] * c.h + np.arange(c.h)
        parts.append((at[k] + y * (cols * c.h) + x).reshape(rows * cols, c.v * c.h))
    both = np.concatenate(parts, axis=1)
    return both.ravel(), both.shape[1]


# Huffman tables


def canonical(counts: bytes, symbols: bytes) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length)."""
    out, code, i = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out[symbols[i]] = (code, length)
            code, i = code + 1, i + 1
        code <<= 1
    return out


@lru_cache(64)
def lookup(table: bytes) -> np.ndarray:
    """For each 16 bits ahead: length << 8 | symbol (length 0: no such code)."""
    out = np.zeros(1 << 16, np.int64)
    for s, (code, length) in canonical(table[:16], table[16:]).items():
        out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | s
    return out


def _table(by_length: dict[int, list[int]]) -> bytes:
    return bytes(len(by_length.get(n, ())) for n in range(1, 17)) + bytes(s for n in range(1, 17) for s in by_length.get(n, ()))


def ac_table() -> bytes:
    """Short codes for coefficients that follow each other at once, longer ones for runs."""
    short = list(range(1, 9))
    rest = [r << 4 | s for r in range(16) for s in range(1, 11) if not (r == 0 and s < 9)] + [r << 4 for r in range(1, 15)]
    return _table({4: short, 5: [0x00], 8: [0xF0], 9: rest})


DC_TABLE, AC_TABLE = _table({4: list(range(12))}), ac_table()


def _codes(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    code, length = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for s, (c, n) in canonical(table[:16], table[16:]).items():
        code[s], length[s] = c, n
    return code, length


_DC_CODE, _DC_LEN = _codes(DC_TABLE)
_AC_CODE, _AC_LEN = _codes(AC_TABLE)
_SIZE = np.zeros(1 << 12, np.int64)
for _s in range(1, 12):
    _SIZE[1 << (_s - 1) : 1 << _s] = _s


def _value_bits(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(size, extra bits) of signed values."""
    s = _SIZE[np.abs(v)]
    return s, np.where(v < 0, v + (1 << s) - 1, v)


# Encoding: (segment, code, length) streams, packed all at once


def pack(segment: np.ndarray, code: np.ndarray, length: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all segments, each filled up with ones, stuffed; and the byte ends of the ``n`` segments."""
    bits = np.bincount(segment, length, n).astype(np.int64)
    size = (bits + 7) >> 3
    base = np.concatenate(([0], np.cumsum(size)))
    before = np.cumsum(length) - length
    at = before - (np.cumsum(bits) - bits)[segment] + 8 * base[segment]
    fill = 8 * size - bits
    some = np.flatnonzero(fill)
    at = np.concatenate((at, 8 * base[some] + bits[some]))
    code, length = np.concatenate((code, (1 << fill[some]) - 1)), np.concatenate((length, fill[some]))
    word = code << (40 - length - (at & 7))
    first, total = at >> 3, int(base[-1])
    data = np.zeros(total + 5)
    for j in range(5):
        data += np.bincount(first + j, (word >> (32 - 8 * j)) & 255, total + 5)
    data = data[:total].astype(np.uint8)
    full = data == 255
    place = np.arange(total) + np.cumsum(full) - full
    out = np.zeros(total + int(full.sum()), np.uint8)
    out[place] = data
    return out, (base + np.concatenate(([0], np.cumsum(full)))[base])[1:]


def _dc_stream(values: np.ndarray, segment: np.ndarray, comp: np.ndarray, high: int, low: int) -> tuple:
    if high:
        return segment, (values >> low) & 1, np.ones(len(values), np.int64)
    v = values >> low
    order = np.lexsort((np.arange(len(v)), comp, segment))
    diff = np.empty_like(v)
    s = v[order]
    same = (segment[order][1:] == segment[order][:-1]) & (comp[order][1:] == comp[order][:-1])
    diff[order] = s - np.concatenate(([0], np.where(same, s[:-1], 0))) if len(s) else s
    size, extra = _value_bits(diff)
    return segment, _DC_CODE[size] << size | extra, _DC_LEN[size] + size


def _ac_stream(band: np.ndarray, segment: np.ndarray, high: int, low: int) -> tuple:
    """band: blocks by coefficients of the scan."""
    blocks, width = band.shape
    size = np.abs(band) >> low
    if high:
        return _ac_refining(size, band, segment)
    b, k = np.nonzero(size)
    v = np.where(band[b, k] < 0, -size[b, k], size[b, k])
    first = np.concatenate(([True], b[1:] != b[:-1])) if len(b) else np.zeros(0, bool)
    run = k - np.where(first, -1, np.concatenate(([0], k[:-1]))) - 1 if len(b) else k
    s, extra = _value_bits(v)
    symbol = (run & 15) << 4 | s
    code, length = _AC_CODE[symbol] << s | extra, _AC_LEN[symbol] + s
    last = np.full(blocks, -1)
    last[b] = k
    open_end = np.flatnonzero(last < width - 1)
    zeros = np.repeat(np.flatnonzero(run > 15), run[run > 15] >> 4)
    if not len(open_end) and not len(zeros):
        return segment[b], code, length
    key = np.concatenate(((b * 64 + k) * 2 + 1, (b[zeros] * 64 + k[zeros]) * 2, (open_end * 64 + 63) * 2 + 1))
    order = np.argsort(key, kind="stable")
    code = np.concatenate((code, np.full(len(zeros), _AC_CODE[0xF0]), np.full(len(open_end), _AC_CODE[0])))[order]
    length = np.concatenate((length, np.full(len(zeros), _AC_LEN[0xF0]), np.full(len(open_end), _AC_LEN[0])))[order]
    return segment[np.concatenate((b, b[zeros], open_end))[order]], code, length


def _ac_refining(size: np.ndarray, band: np.ndarray, segment: np.ndarray) -> tuple:
    """New coefficients with their runs and signs, and a correction bit for each old one; bands of up to 15."""
    blocks, width = size.shape
    if width > 15:
        raise ValueError("refined bands are at most 15 wide")
    new, old = size == 1, size > 1
    owner = np.full((blocks, width + 1), width)
    for k in range(width - 1, -1, -1):
        owner[:, k] = np.where(new[:, k], k, owner[:, k + 1])
    zeros = np.cumsum(size == 0, axis=1)
    b, k = np.nonzero(new)
    before = np.concatenate((np.zeros((blocks, 1), int), np.where(new, np.arange(width), -1)), axis=1)
    seen = np.maximum.accumulate(np.where(before[:, 1:] >= 0, before[:, 1:], -1), axis=1)
    previous = np.where(k > 0, seen[b, np.maximum(k - 1, 0)], -1)
    run = zeros[b, k] - np.where(previous >= 0, zeros[b, np.maximum(previous, 0)], 0)
    symbol = run << 4 | 1
    cb, ck = np.nonzero(old)
    ends = np.flatnonzero(~new[:, -1])
    block = np.concatenate((b, cb, ends))
    key = np.concatenate(((b * 64 + k) * 32, (cb * 64 + owner[cb, ck]) * 32 + 1 + ck, (ends * 64 + width) * 32))
    code = np.concatenate((_AC_CODE[symbol] << 1 | (band[b, k] > 0), size[cb, ck] & 1, np.full(len(ends), _AC_CODE[0])))
    length = np.concatenate((_AC_LEN[symbol] + 1, np.ones(len(cb), np.int64), np.full(len(ends), _AC_LEN[0])))
    order = np.argsort(key, kind="stable")
    return segment[block[order]], code[order], length[order]


def encode(frames: list[Frame], coefficients: np.ndarray, comments: list[bytes], restart: int = 8, script=SCRIPT) -> list[bytes]:
    """Progressive JPEGs of images whose blocks follow each other in ``coefficients``; quantisation is by 1."""
    base = np.concatenate(([0], np.cumsum([f.offsets[-1] for f in frames])))
    scans: list[list[bytes]] = [[] for _ in frames]
    for single, first, last, high, low in script:
        kinds = range(max(len(f.components) for f in frames)) if single else (None,)
        for k in kinds:
            order, seg, comp, segs = [], [], [], [0]
            for f, b in zip(frames, base, strict=False):
                which = tuple(range(len(f.components))) if k is None else (k,)
                blocks, per, parts = scan_blocks(f, which)
                n = np.arange(len(blocks)) // (per * restart)
                order.append(blocks + b)
                seg.append(n + segs[-1])
                comp.append(parts)
                segs.append(segs[-1] + int(n[-1]) + 1)
            order, seg, comp = np.concatenate(order), np.concatenate(seg), np.concatenate(comp)
            rows = coefficients[order].astype(np.int64) if first == 0 else coefficients[order, first : last + 1].astype(np.int64)
            stream = _dc_stream(rows[:, 0], seg, comp, high, low) if first == 0 else _ac_stream(rows, seg, high, low)
            data, ends = pack(*stream, segs[-1])
            starts = np.concatenate(([0], ends[:-1]))
            whole = data.tobytes()
            for i, f in enumerate(frames):
                which = range(len(f.components)) if k is None else (k,)
                parts = [whole[a:b] for a, b in zip(starts[segs[i] : segs[i + 1]].tolist(), ends[segs[i] : segs[i + 1]].tolist(), strict=True)]
                body = bytearray(parts[0])
                for j, p in enumerate(parts[1:]):
                    body += bytes((0xFF, 0xD0 + j % 8))
                    body += p
                head = struct.pack(">2sHB", b"\xff\xda", 6 + 2 * len(which), len(which)) + b"".join(bytes((f.components[c].ident, 0)) for c in which) + bytes((first, last, high << 4 | low))
                scans[i].append(head + bytes(body))
    tables = b"".join(struct.pack(">2sHB", b"\xff\xc4", 3 + len(t), kind << 4) + t for kind, t in ((0, DC_TABLE), (1, AC_TABLE)))
    out = []
    for f, s, note in zip(frames, scans, comments, strict=True):
        sof = struct.pack(">2sHBHHB", b"\xff\xc2", 8 + 3 * len(f.components), 8, f.height, f.width, len(f.components)) + b"".join(bytes((c.ident, c.h << 4 | c.v, 0)) for c in f.components)
        com = struct.pack(">2sH", b"\xff\xfe", 2 + len(note)) + note
        out.append(b"\xff\xd8" + com + struct.pack(">2sHB", b"\xff\xdb", 67, 0) + b"\x01" * 64 + sof + tables + struct.pack(">2sHH", b"\xff\xdd", 4, restart) + b"".join(s) + b"\xff\xd9")
    return out


# Decoding


@dataclass
class Scan:
    which: tuple[int, ...]
    first: int
    last: int
    high: int
    low: int
    dc: tuple[bytes, ...]
    ac: bytes
    restart: int
    segments: list[bytes]


@dataclass
class Image:
    frame: Frame
    quant: dict[int, np.ndarray]
    scans: list[Scan] = field(default_factory=list)
    comment: bytes = b""


def parse(data: bytes) -> Image:
    """Markers of a progressive JPEG; entropy-coded data is cut at restarts and unstuffed."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, quant, huff, restart, image, comment = 2, {}, {}, 0, None, b""
    while at < len(data):
        if data[at] != 0xFF:
            raise ValueError("marker expected")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        (size,) = struct.unpack_from(">H", data, at + 2)
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * (1 + wide)], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                huff[body[0]] = body[1:n]
                body = body[n:]
        elif marker == 0xC2:
            _, height, width, n = struct.unpack_from(">BHHB", body)
            image = Image(frame_of(width, height, tuple(Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n))), quant)
        elif marker in (0xC0, 0xC1, *range(0xC3, 0xC4), *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("not a Huffman-coded progressive JPEG")
        elif marker == 0xDD:
            (restart,) = struct.unpack(">H", body)
        elif marker == 0xFE:
            comment = body
        elif marker == 0xDA:
            n = body[0]
            place = {c.ident: i for i, c in enumerate(image.frame.components)}
            which = tuple(place[body[1 + 2 * i]] for i in range(n))
            kinds = [body[2 + 2 * i] for i in range(n)]
            first, last, bits = body[1 + 2 * n : 4 + 2 * n]
            end = _SCAN_END.search(data, at)
            stop = end.start() if end else len(data)
            segments = [s.replace(b"\xff\x00", b"\xff") for s in _RESTART.split(data[at:stop])]
            image.scans.append(Scan(which, first, last, bits >> 4, bits & 15, tuple(huff.get(k >> 4, b"") for k in kinds), huff.get(0x10 | kinds[0] & 15, b""), restart, segments))
            at = stop
    if image is None:
        raise ValueError("no frame")
    image.comment = comment
    return image


class _Bits:
    """All segments of a group in one buffer, with 8 bytes readable from any place."""

    def __init__(self, segments: list[bytes]) -> None:
        data = b"".join(segments) + b"\xff" * 16
        self.words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
        self.start = 8 * np.concatenate(([0], np.cumsum([len(s) for s in segments])))[:-1]
        self.most = 8 * (len(data) - 9)

    def ahead(self, pos: np.ndarray) -> np.ndarray:
        return self.words[np.minimum(pos, self.most) >> 3].astype(np.uint64) << (pos & 7).astype(np.uint64)


def _top(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The first n (up to 16) bits of 64."""
    return ((x >> np.uint64(1)) >> (np.uint64(63) - n.astype(np.uint64))).astype(np.int64)


def _signed(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(bits < (1 << np.maximum(size - 1, 0)), bits - (1 << size) + 1, bits)


def _decode_dc(coef, bits: _Bits, order, first, count, comp, scan: Scan) -> None:
    pos = bits.start.copy()
    if scan.high:
        rows = np.arange(int(count.max()))
        take = rows < count[:, None]
        at = (pos[:, None] + rows)[take]
        coef[order[(first[:, None] + rows)[take]], 0] |= (_top(bits.ahead(at), np.ones(len(at), np.int64)) << scan.low).astype(np.int16)
        return
    tables = {k: lookup(t) for k, t in zip(scan.which, scan.dc, strict=True)}
    kinds = np.array(sorted(tables))
    luts = np.stack([tables[k] for k in kinds])
    guess = np.zeros((len(pos), int(kinds.max()) + 1), np.int64)
    alive = np.arange(len(pos))
    for i in range(int(count.max())):
        alive = alive[count[alive] > i]
        block = first[alive] + i
        k = comp[block]
        x = bits.ahead(pos[alive])
        e = luts[np.searchsorted(kinds, k), (x >> np.uint64(48)).astype(np.int64)]
        length, size = e >> 8, e & 255
        value = _signed(_top(x << length.astype(np.uint64), size), size)
        pos[alive] += length + size
        guess[alive, k] += np.where(size > 0, value, 0)
        coef[order[block], 0] = guess[alive, k] << scan.low


def _decode_ac(coef, bits: _Bits, order, first, count, scan: Scan) -> None:
    lut, flat = lookup(scan.ac), coef.reshape(-1)
    pos, at, end = bits.start.copy(), first.copy(), first + count
    k = np.full(len(pos), scan.first)
    while len(pos):
        x = bits.ahead(pos)
        e = lut[(x >> np.uint64(48)).astype(np.int64)]
        length, run, size = e >> 8, (e >> 4) & 15, e & 15
        x <<= length.astype(np.uint64)
        value = _signed(_top(x, size), size)
        pos += length + size
        k += run
        none = np.flatnonzero(size == 0)
        if len(none):
            some = np.flatnonzero(size)
            flat[order[at[some]] * 64 + k[some]] = value[some] << scan.low
            stop = none[run[none] < 15]
            r = run[stop]
            at[stop] += (1 << r) + _top(x[stop], r)
            pos[stop] += r
            k[stop] = scan.first - 1
        else:
            flat[order[at] * 64 + k] = value << scan.low
        k += 1
        over = k > scan.last
        if over.any():
            at += over
            k[over] = scan.first
        going = at < end
        if not going.all():
            pos, at, end, k = pos[going], at[going], end[going], k[going]


def _refine_ac(coef, bits: _Bits, order, first, count, scan: Scan) -> None:
    lut, flat, one = lookup(scan.ac), coef.reshape(-1), 1 << scan.low
    pos, at, end = bits.start.copy(), first.copy(), first + count
    m = len(pos)
    k, fresh, run, value, skip = np.full(m, scan.first), np.ones(m, bool), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
    while len(pos):
        ask = np.flatnonzero(fresh & (skip == 0))
        if len(ask):
            x = bits.ahead(pos[ask])
            e = lut[(x >> np.uint64(48)).astype(np.int64)]
            length, r, s = e >> 8, (e >> 4) & 15, e & 15
            x <<= length.astype(np.uint64)
            stop = (s == 0) & (r < 15)
            sign = (x >> np.uint64(63)).astype(np.int64)
            value[ask] = np.where(s > 0, np.where(sign > 0, one, -one), 0)
            run[ask] = r
            extra = np.where(stop, r, s)
            skip[ask] = np.where(stop, (1 << r) + _top(x, r), 0)
            pos[ask] += length + extra
        fresh[:] = False
        cell = order[at] * 64 + k
        c = flat[cell].astype(np.int64)
        old = np.flatnonzero(c)
        if len(old):
            bit = _top(bits.ahead(pos[old]), np.ones(len(old), np.int64))
            pos[old] += 1
            grow = (bit > 0) & ((np.abs(c[old]) & one) == 0)
            flat[cell[old]] = c[old] + np.where(grow, np.sign(c[old]) * one, 0)
        free = np.flatnonzero((c == 0) & (skip == 0))
        put = free[run[free] == 0]
        flat[cell[put]] = value[put]
        fresh[put] = True
        run[free] -= 1
        k += 1
        over = k > scan.last
        if over.any():
            at += over
            k[over] = scan.first
            skip[over] = np.maximum(skip[over] - 1, 0)
            fresh |= over
            going = at < end
            if not going.all():
                pos, at, end, k, fresh, run, value, skip = (a[going] for a in (pos, at, end, k, fresh, run, value, skip))


def coefficients(images: list[Image]) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of all images, and where each image's blocks begin (with the end)."""
    base = np.concatenate(([0], np.cumsum([i.frame.offsets[-1] for i in images]))).astype(np.int64)
    coef = np.zeros((int(base[-1]), 64), np.int16)
    for turn in range(max((len(i.scans) for i in images), default=0)):
        groups: dict[tuple, list[int]] = {}
        for n, i in enumerate(images):
            if turn < len(i.scans):
                s = i.scans[turn]
                groups.setdefault((s.which if s.first == 0 else None, s.first, s.last, s.high, s.low, s.dc, s.ac), []).append(n)
        for members in groups.values():
            order, comp, first, count, segments, n_blocks = [], [], [], [], [], 0
            for n in members:
                s, frame = images[n].scans[turn], images[n].frame
                blocks, per, parts = scan_blocks(frame, s.which)
                step = per * s.restart or len(blocks)
                starts = np.arange(0, len(blocks), step)
                order.append(blocks + base[n])
                comp.append(parts)
                first.append(starts + n_blocks)
                count.append(np.minimum(step, len(blocks) - starts))
                segments += s.segments[: len(starts)] + [b""] * (len(starts) - len(s.segments))
                n_blocks += len(blocks)
            where = [np.concatenate(x) for x in (order, first, count)]
            if s.first == 0:
                _decode_dc(coef, _Bits(segments), *where, np.concatenate(comp), s)
            else:
                (_refine_ac if s.high else _decode_ac)(coef, _Bits(segments), *where, s)
    return coef, base


def samples(coef: np.ndarray, quant: np.ndarray) -> np.ndarray:
    """Blocks of 64 samples, 0 to 255."""
    x = (coef.astype(np.float64) * quant) @ TRANSFORM
    return np.clip((x.astype(np.int64) + (128 << FRACTION) + (1 << (FRACTION - 1))) >> FRACTION, 0, 255).astype(np.uint8)


def colours(y: np.ndarray, cb: np.ndarray, cr: np.ndarray) -> np.ndarray:
    """RGB of full-range samples, in 16-bit fixed point."""
    y, cb, cr = y.astype(np.int32) << 16, cb.astype(np.int32) - 128, cr.astype(np.int32) - 128
    red, blue = round(1.402 * 65536), round(1.772 * 65536)
    green_b, green_r = round(0.344136 * 65536), round(0.714136 * 65536)
    rgb = np.stack((y + red * cr, y - green_b * cb - green_r * cr, y + blue * cb), axis=-1)
    return np.clip((rgb + 32768) >> 16, 0, 255).astype(np.uint8)


def assembled(f: Frame, blocks: np.ndarray) -> np.ndarray:
    """(height, width, 3) of a frame's blocks of samples; smaller planes are brought to full resolution by repeating samples."""
    at, planes = f.offsets, []
    hm, vm = max(c.h for c in f.components), max(c.v for c in f.components)
    for k, c in enumerate(f.components):
        rows, cols = f.grid(k)
        plane = blocks[at[k] : at[k + 1]].reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8)
        if (hm, vm) != (c.h, c.v):
            plane = np.broadcast_to(plane[:, None, :, None], (rows * 8, vm // c.v, cols * 8, hm // c.h)).reshape(rows * 8 * vm // c.v, cols * 8 * hm // c.h)
        planes.append(plane[: f.height, : f.width])
    return colours(*planes) if len(planes) == 3 else np.stack([planes[0]] * 3, axis=-1)


def rgb(image: Image, coef: np.ndarray) -> np.ndarray:
    """(height, width, 3) of one image."""
    at = image.frame.offsets
    return assembled(image.frame, np.concatenate([samples(coef[at[k] : at[k + 1]], image.quant[c.table]) for k, c in enumerate(image.frame.components)]))


def decode(data: bytes) -> np.ndarray:
    image = parse(data)
    return rgb(image, coefficients([image])[0])
