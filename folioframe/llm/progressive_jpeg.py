"""Progressive JPEG in numpy: many images at a time, one array lane for each restart interval.

Reading accumulates the spectral-selection and successive-approximation scans
of each image into coefficient arrays, then dequantises, inverse-transforms,
upsamples chroma and converts to RGB. All lanes of a kind of scan are decoded
in step: one numpy operation handles one symbol of every lane.

Writing takes whole coefficient blocks, four of luma and one of each chroma to
an MCU (4:2:0), and emits a fixed script of scans with a restart interval of
one: DC without its lowest bit, the first AC coefficients without theirs, the
other AC coefficients, then the lowest bits.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

#: Fixed values of the JPEG standard: zigzag order, and the DC table's code counts by length (symbols 0 to 11).
ZIGZAG = np.array([
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
])
DC_COUNTS, DC_SYMBOLS = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0], list(range(12))
#: Our AC table: short codes for the sizes that text has, 16 bits for the rest.
_SHORT = [(1, [5]), (3, [4, 7]), (4, [6]), (5, [3]), (6, [2]), (7, [1]), (8, [8]), (9, [0x00]), (10, [0xF0])]
_REST = [r << 4 | s for r in range(16) for s in range(11) if not any(r << 4 | s in x for _, x in _SHORT)]
AC_COUNTS = [sum(len(x) for n, x in _SHORT if n == k) + (len(_REST) if k == 16 else 0) for k in range(1, 17)]
AC_SYMBOLS = [s for _, x in _SHORT for s in x] + _REST
#: AC coefficients that are sent in two steps.
SPLIT = 3


# ---- tables and transforms


def _codes(counts, symbols) -> tuple[np.ndarray, np.ndarray]:
    """Code and length by symbol."""
    code, lengths, out, k = 0, np.zeros(256, "i8"), np.zeros(256, "u8"), 0
    for n, c in enumerate(counts, 1):
        for _ in range(c):
            out[symbols[k]], lengths[symbols[k]] = code, n
            code, k = code + 1, k + 1
        code <<= 1
    return out, lengths


@lru_cache(64)
def _lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """By the next 16 bits: length << 8 | symbol; 0 where no code fits."""
    out, at, k = np.zeros(1 << 16, "i8"), 0, 0
    for n, c in enumerate(counts, 1):
        for _ in range(c):
            out[at : at + (1 << (16 - n))] = n << 8 | symbols[k]
            at, k = at + (1 << (16 - n)), k + 1
    return out


def _inverse() -> np.ndarray:
    """The 8x8 inverse transform of a zigzag block as a matrix of integers, scaled by 4096: sums are exact."""
    x, u = np.meshgrid(np.arange(8), np.arange(8), indexing="ij")
    one = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(1 / 8), 0.5)
    return np.rint(np.kron(one, one)[:, ZIGZAG].T * 4096)


INVERSE = _inverse()


# ---- writing


def _packed(values: np.ndarray, lengths: np.ndarray, lanes: int, per_lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit fields (lanes x per_lane, length 0: none) as bytes, each lane filled up with ones; bytes of each lane."""
    values, lengths = values.reshape(lanes, per_lane), lengths.reshape(lanes, per_lane)
    bits = lengths.sum(axis=1)
    size = (bits + 7) // 8
    pad = size * 8 - bits
    values = np.concatenate([values, ((1 << pad) - 1).astype("u8")[:, None]], axis=1)
    lengths = np.concatenate([lengths, pad[:, None]], axis=1)
    at = np.cumsum(lengths, axis=1) - lengths + ((np.cumsum(size) - size) * 8)[:, None]
    values, lengths, at = values.ravel(), lengths.ravel(), at.ravel()
    has = lengths > 0
    values, lengths, at = values[has], lengths[has], at[has]
    wide = values << (64 - lengths - (at & 31)).astype("u8")
    n = int(size.sum()) // 4 + 3
    words = np.bincount(at >> 5, (wide >> np.uint64(32)).astype("f8"), n) + np.bincount((at >> 5) + 1, (wide & np.uint64(0xFFFFFFFF)).astype("f8"), n)
    return words.astype(">u4").view("u1")[: int(size.sum())], size


def _entropy(values: np.ndarray, lengths: np.ndarray, per_lane: int, images: np.ndarray) -> list[bytes]:
    """Each image's segment of a scan: stuffed bytes with restart markers. images: lanes of each image."""
    data, size = _packed(values, lengths, int(images.sum()), per_lane)
    ends = np.cumsum(size) - 1
    last = np.cumsum(images) - 1
    inner = np.ones(len(ends), bool)
    inner[last] = False
    number = np.arange(len(ends)) - np.repeat(np.cumsum(images) - images, images)
    full = data == 255
    width = 1 + full.astype("i8")
    width[ends[inner]] += 2
    at = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), "u1")
    out[at] = data
    mark = at[ends[inner]] + 1 + full[ends[inner]]
    out[mark], out[mark + 1] = 255, 0xD0 + number[inner] % 8
    stops = (at + width)[ends[last]]
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]


def _sized(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Category and extra bits of signed values."""
    size = np.frexp(np.abs(v).astype("f8"))[1].astype("i8")
    return size, np.where(v < 0, v + (1 << size) - 1, v).astype("u8")


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([255, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _scan_header(components: list[int], first: int, last: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(components), *(x for c in components for x in (c, 0)), first, last, high << 4 | low]))


def mcu_order(grids: list[tuple[int, int]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the blocks of 4:2:0 images whose blocks lie as luma, blue, red, each row by row: by MCU (MCUs x 6), and by component."""
    mcus = np.array([c * r for c, r in grids])
    columns = np.repeat([c for c, _ in grids], mcus)
    own = np.arange(int(mcus.sum())) - np.repeat(np.cumsum(mcus) - mcus, mcus)
    base, m = np.repeat(6 * (np.cumsum(mcus) - mcus), mcus), np.repeat(mcus, mcus)
    y, x = np.divmod(own, columns)
    corner = base + 4 * y * columns + 2 * x
    order = np.stack([corner, corner + 1, corner + 2 * columns, corner + 2 * columns + 1, base + 4 * m + own, base + 5 * m + own], axis=1)
    luma = (base + 4 * own)[:, None] + np.arange(4)  # row by row the four quarters of an image are just its first blocks
    return order, [luma.ravel(), order[:, 4], order[:, 5]]


def write(blocks: np.ndarray, grids: list[tuple[int, int]], comments: list[bytes]) -> list[bytes]:
    """Progressive JPEG files, 4:2:0, of zigzag coefficient blocks (blocks x 64; AC not 0, all within -1023..1023).

    grids: (columns, rows) of MCUs of each file; its blocks are luma, blue, red, each row by row.
    """
    dc_code, dc_len = _codes(DC_COUNTS, DC_SYMBOLS)
    ac_code, ac_len = _codes(AC_COUNTS, AC_SYMBOLS)
    scans: list[tuple[bytes, list[bytes]]] = []
    blocks = blocks.astype("i8")
    order, parts = mcu_order(grids)
    images = np.array([c * r for c, r in grids])
    lanes = [images * 4, images, images]

    def fields(v, code, length, run=0):
        size, extra = _sized(v)
        return code[size] << size.astype("u8") | extra, length[size] + size

    dc = blocks[:, 0][order]
    rough = dc >> 1
    rough[:, 1:4] -= dc[:, 0:3] >> 1  # luma is told by its difference from the block before
    values, lengths = fields(rough, dc_code, dc_len)
    scans.append((_scan_header([1, 2, 3], 0, 0, 0, 1), _entropy(values, lengths, 6, images)))
    for c in range(3):  # first AC without the lowest bit: zeros run
        v = blocks[parts[c], 1 : SPLIT + 1]
        v = np.sign(v) * (np.abs(v) >> 1)
        values, lengths = np.zeros((len(v), SPLIT + 1), "u8"), np.zeros((len(v), SPLIT + 1), "i8")
        run = np.zeros(len(v), "i8")
        for k in range(SPLIT):
            some = v[:, k] != 0
            size, extra = _sized(v[:, k])
            symbol = run << 4 | size
            values[:, k], lengths[:, k] = np.where(some, ac_code[symbol] << size.astype("u8") | extra, 0), np.where(some, ac_len[symbol] + size, 0)
            run = np.where(some, 0, run + 1)
        values[:, SPLIT], lengths[:, SPLIT] = ac_code[0], np.where(run > 0, ac_len[0], 0)
        scans.append((_scan_header([c + 1], 1, SPLIT, 0, 1), _entropy(values, lengths, SPLIT + 1, lanes[c])))
    for c in range(3):
        values, lengths = fields(blocks[parts[c], SPLIT + 1 :], ac_code, ac_len)
        scans.append((_scan_header([c + 1], SPLIT + 1, 63, 0, 0), _entropy(values, lengths, 63 - SPLIT, lanes[c])))
    scans.append((_scan_header([1, 2, 3], 0, 0, 1, 0), _entropy((dc & 1).astype("u8"), np.ones(dc.shape, "i8"), 6, images)))
    for c in range(3):  # lowest bits: new coefficients head the correction bits before them, the end of block the rest
        v = blocks[parts[c], 1 : SPLIT + 1]
        new = np.abs(v) == 1
        values, lengths = [], []
        for head in range(SPLIT + 1):
            owns = [~new[:, j] & ~new[:, j + 1 : head].any(axis=1) for j in range(head)]
            here = new[:, head] if head < SPLIT else np.logical_or.reduce(owns)
            code = ac_code[1] << np.uint64(1) | (v[:, head] > 0).astype("u8") if head < SPLIT else np.full(len(v), ac_code[0])
            values.append(code)
            lengths.append(np.where(here, ac_len[1] + 1 if head < SPLIT else ac_len[0], 0))
            for j, own in enumerate(owns):
                values.append((np.abs(v[:, j]) & 1).astype("u8"))
                lengths.append((here & own).astype("i8"))
        values, lengths = np.stack(values, axis=1), np.stack(lengths, axis=1)
        scans.append((_scan_header([c + 1], 1, SPLIT, 1, 0), _entropy(values, lengths, values.shape[1], lanes[c])))
    tables = _segment(0xDB, bytes([0, *[1] * 64])) + _segment(0xC4, bytes([0x00, *DC_COUNTS, *DC_SYMBOLS])) + _segment(0xC4, bytes([0x10, *AC_COUNTS, *AC_SYMBOLS])) + _segment(0xDD, bytes([0, 1]))
    out = []
    for i, ((columns, rows), comment) in enumerate(zip(grids, comments, strict=True)):
        frame = _segment(0xC2, bytes([8, *(16 * rows).to_bytes(2, "big"), *(16 * columns).to_bytes(2, "big"), 3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
        out.append(b"".join([b"\xff\xd8", _segment(0xFE, comment), tables, frame, *(x for header, parts in scans for x in (header, parts[i])), b"\xff\xd9"]))
    return out


# ---- reading


@dataclass
class Image:
    """A parsed file; coefficients of component c are blocks[c] (rows x columns x 64, zigzag)."""

    comment: bytes = b""
    height: int = 0
    width: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, horizontal, vertical, table
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    bases: list[int] = field(default_factory=list)
    shapes: list[tuple[int, int]] = field(default_factory=list)  # rows and columns of blocks, whole MCUs
    used: list[tuple[int, int]] = field(default_factory=list)  # those that a scan of the component alone holds


@lru_cache(4096)
def _order(grid: tuple, parts: tuple, shapes: tuple, used: tuple, bases: tuple) -> tuple[np.ndarray, np.ndarray, int]:
    """Blocks in the order of a scan, the component's place in the scan of each, and blocks in an MCU."""
    if len(parts) == 1:
        (c, _, _), (rows, columns) = parts[0], used[0]
        return (np.arange(rows)[:, None] * shapes[0][1] + np.arange(columns)).ravel() + bases[0], np.zeros(rows * columns, "i8"), 1
    my, mx = np.divmod(np.arange(grid[0] * grid[1]), grid[1])
    out, which = [], []
    for k, (_, h, v) in enumerate(parts):
        for y in range(v):
            for x in range(h):
                out.append((my * v + y) * shapes[k][1] + mx * h + x + bases[k])
                which.append(k)
    return np.stack(out, axis=1).ravel(), np.tile(which, len(my)), len(which)


class Lanes:
    """Restart intervals of one kind of scan: where their bits and their blocks are."""

    def __init__(self, clean: np.ndarray, starts, blocks: np.ndarray, counts: np.ndarray):
        self.window = np.ndarray((len(clean) - 7,), ">u8", clean, strides=(1,))
        self.pos, self.blocks = np.asarray(starts, "i8") * 8, blocks
        self.next = np.cumsum(counts) - counts
        self.stop = self.next + counts

    def bits(self, pos):
        return self.window[pos >> 3].astype("u8") << (pos & 7).astype("u8")


def _symbol(lanes: Lanes, pos, lut):
    w = lanes.bits(pos)
    e = lut[(w >> np.uint64(48)).astype("i8")]
    if not e.all():
        raise ValueError("no such Huffman code")
    n = e >> 8
    return e & 255, n, w << n.astype("u8")


def _extra(w, size):
    """The next `size` bits as the standard's signed value."""
    raw = ((w >> np.uint64(1)) >> (63 - size).astype("u8")).astype("i8")
    return np.where((size > 0) & (raw < (1 << np.maximum(size - 1, 0))), raw - (1 << size) + 1, raw)


def _dc_first(lanes: Lanes, coef, luts: np.ndarray, which: np.ndarray, low: int) -> None:
    live = np.flatnonzero(lanes.next < lanes.stop)
    previous = np.zeros((len(lanes.pos), int(which.max(initial=0)) + 1), "i8")
    while len(live):
        at, pos = lanes.next[live], lanes.pos[live]
        k = which[at]
        w = lanes.bits(pos)
        e = luts[k, (w >> np.uint64(48)).astype("i8")]
        n, size = e >> 8, e & 255
        previous[live, k] += _extra(w << n.astype("u8"), size)
        coef[lanes.blocks[at], 0] = previous[live, k] << low
        lanes.pos[live] = pos + n + size
        lanes.next[live] = at + 1
        live = live[at + 1 < lanes.stop[live]]


def _dc_more(lanes: Lanes, coef, low: int) -> None:
    counts = lanes.stop - lanes.next
    lane = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(lane))
    pos = lanes.pos[lane] + at - lanes.next[lane]
    bit = (lanes.bits(pos) >> np.uint64(63)).astype(coef.dtype)
    coef[lanes.blocks[lanes.next[lane] + at - lanes.next[lane]], 0] |= bit << low


def _ac_first(lanes: Lanes, coef, lut, first: int, last: int, low: int) -> None:
    flat = coef.reshape(-1)
    at, stop, pos, k = lanes.next.copy(), lanes.stop, lanes.pos, np.full(len(lanes.pos), first)
    live = at < stop
    if not live.all():
        at, stop, pos, k = at[live], stop[live], pos[live], k[live]
    while len(at):
        symbol, n, w = _symbol(lanes, pos, lut)
        run, size = symbol >> 4, symbol & 15
        some = size > 0
        if some.all():
            k = k + run
            flat[lanes.blocks[at] * 64 + k] = _extra(w, size) << low
            pos = pos + n + size
            k += 1
            done = k > last
            at = at + done
        else:
            end = ~some & (run < 15)
            bits = np.where(end, run, size)
            value = _extra(w, size)
            put = np.flatnonzero(some)
            flat[lanes.blocks[at[put]] * 64 + (k + run)[put]] = value[put] << low
            skip = (1 << np.where(end, run, 0)) + ((w >> np.uint64(1)) >> (63 - np.where(end, run, 0)).astype("u8")).astype("i8")
            pos = pos + n + bits
            k = k + run + 1
            done = (k > last) | end
            at = at + np.where(end, skip, done)
        k = np.where(done, first, k)
        live = at < stop
        if not live.all():
            at, stop, pos, k = at[live], stop[live], pos[live], k[live]


def _ac_more(lanes: Lanes, coef, lut, first: int, last: int, low: int) -> None:
    """Refinement: a lane reads a symbol when it has none, then goes one coefficient on."""
    flat, one = coef.reshape(-1), 1 << low
    at, stop, pos = lanes.next.copy(), lanes.stop, lanes.pos.copy()
    k, run, value, ends = (np.full(len(at), first), *(np.zeros(len(at), "i8") for _ in range(3)))
    need = np.ones(len(at), bool)
    while True:
        live = at < stop
        if not live.all():
            at, stop, pos, k, run, value, ends, need = (x[live] for x in (at, stop, pos, k, run, value, ends, need))
        if not len(at):
            return
        ask = np.flatnonzero(need)
        if len(ask):
            symbol, n, w = _symbol(lanes, pos[ask], lut)
            r, size = symbol >> 4, symbol & 15
            end = (size == 0) & (r < 15)
            used = np.where(end, r, size)
            raw = ((w >> np.uint64(1)) >> (63 - used).astype("u8")).astype("i8")
            run[ask], value[ask] = r, np.where(size > 0, np.where(raw == 1, one, -one), 0)
            ends[ask] = np.where(end, (1 << r) + raw, 0)
            pos[ask] += n + used
            need[ask] = False
        cell = lanes.blocks[at] * 64 + k
        have = flat[cell].astype("i8")
        old = have != 0
        bit = (lanes.bits(pos) >> np.uint64(63)).astype("i8")
        place = ~old & (ends == 0) & (run == 0)
        flat[cell] = np.where(old, have + np.sign(have) * one * bit, np.where(place, value, have))
        pos += old
        run -= ~old & ~place & (ends == 0)
        need |= place
        k += 1
        over = k > last
        at += over
        k[over] = first
        ends -= over & (ends > 0)
        need |= over & (ends == 0)


def read(files: list[bytes]) -> tuple[list[Image], np.ndarray]:
    """Parsed files and all their coefficient blocks (blocks x 64, zigzag)."""
    whole = np.frombuffer(b"".join([*files, bytes(16)]), "u1")
    after = np.append(whole[1:], np.uint8(0))
    ff = whole == 255
    restart = ff & (after >= 0xD0) & (after <= 0xD7)
    marks = np.flatnonzero(ff & (after != 0) & (after != 255) & ~restart)
    restarts = np.flatnonzero(restart)
    images, total, offset, scans = [], 0, 0, {}
    for data in files:
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        image, luts, interval, p = Image(), {}, 0, 2
        while True:
            marker = data[p + 1]
            if marker == 0xD9:
                break
            n = int.from_bytes(data[p + 2 : p + 4], "big")
            body, p = data[p + 4 : p + 2 + n], p + 2 + n
            if marker == 0xFE:
                image.comment = body
            elif marker == 0xDD:
                interval = int.from_bytes(body[:2], "big")
            elif marker == 0xDB:
                q = 0
                while q < len(body):
                    wide = body[q] >> 4
                    image.quant[body[q] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, q + 1).astype("i8")
                    q += 1 + 64 * (1 + wide)
            elif marker == 0xC4:
                q = 0
                while q < len(body):
                    m = sum(body[q + 1 : q + 17])
                    luts[body[q]] = (bytes(body[q + 1 : q + 17]), bytes(body[q + 17 : q + 17 + m]))
                    q += 17 + m
            elif marker == 0xC2:
                image.height, image.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
                image.components = [(body[6 + 3 * c], body[7 + 3 * c] >> 4, body[7 + 3 * c] & 15, body[8 + 3 * c]) for c in range(body[5])]
                wide, high = max(c[1] for c in image.components), max(c[2] for c in image.components)
                grid = (-(-image.height // (8 * high)), -(-image.width // (8 * wide)))
                for _, h, v, _ in image.components:
                    image.bases.append(total)
                    image.shapes.append((grid[0] * v, grid[1] * h))
                    image.used.append((-(-image.height * v // (8 * high)), -(-image.width * h // (8 * wide))))
                    total += grid[0] * v * grid[1] * h
            elif marker == 0xDA:
                chosen = [next(i for i, c in enumerate(image.components) if c[0] == body[1 + 2 * k]) for k in range(body[0])]
                tables = [body[2 + 2 * k] for k in range(body[0])]
                first, last, step = body[-3:]
                keys = tuple(luts.get(t >> 4 if first == 0 else 16 + (t & 15)) for t in tables)
                end = int(marks[np.searchsorted(marks, offset + p)]) - offset
                at = [chosen, grid, interval, offset + p, offset + end]
                scans.setdefault((first, last, step >> 4, step & 15, keys), []).append((image, at))
                p = end
            elif 0xC0 <= marker <= 0xCF:
                raise ValueError("not a progressive JPEG of Huffman codes")
        images.append(image)
        offset += len(data)
    # without stuffing and restart markers
    drop = np.zeros(len(whole), bool)
    drop[1:] = ff[:-1] & (whole[1:] == 0)
    drop[restarts] = drop[restarts + 1] = True
    clean = np.ascontiguousarray(whole[~drop])
    place = np.cumsum(~drop) - ~drop
    coef = np.zeros((total, 64), "i2")
    for (first, last, high, low, keys), group in sorted(scans.items(), key=lambda x: (x[0][2] > 0, -x[0][2])):  # first steps come first
        starts, blocks, counts, parts = [], [], [], []
        for image, (chosen, grid, interval, a, b) in group:
            order, which, per = _order(grid, tuple((c, *image.components[c][1:3]) for c in chosen), tuple(image.shapes[c] for c in chosen), tuple(image.used[c] for c in chosen), tuple(image.bases[c] - image.bases[chosen[0]] for c in chosen))
            inner = restarts[np.searchsorted(restarts, a) : np.searchsorted(restarts, b)]
            n = -(-len(order) // (per * interval)) if interval else 1
            if len(inner) != n - 1:
                raise ValueError("restart markers are missing")
            starts.append(np.concatenate([[a], inner + 2]))
            counts.append(np.diff(np.minimum(np.arange(n + 1) * (per * interval or len(order)), len(order))))
            blocks.append(order + image.bases[chosen[0]])
            parts.append(which)
        lanes = Lanes(clean, place[np.concatenate(starts)], np.concatenate(blocks), np.concatenate(counts))
        if first == 0:
            _dc_more(lanes, coef, low) if high else _dc_first(lanes, coef, np.stack([_lookup(*k) for k in keys]), np.concatenate(parts), low)
        else:
            (_ac_more if high else _ac_first)(lanes, coef, _lookup(*keys[0]), first, last, low)
    return images, coef


def rgb(images: list[Image], coef: np.ndarray) -> list[np.ndarray]:
    """Full-resolution RGB tensors (height x width x 3, unsigned 8 bits)."""
    scaled = coef.astype("f8")
    for image in images:
        for (_, _, _, q), base, (rows, columns) in zip(image.components, image.bases, image.shapes, strict=True):
            if (image.quant[q] != 1).any():
                scaled[base : base + rows * columns] *= image.quant[q]
    samples = np.clip((scaled @ INVERSE + (128 * 4096 + 2048)).astype("i4") >> 12, 0, 255).astype("i4")
    out = []
    for image in images:
        planes = []
        wide, high = max(c[1] for c in image.components), max(c[2] for c in image.components)
        for (_, h, v, _), base, (rows, columns) in zip(image.components, image.bases, image.shapes, strict=True):
            plane = samples[base : base + rows * columns].reshape(rows, columns, 8, 8).swapaxes(1, 2).reshape(rows * 8, columns * 8)
            if (h, v) != (wide, high):
                plane = plane.repeat(high // v, axis=0).repeat(wide // h, axis=1)
            planes.append(plane[: image.height, : image.width])
        if len(planes) == 1:
            out.append(np.repeat(planes[0][:, :, None], 3, axis=2).astype("u1"))
            continue
        y, cb, cr = planes[0] << 16, planes[1] - 128, planes[2] - 128
        full = np.stack([y + 91881 * cr, y - 22554 * cb - 46802 * cr, y + 116130 * cb], axis=2)
        out.append(np.clip((full + 32768) >> 16, 0, 255).astype("u1"))
    return out
