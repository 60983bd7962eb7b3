"""Lossless WebP: a full decoder of the VP8L bitstream, and a writer that picks its tools by content.

The decoder reads prefix codes (simple and normal, several groups by a meta image),
literals, back-references and the colour cache, and inverts predictor, cross-colour,
subtract-green and palette transforms; it returns the pixel array (height, width, RGBA).
An image with one group is decoded speculatively: what a token that began at each bit would be is
computed for a window of bits at a time as arrays, and the chain of real tokens is followed through it; memory
follows the window. Of many images, one token of each is read at a time (``decode_all``). Images with several groups are read token
by token. The result is the same.

The writer (``encode``) estimates the entropy of the image as it is, without green, with predicted samples
(a mode for each tile), with colours predicted from each other, and as indices of a palette, and keeps the least;
then it replaces repeated runs by back-references, uses a colour cache where it saves bits, and
builds prefix codes from what is left. Its predictor modes are those that can be undone a row at a time.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np

# Fixed values of the format: the order of code length codes, and the near distances as (x, y).
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2),
    (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0),
    (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4),
    (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3),
    (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4),
    (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7),
    (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
MOST = 1 << 14
#: Bits that are looked at together.
WINDOW = 1 << 16
MULTIPLIER = 0x1E35A7BD


class Bits:
    """A reader of bits, least significant first."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def read(self, n: int) -> int:
        if not n:
            return 0
        first, last = self.at >> 3, (self.at + n + 7) >> 3
        if last > len(self.data):
            raise ValueError("the stream ends early")
        value = int.from_bytes(self.data[first:last], "little") >> (self.at & 7)
        self.at += n
        return value & ((1 << n) - 1)

    def same(self, a: int, b: int, n: int) -> bool:
        """Whether the n bits from a on and those from b on are alike."""
        x, y = (int.from_bytes(self.data[i >> 3 : (i + n + 7) >> 3], "little") >> (i & 7) for i in (a, b))
        return not (x ^ y) & ((1 << n) - 1)


@lru_cache(16)
def mirrored(n: int) -> np.ndarray:
    """The numbers below 2^n with their n bits in reverse order."""
    out = np.zeros(1 << n, np.uint32)
    for k in range(n):
        out |= ((np.arange(1 << n, dtype=np.uint32) >> k) & 1) << (n - 1 - k)
    return out


class Code:
    """A prefix code: a table from the next ``most`` bits to 16 * symbol + length."""

    def __init__(self, symbols: list[int], lengths: list[int]):
        """symbols in ascending order, and the length of each."""
        self.single = symbols[0] if len(symbols) == 1 else None if symbols else 0
        if self.single is not None:
            self.most, self.table = 0, np.array([self.single << 4], np.uint16)
        else:
            n = np.array(lengths)
            order = n.argsort(kind="stable")
            n = n.take(order)
            self.most = int(n[-1])
            table = (np.array(symbols).take(order) << 4 | n).repeat(1 << (self.most - n))
            if len(table) != 1 << self.most:
                raise ValueError("a prefix code is not complete")
            self.table = table.astype(np.uint16).take(mirrored(self.most))
        self.mask = (1 << self.most) - 1
        self.sizes = (self.table & 15).astype(np.int64)
        self.quick = None

    def read(self, bits: Bits) -> int:
        if self.single is not None:
            return self.single
        if self.quick is None:
            self.quick = self.table.tolist()
        at = bits.at
        value = int.from_bytes(bits.data[at >> 3 : (at >> 3) + 3], "little") >> (at & 7)
        found = self.quick[value & self.mask]
        bits.at = at + (found & 15)
        if bits.at > 8 * len(bits.data):
            raise ValueError("the stream ends early")
        return found >> 4


def small_table(told: list[tuple[int, int]]) -> tuple[list[int], int]:
    """The table of a code for code lengths, from (symbol, length), as a list, and its mask."""
    if len(told) < 2:
        return [told[0][0] << 4 if told else 0], 0
    most = max(n for _, n in told)
    table, code, back = [0] * (1 << most), 0, mirrored(most)
    for symbol, n in sorted(told, key=lambda x: (x[1], x[0])):
        if code >> most:
            raise ValueError("a prefix code is not complete")
        first = int(back[code])
        table[first :: 1 << n] = [symbol << 4 | n] * (1 << (most - n))
        code += 1 << (most - n)
    if code != 1 << most:
        raise ValueError("a prefix code is not complete")
    return table, (1 << most) - 1


def read_code(bits: Bits, size: int) -> Code:
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        symbols = [bits.read(8 if wide else 1)]
        if two:
            symbols.append(bits.read(8))
        symbols = sorted({x for x in symbols if x < size})
        return Code(symbols, [1] * len(symbols))
    count = 4 + bits.read(4)
    value = bits.read(3 * count)
    table, mask = small_table([(LENGTH_ORDER[i], n) for i in range(count) if (n := value >> (3 * i) & 7)])
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    # The lengths are read from numbers of 64 bytes; each takes 14 bits at most.
    data, start = bits.data, bits.at
    value = int.from_bytes(data[start >> 3 : (start >> 3) + 64], "little") >> (start & 7)
    base = at = 0
    symbols, lengths, symbol, before = [], [], 0, 8
    while symbol < size and left:
        left -= 1
        if at > 480:
            base, at = base + at, 0
            value = int.from_bytes(data[(start + base) >> 3 : ((start + base) >> 3) + 64], "little") >> ((start + base) & 7)
        found = table[value >> at & mask]
        at += found & 15
        n = found >> 4
        if n < 16:
            if n:
                symbols.append(symbol)
                lengths.append(n)
                before = n
            symbol += 1
            continue
        more = (2, 3, 7)[n - 16]
        count = (3, 3, 11)[n - 16] + (value >> at & ((1 << more) - 1))
        at += more
        if symbol + count > size:
            raise ValueError("too many code lengths")
        if n == 16:
            symbols += range(symbol, symbol + count)
            lengths += [before] * count
        symbol += count
    bits.at += base + at
    if bits.at > 8 * len(bits.data):
        raise ValueError("the stream ends early")
    return Code(symbols, lengths)


def read_codes(bits: Bits, cache: int) -> list[Code]:
    """The five codes of a group. Bits that repeat those of the code before, of as many symbols, tell of the same code and are not parsed again."""
    out = [read_code(bits, 280 + (1 << cache if cache else 0))]
    start, size = bits.at, 0
    for _ in range(3):
        if size and bits.at + size <= 8 * len(bits.data) and bits.same(start, bits.at, size):
            bits.at += size
            out.append(out[-1])
        else:
            start = bits.at
            out.append(read_code(bits, 256))
            size = bits.at - start
    out.append(read_code(bits, 40))
    return out


def extended(bits: Bits, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    more = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << more) + bits.read(more) + 1


@lru_cache(64)
def near_distances(width: int) -> np.ndarray:
    """Pixels that each of the 120 near distance codes goes back."""
    return np.array([max(1, dx + dy * width) for dx, dy in NEAR], np.int64)


def tokens(bits: Bits, codes: list[Code], n: int, width: int):
    """Kind (0 literal, 1 reference, 2 cache), value (ARGB, distance, or cache code) and length of the tokens of n pixels."""
    green, red, blue, alpha, distance = codes
    data, limit = bits.data, 8 * len(bits.data)
    kinds, values, lengths = [], [], []
    done = 0
    while done < n:
        if bits.at >= limit:
            raise ValueError("the stream ends early")
        size = min(WINDOW, limit - bits.at)
        first, shift = bits.at >> 3, bits.at & 7
        wide = (size + 7 >> 3) + 24
        b = np.zeros(wide + 2, np.int64)
        raw = np.frombuffer(data, np.uint8, min(wide + 2, len(data) - first), first)
        b[: len(raw)] = raw
        # The next 15 bits at each bit.
        ahead = (((b[:-2] | b[1:-1] << 8 | b[2:] << 16)[:, None] >> np.arange(8)) & 0x7FFF).ravel()[shift:]
        masked = ahead[:size] & green.mask
        g = green.table.take(masked)
        step = green.sizes.take(masked)
        past = np.arange(size) + step
        if red is blue is alpha and red.most:
            # One code for all three: where a symbol that begins at a bit ends is looked up once.
            hop = red.sizes.take(ahead[: size + 45] & red.mask)
            hop += np.arange(len(hop))
            past = hop.take(hop.take(hop.take(past)))
        else:
            for c in (red, blue, alpha):
                if c.most:
                    past += c.sizes.take(ahead.take(past) & c.mask)
        other = (g >= 256 << 4).nonzero()[0]
        if len(other):
            past[other] = other + step.take(other)  # codes of the cache have no more bits
            back = other[g.take(other) < 280 << 4]
            symbol, q = (g.take(back) >> 4).astype(np.int64) - 256, past.take(back)
            q = q + np.where(symbol >= 4, (symbol - 2) >> 1, 0)
            d = distance.table.take(ahead.take(q) & distance.mask)
            symbol = (d >> 4).astype(np.int64)
            past[back] = q + (d & 15) + np.where(symbol >= 4, (symbol - 2) >> 1, 0)
        chain, p, ends = [], 0, memoryview(past)
        while p < size:
            chain.append(p)
            q = ends[p]
            if q <= p:  # tokens of no bits: all that follow are the same
                chain += [p] * min(n - done - len(chain), 1 << 16)
                break
            p = q
        took = np.array(chain, np.int64)
        symbol = (g.take(took) >> 4).astype(np.int64)
        kind = (symbol >= 256).astype(np.int8) + (symbol >= 280)
        q = took + step.take(took)
        value = symbol << 8
        for c, k in ((red, 16), (blue, 0), (alpha, 24)):
            if not c.most:
                value |= c.single << k
                continue
            e = c.table.take(ahead.take(q) & c.mask).astype(np.int64)
            value |= e >> 4 << k
            q += e & 15
        length = np.ones(len(took), np.int64)
        back = np.flatnonzero(kind == 1)
        if len(back):
            s = symbol[back] - 256
            q = took[back] + step[took[back]]
            more = np.where(s >= 4, (s - 2) >> 1, 0)
            length[back] = np.where(s < 4, s, ((2 + (s & 1)) << more) + (ahead[q] & ((1 << more) - 1))) + 1
            q = q + more
            e = distance.table[ahead[q] & distance.mask]
            s, q = (e >> 4).astype(np.int64), q + (e & 15)
            more = np.where(s >= 4, (s - 2) >> 1, 0)
            wide_ahead = ahead[q].astype(np.int64) | ahead[q + 15].astype(np.int64) << 15
            code = np.where(s < 4, s, ((2 + (s & 1)) << more) + (wide_ahead & ((1 << more) - 1))) + 1
            near = near_distances(width)
            value[back] = np.where(code > 120, code - 120, near[np.minimum(code, 120) - 1])
        value = np.where(kind == 2, symbol - 280, value)
        total = np.cumsum(length)
        keep = min(len(took), int(np.searchsorted(total, n - done)) + 1)
        kinds.append(kind[:keep])
        values.append(value[:keep])
        lengths.append(length[:keep])
        done += int(total[keep - 1])
        bits.at += int(ends[chain[keep - 1]])
        if bits.at > limit:
            raise ValueError("the stream ends early")
    if done != n:
        raise ValueError("a back-reference leaves the image")
    return np.concatenate(kinds), np.concatenate(values), np.concatenate(lengths)


def tokens_side_by_side(asked: list[tuple[Bits, list[Code], int, int]], few: int = 24) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``tokens`` gives for each (bits, codes, n, width): a token of every image at a time; when few images are left, these go on alone."""
    many = len(asked)
    if many < few:
        return [tokens(*x) for x in asked]
    streams = [x[0].data + bytes(16) for x in asked]
    data = b"".join(streams)
    words = np.ndarray(len(data) - 7, "<i8", data, strides=(1,)).copy()  # the next 57 bits or more at each byte
    begin = 8 * (np.cumsum([len(x) for x in streams]) - [len(x) for x in streams])
    limit = begin + [8 * len(x[0].data) for x in asked]
    tables = np.concatenate([c.table for x in asked for c in x[1]])
    size = np.array([[len(c.table) for c in x[1]] for x in asked])
    mask = (size - 1).T.copy()
    base = (np.cumsum(size.ravel()) - size.ravel()).reshape(size.shape).T.copy()
    live, at, left = np.arange(many), begin + [x[0].at for x in asked], np.array([x[2] for x in asked])
    held, references, told = [], [], 0
    while len(live) >= few:
        x = words.take(at >> 3) >> (at & 7)
        g = tables.take(base[0] + (x & mask[0]))
        step = (g & 15).astype(np.int64)
        x >>= step
        r = tables.take(base[1] + (x & mask[1]))
        used = (r & 15).astype(np.int64)
        x >>= used
        used += step
        b = tables.take(base[2] + (x & mask[2]))
        used += b & 15
        past = at + used
        a = tables.take(base[3] + ((words.take(past >> 3) >> (past & 7)) & mask[3]))
        past += a & 15
        left = left - 1
        other = (g >= 256 << 4).nonzero()[0]
        if len(other):
            past[other] = at[other] + step[other]
            back = other[g[other] < 280 << 4]
            if len(back):
                q = past[back]
                y = words.take(q >> 3) >> (q & 7)
                symbol = (g[back] >> 4).astype(np.int64) - 256
                more = np.where(symbol >= 4, (symbol - 2) >> 1, 0)
                length = np.where(symbol < 4, symbol, ((2 + (symbol & 1)) << more) + (y & ((1 << more) - 1))) + 1
                y >>= more
                d = tables.take(base[4][back] + (y & mask[4][back])).astype(np.int64)
                y >>= d & 15
                symbol = d >> 4
                further = np.where(symbol >= 4, (symbol - 2) >> 1, 0)
                code = np.where(symbol < 4, symbol, ((2 + (symbol & 1)) << further) + (y & ((1 << further) - 1))) + 1
                past[back] = q + more + (d & 15) + further
                left[back] -= length - 1
                references.append((told + back, length, code))
        if (past > limit).any():
            raise ValueError("the stream ends early")
        held.append((live, g, r, b, a))
        told += len(live)
        at = past
        if left.min() <= 0:
            if left.min() < 0:
                raise ValueError("a back-reference leaves the image")
            keep = left.nonzero()[0]
            live, at, left, limit, base, mask = live[keep], at[keep], left[keep], limit[keep], base[:, keep], mask[:, keep]
    owner, g, r, b, a = (np.concatenate(x) for x in zip(*held))
    symbol = (g >> 4).astype(np.int64)
    kind = (symbol >= 256).astype(np.int8) + (symbol >= 280)
    value = symbol << 8 | (r >> 4).astype(np.int64) << 16 | b >> 4 | (a >> 4).astype(np.int64) << 24
    value = np.where(kind == 2, symbol - 280, value)
    lengths = np.ones(len(owner), np.int64)
    if references:
        place, length, code = (np.concatenate(x) for x in zip(*references))
        widths, which = np.unique([x[3] for x in asked], return_inverse=True)
        near = np.stack([near_distances(int(w)) for w in widths])
        lengths[place] = length
        value[place] = np.where(code > 120, code - 120, near[which[owner[place]], np.minimum(code, 120) - 1])
    order = np.argsort(owner.astype(np.uint16) if many < 1 << 16 else owner, kind="stable")
    ends = np.cumsum(np.bincount(owner, minlength=many))[:-1]
    out = list(zip(*(np.split(x[order], ends) for x in (kind, value, lengths))))
    for i, p, n in zip(live.tolist(), at.tolist(), left.tolist()):
        bits, codes, _, width = asked[i]
        bits.at = p - int(begin[i])
        out[i] = tuple(np.concatenate(x) for x in zip(out[i], tokens(bits, codes, n, width)))
    return out


def resolve(kind: np.ndarray, value: np.ndarray, length: np.ndarray, n: int, cache: int) -> np.ndarray:
    """The n ARGB numbers that tokens stand for."""
    start = np.cumsum(length) - length
    back = np.flatnonzero(kind == 1)
    if (value[back] > start[back]).any():
        raise ValueError("a back-reference leaves the image")
    out = np.zeros(n, np.uint32)
    literal = kind == 0
    out[start[literal]] = value[literal]
    source = np.arange(n)

    def follow(own: np.ndarray) -> None:
        """Sources of sources, until nothing changes."""
        while len(own):
            now = source.take(own)
            further = source.take(now)
            change = further != now
            own = own[change]
            source[own] = further[change]

    copies = np.empty(0, np.int64)
    if len(back):
        m, at = length[back], start[back]
        copies = np.repeat(at, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        source[copies] = copies - np.repeat(value[back], m)
        follow(copies)
    drawn = np.flatnonzero(kind == 2)
    if len(drawn):
        # A cache's place holds the last pixel that was put there, however it was coded.
        place = ((out * np.uint32(MULTIPLIER)) >> np.uint32(32 - cache)).astype(np.uint16)
        t = start[drawn]
        place[t] = value[drawn]
        place[copies] = place[source[copies]]
        order = np.argsort(place, kind="stable")
        same = place[order[1:]] == place[order[:-1]]
        before = np.full(n + 1, -1)
        before[order[1:][same]] = order[:-1][same]
        source[t] = np.where(before[t] >= 0, before[t], t)  # nothing was put there: colour 0
        copies = np.concatenate([copies, t])
        follow(copies)
    out[copies] = out[source[copies]]
    return out


def at_once(reading):
    """The result of a reading that asks for tokens, each of which is read when it is asked for."""
    try:
        asked = next(reading)
        while True:
            asked = reading.send(tokens(*asked))
    except StopIteration as end:
        return end.value


def read_image(bits: Bits, width: int, height: int, main: bool):
    """width * height pixels as (n, 4) samples A, R, G, B, by a reading that asks for the tokens."""
    cache = bits.read(4) if bits.read(1) else 0
    groups, meta, tile = 1, None, 0
    if main and bits.read(1):
        tile = bits.read(3) + 2
        w, h = -(-width >> tile), -(-height >> tile)
        pixels = at_once(read_image(bits, w, h, False)).astype(int)
        meta = (pixels[:, 1] << 8 | pixels[:, 2]).reshape(h, w)
        groups = int(meta.max()) + 1
    codes = [read_codes(bits, cache) for _ in range(groups)]
    n = width * height
    if meta is not None:
        found = np.array(one_by_one(bits, codes, meta, tile, n, width, cache), np.uint32)
    elif not any(c.most for c in codes[0][:4]) and codes[0][0].single < 256:
        g, r, b, a = (c.single for c in codes[0][:4])
        return np.tile(np.array([a, r, g, b], np.uint8), (n, 1))
    else:
        found = resolve(*(yield bits, codes[0], n, width), n, cache)
    return found.astype(">u4").view(np.uint8).reshape(n, 4)


def one_by_one(bits: Bits, codes: list[list[Code]], meta: np.ndarray, tile: int, n: int, width: int, cache: int) -> list[int]:
    """The ARGB numbers of an image whose codes change from tile to tile."""
    out: list[int] = []
    colours = [0] * (1 << cache)

    def put(argb: int) -> None:
        out.append(argb)
        if cache:
            colours[(MULTIPLIER * argb & 0xFFFFFFFF) >> (32 - cache)] = argb

    while len(out) < n:
        y, x = divmod(len(out), width)
        green, red, blue, alpha, distance = codes[meta[y >> tile, x >> tile]]
        symbol = green.read(bits)
        if symbol < 256:
            r = red.read(bits)
            b = blue.read(bits)
            put(alpha.read(bits) << 24 | r << 16 | symbol << 8 | b)
        elif symbol < 280:
            length = extended(bits, symbol - 256)
            code = extended(bits, distance.read(bits))
            back = code - 120 if code > 120 else int(near_distances(width)[code - 1])
            if back > len(out) or len(out) + length > n:
                raise ValueError("a back-reference leaves the image")
            for _ in range(length):
                put(out[-back])
        else:
            put(colours[symbol - 280])
    return out


def _average(a, b):
    return (a + b) >> 1


def _predict(mode: int, l, t, tr, tl) -> np.ndarray:
    if mode == 11:
        return l if np.abs(t - tl).sum() < np.abs(l - tl).sum() else t
    if mode == 12:
        return np.clip(l + t - tl, 0, 255)
    if mode == 13:
        a = _average(l, t)
        return np.clip(a + np.trunc((a - tl) / 2).astype(int), 0, 255)
    return {
        1: lambda: l, 2: lambda: t, 3: lambda: tr, 4: lambda: tl, 5: lambda: _average(_average(l, tr), t), 6: lambda: _average(l, tl),
        7: lambda: _average(l, t), 8: lambda: _average(tl, t), 9: lambda: _average(t, tr), 10: lambda: _average(_average(l, tl), _average(t, tr)),
    }.get(mode, lambda: np.array([255, 0, 0, 0]))()


#: Modes that need nothing of their own row but the pixel to the left of the image's first column.
ABOVE = {0, 2, 3, 4, 8, 9, 14, 15}


def from_above(mode: int, top: np.ndarray, right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Predictions of a row's pixels by modes of ABOVE, from the pixels above, above to the right, and above to the left."""
    if mode == 2:
        return top
    if mode == 3:
        return right
    if mode == 4:
        return left
    if mode == 8:
        return _average(left, top)
    if mode == 9:
        return _average(top, right)
    return np.broadcast_to(np.array([255, 0, 0, 0], top.dtype), top.shape)


def undo_predictor(pixels: np.ndarray, modes: np.ndarray, tile: int) -> np.ndarray:
    """The pixels whose predictions were subtracted; runs of tiles with one mode are undone at once where their mode allows it."""
    h, w, _ = pixels.shape
    out = pixels.astype(np.int32)
    out[0, 0, 0] += 255
    out[0] = np.cumsum(out[0], axis=0) & 255
    runs: list[tuple[int, int, int]] = []
    for y in range(1, h):
        if y == 1 or y & ((1 << tile) - 1) == 0:
            of_tile = (modes[y >> tile].astype(int) & 15).tolist()
            runs = []
            for k, mode in enumerate(of_tile):
                a, b = max(1, k << tile), min(w, k + 1 << tile)
                if runs and runs[-1][2] == mode:
                    runs[-1] = (runs[-1][0], b, mode)
                elif a < b:
                    runs.append((a, b, mode))
        above, row = out[y - 1], out[y]
        row[0] = (row[0] + above[0]) & 255
        right = np.concatenate([above[1:], row[:1]])
        for a, b, mode in runs:
            if mode in ABOVE:
                row[a:b] = (row[a:b] + from_above(mode, above[a:b], right[a:b], above[a - 1 : b - 1])) & 255
            elif mode == 1:
                row[a - 1 : b] = np.cumsum(row[a - 1 : b], axis=0) & 255
            else:
                for x in range(a, b):
                    row[x] = (row[x] + _predict(mode, row[x - 1], above[x], right[x], above[x - 1])) & 255
    return out


def undo_cross_colour(pixels: np.ndarray, elements: np.ndarray, tile: int) -> np.ndarray:
    h, w, _ = pixels.shape
    e = elements.astype(np.uint8).view(np.int8).astype(int)[np.arange(h)[:, None] >> tile, np.arange(w) >> tile]
    signed = lambda x: ((x & 255) ^ 128) - 128
    out = pixels.astype(int)
    green = signed(out[..., 2])
    out[..., 1] = (out[..., 1] + (e[..., 3] * green >> 5)) & 255
    out[..., 3] = (out[..., 3] + (e[..., 2] * green >> 5) + (e[..., 1] * signed(out[..., 1]) >> 5)) & 255
    return out


def decode(stored: bytes) -> np.ndarray:
    """The (height, width, 4) RGBA samples of a lossless WebP file."""
    return at_once(decoding(stored))


def decode_all(stored: list[bytes]) -> list[np.ndarray]:
    """The samples of several files, whose tokens are read side by side."""
    out: list = [None] * len(stored)
    waiting, asked = [], []
    for i, x in enumerate(stored):
        reading = decoding(x)
        try:
            asked.append(next(reading))
            waiting.append((i, reading))
        except StopIteration as end:
            out[i] = end.value
    for (i, reading), found in zip(waiting, tokens_side_by_side(asked)):
        try:
            reading.send(found)
        except StopIteration as end:
            out[i] = end.value
    return out


def decoding(stored: bytes):
    """The reading of a file: it asks for the main image's tokens, and its result is the samples."""
    if stored[:4] != b"RIFF" or stored[8:16] != b"WEBPVP8L":
        raise ValueError("not a lossless WebP file")
    bits = Bits(stored, 20 * 8)
    if bits.read(8) != 0x2F:
        raise ValueError("no VP8L signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, now = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (0, 1):
            tile = bits.read(3) + 2
            w, h = -(-now >> tile), -(-height >> tile)
            image = at_once(read_image(bits, w, h, False)).reshape(h, w, 4)
            undo.append((kind, tile, image, now))
        elif kind == 2:
            undo.append((2, 0, None, now))
        else:
            n = bits.read(8) + 1
            palette = np.cumsum(at_once(read_image(bits, n, 1, False)).astype(int), axis=0) & 255
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            undo.append((3, pack, palette, now))
            now = -(-now >> pack)
    pixels = (yield from read_image(bits, now, height, True)).reshape(height, now, 4)
    for kind, tile, image, w in reversed(undo):
        if kind == 0:
            pixels = undo_predictor(pixels, image[..., 2], tile)
        elif kind == 1:
            pixels = undo_cross_colour(pixels, image, tile)
        elif kind == 2:
            pixels = pixels.astype(int)
            pixels[..., [1, 3]] = (pixels[..., [1, 3]] + pixels[..., 2:3]) & 255
        else:
            x = np.arange(w)
            index = pixels[:, x >> tile, 2].astype(int) >> ((x & ((1 << tile) - 1)) * (8 >> tile)) & ((1 << (8 >> tile)) - 1)
            full = np.zeros((256, 4), int)
            full[: len(image)] = image
            pixels = full[index]
    return pixels.astype(np.uint8, copy=False)[..., [1, 2, 3, 0]]


def code_lengths(counts: list[np.ndarray], most: int = 15) -> list[np.ndarray]:
    """Lengths of complete prefix codes, all at once: near the symbols' information, then shortened, the most frequent first, until each code is full."""
    flat = np.concatenate(counts)
    ends = np.cumsum([len(c) for c in counts])
    used = np.flatnonzero(flat)
    owner = np.searchsorted(ends, used, "right")
    c = flat[used].astype(float)
    many = np.bincount(owner, minlength=len(counts))
    c = np.maximum(c, np.bincount(owner, c, len(counts))[owner] / (1 << (most - 2)))
    n = np.ceil(np.log2(np.bincount(owner, c, len(counts))[owner] / c) - 1e-9).clip(1, most).astype(np.int64)
    order = np.lexsort((used, -c, owner))
    n = n[order]
    left = (1 << most) - np.bincount(owner, 1 << (most - n), len(counts)).astype(np.int64)
    left[many < 2] = 0
    first = np.cumsum(many) - many
    while (open_ := np.flatnonzero(left)).size:
        for rank in range(int(many[open_].max())):
            here = open_[many[open_] > rank]
            at = first[here] + rank
            step = np.left_shift(1, most - n[at])
            ok = (step <= left[here]) & (n[at] > 1)
            n[at[ok]] -= 1
            left[here[ok]] -= step[ok]
            if rank & 15 == 15:
                open_ = open_[left[open_] > 0]
                if not len(open_):
                    break
    out = np.zeros(len(flat), np.int64)
    out[used[order]] = n
    return np.split(out, ends[:-1])


def code_words(lengths: list[np.ndarray]) -> list[np.ndarray]:
    """The canonical code of each symbol, its first bit lowest. Codes of one symbol have no bits."""
    flat = np.concatenate(lengths)
    ends = np.cumsum([len(c) for c in lengths])
    used = np.flatnonzero(flat)
    owner = np.searchsorted(ends, used, "right")
    order = np.lexsort((used, flat[used], owner))
    share = 1 << (15 - flat[used[order]])
    before = np.cumsum(share) - share
    many = np.bincount(owner, minlength=len(lengths))
    first = np.cumsum(many) - many
    start = before[np.minimum(first, max(0, len(before) - 1))] if len(before) else first
    out = np.zeros(len(flat), np.uint64)
    out[used[order]] = mirrored(15)[before - start[owner]]
    return np.split(out, ends[:-1])


def bits_of(lengths: np.ndarray) -> np.ndarray:
    """Bits that each symbol takes: none in codes of one symbol."""
    return (lengths if np.count_nonzero(lengths) > 1 else np.zeros_like(lengths)).astype(np.uint64)


def code_heads(lengths: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Values and their numbers of bits that tell of each code: a simple one where it has one small symbol, else all lengths, zeros in runs."""
    used = [np.flatnonzero(x) for x in lengths]
    out: list = [None] * len(lengths)
    normal = []
    for i, u in enumerate(used):
        if len(u) < 2 and (not len(u) or u[0] < 256):
            one = int(u[0]) if len(u) else 0
            out[i] = np.array([1 | int(one > 1) << 2 | one << 3], np.uint64), np.array([11 if one > 1 else 4], np.uint64)
        else:
            normal.append(i)
    if not normal:
        return out
    # Items: zeros before a symbol and its length, and at each code's end zeros alone.
    many = np.array([len(used[i]) + 1 for i in normal])
    owner = np.repeat(np.arange(len(normal)), many)
    last = np.cumsum(many - 1)  # after each code's symbols
    place = np.insert(np.concatenate([used[i] for i in normal]), last, [len(lengths[i]) for i in normal])
    size = np.insert(np.concatenate([lengths[i][used[i]] for i in normal]), last, 0)
    gap = np.diff(place, prepend=-1) - 1
    first = np.cumsum(many) - many
    gap[first] = place[first]
    full, rest = gap // 138, gap % 138
    short = np.where(rest < 3, rest, 1)
    count = full + short + (size > 0)
    item = np.repeat(np.arange(len(gap)), count)
    k = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    r = rest[item]
    in_full, in_rest = k < full[item], k < (full + short)[item]
    symbol = np.where(in_full, 18, np.where(in_rest, np.where(r < 3, 0, np.where(r < 11, 17, 18)), size[item]))
    further = np.where(in_full, 127, np.where(in_rest & (r >= 3), r - np.where(r < 11, 3, 11), 0))
    more = np.where(in_full | (in_rest & (r >= 11)), 7, np.where(in_rest & (r >= 3), 3, 0))
    told = owner[item]
    counts = np.bincount(told * 19 + symbol, minlength=19 * len(normal)).reshape(-1, 19)
    own = code_lengths(list(counts), 7)
    word = np.concatenate(code_words(own))
    bits = np.concatenate([bits_of(x) for x in own])
    code = told * 19 + symbol
    value = word[code] | further.astype(np.uint64) << bits[code]
    number = bits[code] + more.astype(np.uint64)
    table = np.stack(own)[:, LENGTH_ORDER].astype(np.uint64)
    n = np.maximum(4, 19 - np.argmax(table[:, ::-1] > 0, axis=1)).astype(np.uint64)
    head = (n - np.uint64(4)) << np.uint64(1) | (table << (np.uint64(5) + np.uint64(3) * np.arange(19, dtype=np.uint64))).sum(axis=1)
    starts = np.searchsorted(told, np.arange(len(normal)))
    value, number = np.insert(value, starts, head), np.insert(number, starts, 6 + 3 * n)
    ends = [*(starts + np.arange(len(normal))).tolist(), len(value)]
    for i, a, b in zip(normal, ends, ends[1:]):
        out[i] = value[a:b], number[a:b]
    return out


def packed(parts: list[list[tuple[np.ndarray, np.ndarray]]]) -> list[bytes]:
    """The bits of each list of parts (values, their numbers of bits, lowest first) as bytes."""
    value, n = (np.concatenate([x[k] for one in parts for x in one]).astype(np.uint64) for k in (0, 1))
    sizes = [sum(len(x[0]) for x in one) for one in parts]
    owner = np.repeat(np.arange(len(parts)), sizes)
    total = np.bincount(owner, n, len(parts)).astype(np.int64)
    words = (total >> 6) + 2  # every list starts with a word of its own
    first = np.cumsum(words) - words
    keep = n > 0
    value, n, owner = value[keep], n[keep], owner[keep]
    at = (np.cumsum(n) - n).astype(np.int64)
    at += (first * 64 - (np.cumsum(total) - total))[owner]
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    out = np.zeros(int(words.sum()), np.uint64)
    new = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out[word[new]] |= np.bitwise_or.reduceat(value << shift, new)
    over = np.where(shift > 0, value >> ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    out[word[new] + 1] |= np.bitwise_or.reduceat(over, new)
    raw = out.tobytes()
    return [raw[8 * a : 8 * a + (m + 7 >> 3)] for a, m in zip(first.tolist(), total.tolist())]


def prefixed(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix symbol, further bits and their number of values from 1."""
    x = value.astype(np.int64) - 1
    high = np.frexp(np.maximum(x, 1).astype(float))[1] - 1
    few = x < 4
    more = np.where(few, 0, high - 1)
    return np.where(few, x, 2 * high + ((x >> np.maximum(high - 1, 0)) & 1)), np.where(few, 0, x & ((1 << more) - 1)), more


@lru_cache(64)
def near_codes(width: int) -> np.ndarray:
    """The near code of each distance up to that of the last, 0 where there is none."""
    near = near_distances(width)
    out = np.zeros(int(near.max()) + 1, np.int64)
    out[near[::-1]] = np.arange(len(near), 0, -1)
    return out


def repeats(p: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, distance) of disjoint runs of at least three pixels that were there before."""
    n = len(p)
    if n < 4:
        return []
    # Pairs of pixels by a hash of 32 bits, then in order; equal hashes are compared.
    key = (p[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (p[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    both = np.sort(key & np.uint64(0xFFFFFFFF00000000) | np.arange(n - 1, dtype=np.uint64))
    order = (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
    both >>= np.uint64(32)
    same = np.flatnonzero(both[1:] == both[:-1])
    here, there = order[same + 1], order[same]
    ok = (p[here] == p[there]) & (p[here + 1] == p[there + 1])
    gap = np.zeros(n, np.int64)
    gap[here[ok]] = here[ok] - there[ok]
    gap[gap > 1_000_000] = 0
    edge = np.flatnonzero(np.diff(gap)) + 1
    first = np.concatenate([np.zeros(1, np.int64), edge])
    past_end = np.concatenate([edge, np.array([n])])
    some = np.flatnonzero((gap[first] > 0) & (past_end - first > 1))
    out, past = [], 0
    for a, b, d in zip(first[some].tolist(), past_end[some].tolist(), gap[first[some]].tolist()):
        a = max(a, past)
        length = b - a + 1
        if d and length >= 3 and a < b:
            past = a + length
            while length >= 3:
                m = min(length, 4096)
                out.append((a, m, d))
                a, length = a + m, length - m
            past -= length
    return out


def cached(p: np.ndarray, cache: int) -> tuple[np.ndarray, np.ndarray]:
    """Each pixel's place in a colour cache, and whether it is there when its turn comes."""
    place = (p.astype(np.uint64) * np.uint64(MULTIPLIER) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - cache)
    both = np.sort(place << np.uint64(32) | np.arange(len(p), dtype=np.uint64))  # by place, then in order
    order = (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
    both >>= np.uint64(32)
    q = p[order]
    hit = np.zeros(len(p), bool)
    hit[order[1:]] = (both[1:] == both[:-1]) & (q[1:] == q[:-1])
    return place.astype(np.int64), hit


#: x log2 x of small counts.
SMALL = 1 << 14
XLOG = np.arange(SMALL) * np.log2(np.maximum(np.arange(SMALL), 1))


def information(count: np.ndarray) -> float:
    """Bits that an ideal prefix code takes for symbols with these counts."""
    total = int(count.sum())
    if total < SMALL:
        return float(XLOG[total] - XLOG[count].sum())
    c = count[count > 0].astype(float)
    return float(total * np.log2(total) - (c * np.log2(c)).sum())


def informations(counts: np.ndarray) -> float:
    """Bits that ideal prefix codes take together, one for each row of counts."""
    total = counts.sum(axis=1)
    if total.max() < SMALL:
        return float(XLOG.take(total).sum() - XLOG.take(counts).sum())
    return sum(map(information, counts))


class Image:
    """Tokens of an image of (n, 4) samples A, R, G, B with one group of codes, and the counts of their symbols."""

    def __init__(self, pixels: np.ndarray, width: int, main: bool, each: float | None = None):
        """each: bits that a pixel takes without a cache, if known."""
        self.n = n = len(pixels)
        self.pixels = pixels
        p = np.ascontiguousarray(pixels).view(">u4").reshape(n).astype(np.uint32)
        self.runs = repeats(p)
        free = np.ones(n + 1, bool)
        if self.runs:
            self.at, length, gap = (np.array(x, np.int64) for x in zip(*self.runs))
            edge = np.zeros(n + 1, np.int8)
            edge[self.at] += 1
            np.subtract.at(edge, self.at + length, 1)
            free = np.cumsum(edge, dtype=np.int8) == 0
        self.lit = lit = np.flatnonzero(free[:n])
        self.cache, place, hit = 0, None, None
        if len(lit) > 32:
            bits = min(10, max(2, len(lit).bit_length() - 1))
            place, hit = cached(p, bits)
            hit = hit[lit]
            found = lit[hit]
            if len(found):
                if each is None:
                    each = samples_bits(pixels) / n
                met = np.bincount(place[found])
                told = information(met) + information(np.array([len(found), len(lit) - len(found)])) + 8 * np.count_nonzero(met)
                if each * len(found) > told:
                    self.cache = bits
        self.green = pixels[lit, 2].astype(np.int64)
        self.plain = lit
        if self.cache:
            self.green[hit] = 280 + place[lit[hit]]
            self.plain = lit[~hit]
        self.counts = [np.bincount(self.green, minlength=280 + (1 << self.cache if self.cache else 0)), *(np.bincount(pixels[self.plain, k], minlength=256) for k in (1, 3, 0)), np.zeros(40, np.int64)]
        kinds = np.stack(self.counts[1:4])
        every = kinds.sum(axis=0)
        # One code for red, blue and alpha where the bits lost on symbols are fewer than those of the codes' lengths, about four for each symbol.
        if information(every) - informations(kinds) < 4 * (np.count_nonzero(kinds) - np.count_nonzero(every)):
            self.counts[1:4] = [every] * 3
        if self.runs:
            self.lengths = prefixed(length)
            code = gap + 120
            near = near_codes(width)
            close = gap < len(near)
            code[close] = np.where(near[gap[close]] > 0, near[gap[close]], code[close])
            self.gaps = prefixed(code)
            self.counts[0] += np.bincount(self.lengths[0] + 256, minlength=len(self.counts[0]))
            self.counts[4] += np.bincount(self.gaps[0], minlength=40)
        head = int(self.cache > 0) | (self.cache << 1 if self.cache else 0)
        self.head = np.array([head], np.uint64), np.array([(5 if self.cache else 1) + main], np.uint64)

    def body(self, words: list[np.ndarray], lengths: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """A value for each token, and its number of bits."""
        sizes = [bits_of(x) for x in lengths]
        value, many = np.zeros(self.n, np.uint64), np.zeros(self.n, np.uint64)

        def add(at, more, bits):
            value[at] |= more.astype(np.uint64) << many[at]
            many[at] += bits.astype(np.uint64)

        add(self.lit, words[0][self.green], sizes[0][self.green])
        for i, k in ((1, 1), (2, 3), (3, 0)):
            if sizes[i].any():
                x = self.pixels[self.plain, k]
                add(self.plain, words[i][x], sizes[i][x])
        if self.runs:
            (symbol, further, more), (dsymbol, dfurther, dmore) = self.lengths, self.gaps
            add(self.at, words[0][symbol + 256], sizes[0][symbol + 256])
            add(self.at, further, more)
            add(self.at, words[4][dsymbol], sizes[4][dsymbol])
            add(self.at, dfurther, dmore)
        return value, many


def samples_bits(pixels: np.ndarray) -> float:
    return informations(np.stack([np.bincount(pixels[:, k], minlength=256) for k in range(4)]))


#: Predictor modes that the writer tries: the pixel to the left, above, above to the right, above to the left.
TRIED = (1, 2, 3, 4)
TILE = 3


def smooth(x: np.ndarray) -> bool:
    """Whether samples differ from those above or to the left by much less than from their mean."""
    far = np.abs(x - x.mean(axis=(0, 1), dtype=np.float32)).mean()
    signed = lambda a, b: np.abs((a - b).view(np.int8).astype(np.int16)).mean()
    return min(signed(x[1:], x[:-1]), signed(x[:, 1:], x[:, :-1])) < 0.6 * far + 0.5


def predicted(pixels: np.ndarray, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray] | None:
    """The mode of each tile and what is left of the pixels, if any tile gains by another mode than 0.

    The estimate takes a sample's information, or for a predicted one a bit if it is met and seven if not.
    """
    h, w = shape
    x = pixels.reshape(h, w, 4)
    if h < 2 or not smooth(x):
        return None
    above = x[:-1]
    edge = x[1:, :1]
    guesses = {
        1: np.concatenate([above[:, :1], x[1:, :-1]], axis=1), 2: above,
        3: np.concatenate([above[:, 1:], edge], axis=1), 4: np.concatenate([above[:, :1], above[:, :-1]], axis=1),
    }
    rows, cols = np.arange(0, h - 1, 1 << TILE), np.arange(0, w, 1 << TILE)
    if h > (1 << TILE):
        rows = np.r_[0, np.arange((1 << TILE) - 1, h - 1, 1 << TILE)]  # a tile's first row may be the image's, which has no mode
    tiles = lambda z: np.add.reduceat(np.add.reduceat(z.reshape(h - 1, 4 * w), 4 * cols, axis=1, dtype=np.int64), rows, axis=0)
    area = 4 * np.outer(np.diff(np.r_[rows, h - 1]), np.diff(np.r_[cols, w]))
    met = {m: tiles(x[1:] == guesses[m]) for m in TRIED}
    if max((v / area).max() for v in met.values()) < 0.3:
        return None
    info = np.empty((h - 1, w, 4), np.float32)
    for k in range(4):
        c = np.bincount(pixels[:, k], minlength=256)
        info[..., k] = (-np.log2(np.maximum(c, 1) / len(pixels)))[x[1:, :, k]]
    best = np.add.reduceat(np.add.reduceat(info.reshape(h - 1, 4 * w), 4 * cols, axis=1), rows, axis=0)
    mode, plain = np.zeros(best.shape, np.uint8), best.sum()
    for m in TRIED:
        cost = 7 * area - 6 * met[m]
        mode[cost < best] = m
        best = np.minimum(best, cost)
    if plain - best.sum() < 100 + mode.size:
        return None
    out = x.copy()
    out[1:, 1:] -= np.array([255, 0, 0, 0], np.uint8)
    full = mode[(np.arange(1, h) >> TILE)[:, None], np.arange(w) >> TILE]
    for m in TRIED:
        here = full == m
        out[1:][here] = x[1:][here] - guesses[m][here]
    out[1:, 0] = x[1:, 0] - above[:, 0]
    out[0, 1:] = x[0, 1:] - x[0, :-1]
    out[0, 0] = x[0, 0] - np.array([255, 0, 0, 0], np.uint8)
    return mode, out.reshape(-1, 4)


#: Multipliers, in 32nds, that the writer tries for red by green, blue by green, and blue by red.
FACTORS = (16, 32)


def crossed(pixels: np.ndarray) -> tuple[tuple[int, int, int], np.ndarray] | None:
    """Multipliers that predict colours from each other in all of the image, and what is left, where that saves bits."""
    signed = pixels.view(np.int8).astype(np.int32)
    spread = (signed - signed.mean(axis=0)).astype(np.float32)
    norm = np.sqrt((spread**2).sum(axis=0))
    if max(abs(float(spread[:, a] @ spread[:, b])) - 0.5 * float(norm[a] * norm[b]) for a, b in ((1, 2), (3, 2), (3, 1))) <= 0:
        return None  # no two colours go together
    found, gain, out = [0, 0, 0], 0.0, pixels.copy()
    for i, (target, by) in enumerate(((1, 2), (3, 2), (3, 1))):
        now = information(np.bincount(out[:, target], minlength=256))
        for f in FACTORS:
            left = ((out[:, target] - (f * signed[:, by] >> 5)) & 255).astype(np.uint8)
            bits = information(np.bincount(left, minlength=256))
            if bits < now - 1:
                gain, now, found[i], best = gain + now - bits, bits, f, left
        if found[i]:
            out[:, target] = best
    return (tuple(found), out) if gain > 120 else None


def parts_of(samples: np.ndarray) -> list:
    """The bits and images that make up the stream of (height, width, 4) RGBA samples, by estimates of their entropy."""
    h, w, _ = samples.shape
    if not 0 < h <= MOST or not 0 < w <= MOST:
        raise ValueError("an image has 1 to 16384 columns and rows")
    pixels = np.ascontiguousarray(samples.reshape(-1, 4)[:, [3, 0, 1, 2]])
    out: list = [(0x2F | (w - 1) << 8 | (h - 1) << 22 | 1 << 36, 40)]
    plain = samples_bits(pixels)
    colours = pixels.view(">u4").reshape(-1).astype(np.uint32)
    wide = w
    ordered = np.sort(colours)
    new = ordered[1:] != ordered[:-1]
    if np.count_nonzero(new) < 256:
        shades = np.concatenate([ordered[:1], ordered[1:][new]])
        index = np.searchsorted(shades, colours)
        palette = np.diff(np.ascontiguousarray(shades.astype(">u4")).view(np.uint8).reshape(-1, 4), axis=0, prepend=np.zeros((1, 4), np.uint8))
        if information(np.bincount(index)) + samples_bits(palette) < plain:
            pack = 3 if len(shades) <= 2 else 2 if len(shades) <= 4 else 1 if len(shades) <= 16 else 0
            wide = -(-w >> pack)
            bundle = np.zeros((h, wide << pack), np.int64)
            bundle[:, :w] = index.reshape(h, w)
            bundle = (bundle.reshape(h, wide, 1 << pack) << (np.arange(1 << pack) * (8 >> pack))).sum(axis=2)
            pixels = np.zeros((h * wide, 4), np.uint8)
            pixels[:, 0], pixels[:, 2] = 255, bundle.reshape(-1)
            return [*out, (1 | 3 << 1 | (len(shades) - 1) << 3, 11), Image(palette, len(shades), False), (0, 1), Image(pixels, wide, True)]
    # Samples with as much information as letters gain nothing by predictions.
    letters = 3.5 < plain / len(pixels) / 4 < 5.2
    told = None if letters else predicted(pixels, (h, w))
    if told is not None and (bits := samples_bits(told[1])) < plain:
        mode, pixels, plain = told[0], told[1], bits
        image = np.zeros((mode.size, 4), np.uint8)
        image[:, 0], image[:, 2] = 255, mode.reshape(-1)
        out += [(1 | (TILE - 2) << 3, 6), Image(image, mode.shape[1], False)]
    if letters:
        return [*out, (0, 1), Image(pixels, wide, True, plain / len(pixels))]
    bare = pixels.copy()
    bare[:, [1, 3]] -= bare[:, 2:3]
    less = samples_bits(bare)
    across = crossed(pixels)
    if across is not None and samples_bits(across[1]) < min(plain, less):
        (by_green, blue_green, blue_red), pixels = across
        element = np.array([255, blue_red, blue_green, by_green], np.int64).astype(np.uint8)
        out += [(1 | 1 << 1 | 7 << 3, 6), Image(np.tile(element, (-(-w // 512) * -(-h // 512), 1)), -(-w // 512), False)]
    elif less < 0.99 * plain:
        pixels = bare
        out.append((1 | 2 << 1, 3))
    return [*out, (0, 1), Image(pixels, wide, True)]


def encode_all(images: list[np.ndarray]) -> list[bytes]:
    """Lossless WebP files of (height, width, 4) RGBA samples; the prefix codes of all are built side by side."""
    if not images:
        return []
    plans = [parts_of(x) for x in images]
    inner = [x for plan in plans for x in plan if isinstance(x, Image)]
    counts = [c for x in inner for c in x.counts]
    distinct = {id(c): c for c in counts}  # an image may use one code for several colours
    number = {k: i for i, k in enumerate(distinct)}
    of_code = [number[id(c)] for c in counts]
    lengths = code_lengths(list(distinct.values()))
    words, heads = code_words(lengths), code_heads(lengths)
    lengths, words, heads = ([x[i] for i in of_code] for x in (lengths, words, heads))
    told = {id(x): [x.head, *heads[5 * i : 5 * i + 5], x.body(words[5 * i : 5 * i + 5], lengths[5 * i : 5 * i + 5])] for i, x in enumerate(inner)}
    parts = [[y for x in plan for y in (told[id(x)] if isinstance(x, Image) else [(np.array(x[:1], np.uint64), np.array(x[1:], np.uint64))])] for plan in plans]
    out = []
    for body in packed(parts):
        odd = len(body) & 1
        out.append(b"RIFF" + struct.pack("<I", 12 + len(body) + odd) + b"WEBPVP8L" + struct.pack("<I", len(body)) + body + b"\0" * odd)
    return out


def encode(samples: np.ndarray) -> bytes:
    """A lossless WebP file of (height, width, 4) RGBA samples."""
    return encode_all([samples])[0]
