"""The lossless decoder on streams with every feature, written by a plain bit writer."""

import hashlib
import struct
import zlib

import numpy as np
import pytest

from lockstep.llm import media, webp

rng = np.random.default_rng(0)


class Writer:
    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> k & 1 for k in range(n)]

    def file(self):
        bits = self.bits + [0] * (-len(self.bits) % 8)
        body = b"\x2f" + np.packbits(np.array(bits, np.uint8), bitorder="little").tobytes()
        return b"RIFF" + struct.pack("<I", 12 + len(body)) + b"WEBPVP8L" + struct.pack("<I", len(body)) + body


def header(w, width, height):
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(1, 1)
    w.put(0, 3)


def lengths_for(symbols, size):
    """A complete code over the symbols: lengths as equal as they get."""
    s = sorted(set(symbols)) or [0]
    if len(s) == 1:
        return {s[0]: 1}
    n = (len(s) - 1).bit_length()
    short = (1 << n) - len(s)
    return {x: n - 1 if i < short else n for i, x in enumerate(s)}


def canonical(lengths):
    codes, code, last = {}, 0, 0
    for n, s in sorted((n, s) for s, n in lengths.items()):
        code <<= n - last
        codes[s] = (code, n)
        code, last = code + 1, n
    return codes


def write_code(w, lengths, size, simple):
    if simple and len(lengths) <= 2 and max(lengths) < 256:
        s = sorted(lengths)
        w.put(1, 1)
        w.put(len(s) - 1, 1)
        w.put(1, 1)
        w.put(s[0], 8)
        if len(s) == 2:
            w.put(s[1], 8)
        return {s[0]: (0, 0)} if len(s) == 1 else {s[0]: (0, 1), s[1]: (1, 1)}
    w.put(0, 1)
    w.put(15, 4)  # all 19 code length codes
    out, i, items = [], 0, []
    while i < size:
        n, run = lengths.get(i, 0), 1
        while i + run < size and lengths.get(i + run, 0) == n:
            run += 1
        if n == 0 and run >= 11:
            run = min(run, 138)
            items.append((18, run - 11, 7))
        elif n == 0 and run >= 3:
            items.append((17, run - 3, 3))
        elif n and run >= 4:
            run = min(run, 7)
            items += [(n, 0, 0), (16, run - 4, 2)]
        else:
            run = 1
            items.append((n, 0, 0))
        i += run
    own = lengths_for([x for x, _, _ in items] + [0, 1], 19)
    for s in webp.LENGTH_ORDER:
        w.put(own.get(s, 0), 3)
    w.put(0, 1)
    codes = canonical(own)
    for s, extra, n in items:
        c, k = codes[s]
        for b in range(k - 1, -1, -1):
            w.put(c >> b & 1, 1)
        w.put(extra, n)
    return {s: (0, 0) for s in lengths} if len(lengths) == 1 else canonical(lengths)


def prefix(value):
    """(symbol, extra bits, their number) of a length or distance."""
    if value <= 4:
        return value - 1, 0, 0
    v = value - 1
    high = v.bit_length() - 1
    second = v >> (high - 1) & 1
    return 2 * high + second, v & ((1 << (high - 1)) - 1), high - 1


def write_image(w, pixels, width, main, cache=0, meta=None, tile=0, references=True, simple=True):
    """pixels: ARGB ints. Finds runs that repeat the pixel before or the row above, and uses the cache."""
    if cache:
        w.put(1, 1)
        w.put(cache, 4)
    else:
        w.put(0, 1)
    groups = 1
    if main:
        if meta is None:
            w.put(0, 1)
        else:
            w.put(1, 1)
            w.put(tile - 2, 3)
            mw = -(-width >> tile)
            write_image(w, [int(m) << 8 for m in meta], mw, False)
            groups = max(meta) + 1
    group_of = lambda i: 0 if meta is None else meta[((i // width) >> tile) * (-(-width >> tile)) + ((i % width) >> tile)]
    tokens, i, colours = [], 0, {}
    key = lambda p: (0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache)
    while i < len(pixels):
        best = 0
        for code, back in ((2, 1), (1, width), (121 + 4, 5)) if references else ():
            n = 0
            while back <= i and i + n < len(pixels) and pixels[i + n] == pixels[i + n - back]:
                n += 1
            if n > max(2, best):
                best, at = n, code
        if best:
            tokens.append((i, "ref", best, at))
            step = best
        elif cache and colours.get(key(pixels[i])) == pixels[i]:
            tokens.append((i, "cache", key(pixels[i]), 0))
            step = 1
        else:
            tokens.append((i, "pixel", pixels[i], 0))
            step = 1
        if cache:
            for p in pixels[i : i + step]:
                colours[key(p)] = p
        i += step
    used = [[[], [], [], [], []] for _ in range(groups)]
    for i, kind, x, d in tokens:
        u = used[group_of(i)]
        if kind == "pixel":
            for k, shift in enumerate((8, 16, 0, 24)):
                u[k].append(x >> shift & 255)
        elif kind == "ref":
            u[0].append(256 + prefix(x)[0])
            u[4].append(prefix(d)[0])
        else:
            u[0].append(280 + x)
    sizes = (280 + (1 << cache if cache else 0), 256, 256, 256, 40)
    codes = [[write_code(w, lengths_for(s, n), n, simple) for s, n in zip(u, sizes)] for u in used]

    def emit(code, s):
        c, n = code[s]
        for b in range(n - 1, -1, -1):
            w.put(c >> b & 1, 1)

    for i, kind, x, d in tokens:
        c = codes[group_of(i)]
        if kind == "pixel":
            for k, shift in enumerate((8, 16, 0, 24)):
                emit(c[k], x >> shift & 255)
        elif kind == "ref":
            s, extra, n = prefix(x)
            emit(c[0], 256 + s)
            w.put(extra, n)
            s, extra, n = prefix(d)
            emit(c[4], s)
            w.put(extra, n)
        else:
            emit(c[0], 280 + x)


def argb(samples):
    s = samples.reshape(-1, 4).astype(int)
    return (s[:, 3] << 24 | s[:, 0] << 16 | s[:, 1] << 8 | s[:, 2]).tolist()


def picture(h, w, colours=30):
    base = rng.integers(0, 256, (colours, 4), dtype=np.uint8)
    out = base[rng.integers(0, colours, (h, w))]
    out[h // 2 :] = out[: h - h // 2]
    out[:, : w // 3] = out[:, :1]
    return out


@pytest.mark.parametrize("cache", [0, 1, 5, 11])
@pytest.mark.parametrize("simple", [True, False])
def test_references_and_cache(cache, simple):
    x = picture(9, 17)
    w = Writer()
    header(w, 17, 9)
    w.put(0, 1)
    write_image(w, argb(x), 17, True, cache, simple=simple)
    assert (webp.decode(w.file()) == x).all()


def test_groups():
    x = picture(12, 10)
    meta = rng.integers(0, 3, 9).tolist()
    meta[0] = 2
    w = Writer()
    header(w, 10, 12)
    w.put(0, 1)
    write_image(w, argb(x), 10, True, 4, meta, 2)
    assert (webp.decode(w.file()) == x).all()


def forward_predict(x, modes, tile):
    """Differences to the predictions, on ARGB ints, one by one as the format's text puts it."""
    h, w, _ = x.shape
    s = x[..., [3, 0, 1, 2]].astype(int)
    avg = lambda a, b: [(p + q) // 2 for p, q in zip(a, b)]
    out = np.empty_like(s)
    for y in range(h):
        for c in range(w):
            left = s[y, c - 1].tolist() if c else None
            top = s[y - 1, c].tolist() if y else None
            if y == 0:
                p = left or [255, 0, 0, 0]
            elif c == 0:
                p = top
            else:
                tl = s[y - 1, c - 1].tolist()
                tr = s[y - 1, c + 1].tolist() if c + 1 < w else s[y, 0].tolist()
                m = modes[y >> tile][c >> tile]
                clamp = lambda v: min(255, max(0, v))
                if m == 11:
                    dl = sum(abs((a + b - d) - a) for a, b, d in zip(left, top, tl))
                    dt = sum(abs((a + b - d) - b) for a, b, d in zip(left, top, tl))
                    p = left if dl < dt else top
                elif m == 12:
                    p = [clamp(a + b - d) for a, b, d in zip(left, top, tl)]
                elif m == 13:
                    a = avg(left, top)
                    p = [clamp(q + int((q - d) / 2)) for q, d in zip(a, tl)]
                else:
                    p = {0: [255, 0, 0, 0], 1: left, 2: top, 3: tr, 4: tl, 5: avg(avg(left, tr), top), 6: avg(left, tl), 7: avg(left, top), 8: avg(tl, top), 9: avg(top, tr), 10: avg(avg(left, tl), avg(top, tr))}[m]
            out[y, c] = (s[y, c] - p) & 255
    return out[..., [1, 2, 3, 0]].astype(np.uint8)


def test_predictor_modes():
    x = rng.integers(0, 256, (23, 21, 4), dtype=np.uint8)
    x[5:15] = np.cumsum(rng.integers(-2, 3, (10, 21, 4)), axis=1) + 128
    th, tw = -(-23 >> 2), -(-21 >> 2)
    modes = np.resize(np.arange(14), (th, tw)).tolist()
    w = Writer()
    header(w, 21, 23)
    w.put(1, 1)
    w.put(0, 2)
    w.put(0, 3)
    write_image(w, [m << 8 for row in modes for m in row], tw, False)
    w.put(0, 1)
    write_image(w, argb(forward_predict(x, modes, 2)), 21, True)
    assert (webp.decode(w.file()) == x).all()


def test_cross_colour_and_subtract_green():
    x = rng.integers(0, 256, (9, 11, 4), dtype=np.uint8)
    tile, th, tw = 2, 3, 3
    e = rng.integers(0, 256, (th, tw, 3))  # green to red, green to blue, red to blue
    s8 = lambda v: (int(v) & 255 ^ 128) - 128
    y = x.astype(int).copy()
    y[..., 0] = (y[..., 0] - y[..., 1]) & 255
    y[..., 2] = (y[..., 2] - y[..., 1]) & 255
    z = y.copy()
    for r in range(9):
        for c in range(11):
            gr, gb, rb = (s8(v) for v in e[r >> tile, c >> tile])
            red, green = int(y[r, c, 0]), s8(y[r, c, 1])
            z[r, c, 0] = (red - (gr * green >> 5)) & 255
            z[r, c, 2] = (y[r, c, 2] - (gb * green >> 5) - (rb * s8(red) >> 5)) & 255
    w = Writer()
    header(w, 11, 9)
    w.put(1, 1)
    w.put(2, 2)
    w.put(1, 1)
    w.put(1, 2)
    w.put(0, 3)
    write_image(w, [255 << 24 | int(rb) << 16 | int(gb) << 8 | int(gr) for gr, gb, rb in e.reshape(-1, 3)], tw, False)
    w.put(0, 1)
    write_image(w, argb(z.astype(np.uint8)), 11, True)
    assert (webp.decode(w.file()) == x).all()


@pytest.mark.parametrize("n, pack", [(2, 3), (4, 2), (16, 1), (40, 0)])
def test_palettes(n, pack):
    palette = rng.integers(0, 256, (n, 4), dtype=np.uint8)
    index = rng.integers(0, n, (7, 13))
    index[0, 0] = n - 1
    deltas = np.diff(palette.astype(int), axis=0, prepend=0) & 255
    w = Writer()
    header(w, 13, 7)
    w.put(1, 1)
    w.put(3, 2)
    w.put(n - 1, 8)
    write_image(w, argb(deltas.astype(np.uint8)), n, False)
    w.put(0, 1)
    wide, bits = -(-13 >> pack), 8 >> pack
    packed = []
    for row in index:
        for c in range(wide):
            packed.append(sum(int(v) << (k * bits) for k, v in enumerate(row[c << pack : (c + 1) << pack])) << 8)
    write_image(w, packed, wide, True)
    assert (webp.decode(w.file()) == palette[index]).all()


def one_at_a_time(bits, codes, n, width):
    """Tokens read by single codes."""
    out, done = [], 0
    while done < n:
        symbol = codes[0].read(bits)
        if symbol < 256:
            r = codes[1].read(bits)
            b = codes[2].read(bits)
            out.append((0, codes[3].read(bits) << 24 | r << 16 | symbol << 8 | b, 1))
        elif symbol < 280:
            length = webp.extended(bits, symbol - 256)
            code = webp.extended(bits, codes[4].read(bits))
            out.append((1, code - 120 if code > 120 else max(1, webp.NEAR[code - 1][0] + webp.NEAR[code - 1][1] * width), length))
        else:
            out.append((2, symbol - 280, 1))
        done += out[-1][2]
    return tuple(np.array(x, np.int64) for x in zip(*out))


def kinds_of_image():
    """Images that call for each of the writer's tools."""
    y, x = np.mgrid[0:40, 0:144]
    smooth = np.stack([x + y, 2 * x + y, x, 255 + 0 * x], axis=2).astype(np.uint8)
    noise = rng.integers(0, 126, (40, 144), dtype=np.uint8)
    fine = rng.integers(0, 3, (40, 144), dtype=np.uint8)
    return {
        "noise": rng.integers(0, 256, (5, 144, 4), dtype=np.uint8),
        "text": media.samples_of(b"".join(b"the cat number %d sat on mat %d. " % (i % 7, i * i) for i in range(300))),
        "rows": np.repeat(rng.integers(0, 256, (3, 144, 4), dtype=np.uint8), 12, axis=0),
        "smooth": smooth,
        "together": np.stack([noise + fine, noise, noise + 1, 255 + 0 * noise], axis=2).astype(np.uint8),
        "apart": np.stack([noise // 2 + fine, noise, rng.integers(0, 256, noise.shape), 255 + 0 * noise], axis=2).astype(np.uint8),
        **{f"colours {k}": rng.integers(0, 256, (k, 4), dtype=np.uint8)[rng.integers(0, k, (40, 144))] for k in (2, 4, 16, 200)},
        "one": np.full((3, 144, 4), 7, np.uint8),
    }


def tools(stored):
    """The transforms of a stored image, and whether it has a cache."""
    bits = webp.Bits(stored, 160)
    bits.read(8)
    w, h = bits.read(14) + 1, bits.read(14) + 1
    bits.read(4)
    out = set()
    while bits.read(1):
        kind = bits.read(2)
        out.add(("predictor", "cross-colour", "green", "palette")[kind])
        if kind == 3:
            webp.read_image(bits, bits.read(8) + 1, 1, False)
        elif kind != 2:
            tile = bits.read(3) + 2
            webp.read_image(bits, -(-w >> tile), -(-h >> tile), False)
    return out | ({"cache"} if bits.read(1) else set())


def test_windows_and_single_codes_agree(monkeypatch):
    images = kinds_of_image()
    stored = webp.encode_all(list(images.values()))
    for k, (name, x) in enumerate(images.items()):
        assert stored[k] == webp.encode(x), name
        assert (webp.decode(stored[k]) == x).all(), name
    monkeypatch.setattr(webp, "WINDOW", 64)
    for x, s in zip(images.values(), stored):
        assert (webp.decode(s) == x).all()
    monkeypatch.setattr(webp, "tokens", one_at_a_time)
    for x, s in zip(images.values(), stored):
        assert (webp.decode(s) == x).all()


def test_the_writer_picks_tools_by_content():
    used = {name: tools(webp.encode(x)) for name, x in kinds_of_image().items()}
    assert used["noise"] == set() and "cache" in used["text"] and "predictor" in used["smooth"]
    assert "green" in used["together"] and "cross-colour" in used["apart"] and all("palette" in used[f"colours {k}"] for k in (2, 4, 16))
    assert len(webp.encode(kinds_of_image()["rows"])) < 3 * 144 * 4 + 700  # by references


def test_documents_take_fewer_bytes_than_their_texts(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    raw = [t.encode() for t in texts]
    stored = list(media.store_all(raw, limit=20000))
    assert stored == [media.store(x) for x in raw]
    for x, s in zip(raw, stored):
        assert webp.decode(s).tobytes()[: len(x)] == x
    seen = [tools(s) for s in stored]
    assert sum("cache" in x for x in seen) > len(seen) / 2 and any("palette" in x for x in seen)
    assert sum(map(len, stored)) < 0.7 * sum(map(len, raw))


def test_damage_is_told():
    with pytest.raises(ValueError):
        webp.decode(b"RIFF....WEBPVP8 ")
    with pytest.raises(ValueError):
        webp.decode(webp.encode(np.zeros((2, 2, 4), np.uint8))[:30])


@pytest.mark.parametrize("text", [b"", b"a", b"x" * 575, b"x" * 576, b"x" * 577, "é".encode() * 30000])
def test_round_trip(text):
    d = media.describe(media.store(text), len(text))
    payload = text + b"\xff" * (max(1, -(-len(text) // 576)) * 576 - len(text))
    assert d["payload_bytes"] == len(payload) and d["payload_sha256"] == hashlib.sha256(payload).hexdigest() and d["tail_crc32"] == zlib.crc32(payload[-32:])


def test_tall_texts_get_wide(monkeypatch):
    monkeypatch.setattr(media, "HIGH", 4)
    text = bytes(range(250)) * 30
    assert media.describe(media.store(text), len(text))["payload_sha256"] == hashlib.sha256(text + b"\xff" * (-len(text) % 576)).hexdigest()


def test_columns(spark):
    df = spark.createDataFrame([(1, "abc", 5), (None, None, 6), (2, "", 7), (2, "", 7)], "doc_id long, text string, n_bytes_ int")
    got = media.described(media.with_media(df)).collect()
    assert len(got) == 4 and {r.n_bytes for r in got} == {3, 0} and len({r.media_sha256 for r in got if not r.text}) == 1


def mixed_images():
    rng = np.random.default_rng(11)
    text = np.frombuffer(bytes(rng.choice(list(b"etaoin shrdlu, cmfwyp Gb.vkq"), 12000, p=np.arange(28, 0, -1) / 406).tolist()), np.uint8)
    out = [text[: 576 * k].reshape(k, 144, 4) for k in (1, 2, 3, 5, 12, 20)]
    out += [rng.integers(0, 256, (7, 9, 4), dtype=np.uint8), rng.integers(0, 40, (30, 50, 4), dtype=np.uint8), np.full((3, 5, 4), 9, np.uint8), np.tile(rng.integers(0, 256, (4, 16, 4), dtype=np.uint8), (6, 3, 1))]
    ramp = np.add.outer(np.arange(40), np.arange(60))[..., None] * np.array([1, 1, 1, 0]) + np.array([0, 3, 5, 255])
    return [*out, (ramp & 255).astype(np.uint8), np.zeros((1, 1, 4), np.uint8)]


@pytest.mark.parametrize("few", [1, 3, 1000])
def test_images_side_by_side(few, monkeypatch):
    images = mixed_images() * 2
    stored = webp.encode_all(images)
    side_by_side = webp.tokens_side_by_side
    monkeypatch.setattr(webp, "tokens_side_by_side", lambda asked: side_by_side(asked, few))
    for image, found, x in zip(images, webp.decode_all(stored), stored):
        assert (found == image).all() and (webp.decode(x) == image).all()
    assert webp.decode_all([]) == []


def test_one_code_serves_alike_colours_only(monkeypatch):
    met = []
    read = webp.read_codes
    monkeypatch.setattr(webp, "read_codes", lambda bits, cache: met.append(read(bits, cache)) or met[-1])
    text, palette = mixed_images()[5], mixed_images()[9]
    assert (webp.decode(webp.encode(text)) == text).all()
    assert met[-1][1] is met[-1][2] is met[-1][3]
    rng = np.random.default_rng(2)
    apart = np.stack([rng.integers(60 * k, 60 * k + 40, (60, 60)) for k in range(4)], axis=2).astype(np.uint8)
    assert (webp.decode(webp.encode(apart)) == apart).all()
    assert len({id(c) for c in met[-1][:4]}) == 4
    assert (webp.decode(webp.encode(palette)) == palette).all()


def test_cut_streams_side_by_side_are_told():
    stored = webp.encode_all([mixed_images()[5]] * 30)
    with pytest.raises(ValueError):
        webp.decode_all([x[: len(x) * 2 // 3] for x in stored])
