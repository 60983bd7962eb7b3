"""Removal of byte strings that also start in an earlier document, by threshold-bounded interval expansion.

Every window of ``least`` bytes has an anchor, its ``GRAM``-gram with the least hash. Windows are cut into segments:
runs with one anchor. Equal windows have equal anchors, so they meet in the same bucket:

1. Each task keeps, of equal segments, the one of the smallest document; the others are
   covered. Entries (hashes and places, no text) go to buckets by anchor, where the same is done for all documents.
2. A window reaches ``REACH`` bytes beyond its anchor on one side at least. Segments that remain, and share the anchor
   with that much of a side with another document, are candidates. They get their bytes by
   an equi-join with the texts and go to the pools of what they share.
3. A pool's segments get a Burrows-Wheeler transform. Backward extension, breadth first, turns the
   intervals of strings of length l into those of length l + 1, so common prefixes are
   found by increasing value; it looks only at places not yet cut apart and stops at
   ``least``. Each interval that is left is one repeated window: all its places but those in the smallest document are covered.
4. Covered spans are merged by document, and the remaining bytes hashed.

An anchor with a share of all entries beyond ``share`` and ``hot`` of them is found in a first pass (the list has at most ``1 / share``
anchors) and its segments are dealt window by window, by the window's own hash;
equal ones are pre-aggregated by step 1 in every task, so no bucket gathers a common passage's contexts.

Equality of segments in step 1 is that of 64 bits of hash and 32 of the anchor with its left side; all in step 3 is exact.

Nulls: a null text is empty; a document with a null id neither covers others nor is covered. Rows that repeat an id do not cover each
other. Texts under ``least`` bytes stay whole. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import require
from .common import U, cut, powers, prefix_sums, range_hash, slices, stir

GRAM = 16
FLUSH = 1 << 20  # entries that a task aggregates at a time
LOW = U(0xFFFFFFFF)
#: What an entry holds: hashes of the segment, of the anchor with its left and its right side, first window, number of windows,
#: and how many of them reach far enough to the left.
FIELDS = (("seg", "<u8"), ("left", "<u4"), ("right", "<u4"), ("start", "<u4"), ("windows", "<u2"), ("lefts", "<u1"))


def rolling(p: np.ndarray, n: int, k: int) -> np.ndarray:
    """Hashes of all k-grams of n bytes with prefix sums p."""
    _, down = powers(n + 1)
    return stir((p[k:] - p[:-k]) * down[: n - k + 1] + U(k))


def segments(data: np.ndarray, offs: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Text, first window, number of windows, anchor's place and hash of each segment, with the prefix sums; places are in data."""
    n = len(data)
    p = prefix_sums(data)
    if n < least:
        e = np.empty(0, np.int64)
        return e, e, e, e, np.empty(0, U), p
    h = rolling(p, n, GRAM)
    # The least of 32 bits of hash, the leftmost of equal ones: the same in every text that holds the window.
    m = (h & ~LOW) | np.arange(len(h), dtype=U)
    width, span = 1, least - GRAM + 1
    while width < span:
        step = min(width, span - width)
        m = np.minimum(m[:-step], m[step:])
        width += step
    place = (m & LOW).astype(np.int64)
    # m[i] belongs to the window at i; windows end within their text
    size = np.diff(offs)
    new = np.ones(len(m), bool)
    new[1:] = place[1:] != place[:-1]
    first = offs[:-1][size >= least]
    new[first] = True
    past = offs[1:][size >= least] - least + 1
    edge = np.zeros(len(m) + 1, np.int8)
    edge[first] += 1
    edge[past] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    new[past[past < len(m)]] = True
    at = np.flatnonzero(new)
    count = np.diff(np.r_[at, len(m)])
    keep = inside[at]
    at, count = at[keep], count[keep]
    return np.searchsorted(offs, at, "right") - 1, at, count, place[at], h[place[at]], p


def entries_of(data: np.ndarray, offs: np.ndarray, least: int, hot: np.ndarray):
    """Text, entry fields, and the hash that deals each entry."""
    text, at, count, place, anchor, p = segments(data, offs, least)
    reach = (least - GRAM + 1) // 2
    none = stir(place.astype(U) * U(0x9E3779B97F4A7C15) + U(data.size))  # meets nothing
    lo, hi = place - reach, place + GRAM + reach
    has = lo >= offs[text]
    left = np.where(has, range_hash(p, np.where(has, lo, 0), np.where(has, place + GRAM, 0)), none)
    has = hi <= offs[text + 1]
    right = np.where(has, range_hash(p, np.where(has, place, 0), np.where(has, hi, 0)), stir(none))
    deal = stir(anchor ^ U(0x5851F42D4C957F2D))
    lefts = np.clip(place - reach + 1 - at, 0, count)
    if len(hot) and len(anchor):
        is_hot = hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor
        if is_hot.any():
            n = count[is_hot]
            one = np.repeat(at[is_hot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own = range_hash(p, one, one + least)
            cool = ~is_hot
            text, at = np.r_[text[cool], np.repeat(text[is_hot], n)], np.r_[at[cool], one]
            count = np.r_[count[cool], np.ones(len(one), np.int64)]
            left, right = np.r_[left[cool], stir(own ^ U(1))], np.r_[right[cool], stir(one.astype(U) * U(0x9E3779B97F4A7C15) + U(7))]
            deal = np.r_[deal[cool], stir(own ^ U(0x2545F4914F6CDD1D))]
            lefts = np.r_[lefts[cool], np.ones(len(one), np.int64)]
    seg = range_hash(p, at, at + count + least - 1)
    return text, (seg, (left & LOW).astype("<u4"), (right & LOW).astype("<u4"), (at - offs[text]).astype("<u4"), count.astype("<u2"), lefts.astype("<u1")), deal


def firsts(seg: np.ndarray, left: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each entry is in the smallest document of those with its segment."""
    order = np.argsort(seg)
    s, a = seg[order], left[order]
    new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.empty(0, bool)
    if ((a[1:] != a[:-1]) & ~new[1:]).any():  # segments with equal hashes that differ: tell them apart
        order = np.lexsort((left, seg))
        s, a = seg[order], left[order]
        new = np.r_[True, (s[1:] != s[:-1]) | (a[1:] != a[:-1])]
    out = np.empty(len(s), bool)
    if len(s):
        d = doc[order]
        out[order] = d == np.minimum.reduceat(d, np.flatnonzero(new))[np.cumsum(new) - 1]
    return out


def shared(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each entry's value occurs in several documents."""
    order = np.argsort(value)
    v, d = value[order], doc[order]
    out = np.empty(len(v), bool)
    if len(v):
        new = np.r_[True, v[1:] != v[:-1]]
        at = np.flatnonzero(new)
        out[order] = (np.maximum.reduceat(d, at) > np.minimum.reduceat(d, at))[np.cumsum(new) - 1]
    return out


def merged(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of spans within groups (numbers from 0 in order of rows)."""
    wide = int(end.max(initial=0)) + 2
    s, e = group * wide + start, group * wide + end
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    at = np.flatnonzero(np.r_[True, s[1:] > e[:-1]]) if len(s) else np.empty(0, np.int64)
    s, e = s[at], e[np.r_[at[1:] - 1, len(e) - 1]] if len(s) else e
    return s // wide, s % wide, e - s // wide * wide


SPANS = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("doc", pa.int64()), ("key", pa.int64()), ("body", pa.binary())])
SPANS_DDL = "bucket long, kind int, doc long, key long, body binary"
COVER, ENTRIES, CANDIDATES = 0, 1, 2


def by_document(kind: int, doc: np.ndarray, key: np.ndarray, records: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each document with the bytes of its records. Rows of a document are neighbours."""
    at = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]) if len(doc) else np.empty(0, np.int64)
    ends = np.r_[at, len(doc)] * records.dtype.itemsize * (records.shape[1] if records.ndim > 1 else 1)
    body = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(np.ascontiguousarray(records).tobytes())])
    bucket = (stir(doc[at].view(U)) % U(buckets)).astype(np.int64)
    return pa.record_batch([pa.array(bucket), pa.array(np.full(len(at), kind, np.int32)), pa.array(doc[at]), pa.array(key[at]), body], schema=SPANS)


def covers(doc, key, start, end, buckets) -> pa.RecordBatch:
    """Rows of merged spans."""
    order = np.lexsort((key, doc))
    doc, key, start, end = doc[order], key[order], start[order].astype(np.int64), end[order].astype(np.int64)
    new = np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])] if len(doc) else np.empty(0, bool)
    group, s, e = merged(np.cumsum(new) - 1, start, end)
    first = np.flatnonzero(new)[group] if len(doc) else group
    return by_document(COVER, doc[first], key[first], np.stack([s, e], axis=1).astype("<i4"), buckets)


def pack(docs, keys, number, fields) -> bytes:
    """Entries of one bucket, in order of documents."""
    at = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    ids, count = number[at], np.diff(np.r_[at, len(number)])
    head = np.array([len(ids), len(number)], "<i8")
    return zstandard.compress(b"".join(x.tobytes() for x in (head, docs[ids], keys[ids].astype("<i8"), count.astype("<u4"), *fields)), 1)


def unpack(body: bytes):
    raw = zstandard.decompress(body)
    n, m = np.frombuffer(raw, "<i8", 2)
    at, out = 16, []
    for kind, size in (("<i8", n), ("<i8", n), ("<u4", n), *((k, m) for _, k in FIELDS)):
        out.append(np.frombuffer(raw, kind, size, at))
        at += out[-1].nbytes
    docs, keys, count = out[:3]
    return np.repeat(docs, count), np.repeat(keys, count), *out[3:]


def read_rows(b):
    """Slices of a batch's documents with ids."""
    if not b.num_rows:
        return
    b = b.filter(b.column("known"))
    docs, keys = np.asarray(b.column("id"), np.int64), np.asarray(b.column("key"), np.int64)
    for i, j, data, offs in slices(b.column("text")):
        yield docs[i:j], keys[i:j], data, offs


def hot_anchors(texts: DataFrame, least: int, limit: int, share: float) -> tuple[np.ndarray, int]:
    """Anchors with at least limit segments and that share of all, and the number of all segments."""

    def count(batches):
        held, total = [], 0

        def tell():
            a = np.sort(np.concatenate(held))
            at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.empty(0, np.int64)
            n = np.diff(np.r_[at, len(a)])
            at, n = at[n > 1], n[n > 1]
            return pa.record_batch([pa.array(np.r_[a[at].view(np.int64), 0]), pa.array(np.r_[n, 0]), pa.array(np.r_[np.zeros(len(n), np.int64), len(a)])], ["anchor", "n", "total"])

        for b in batches:
            for _, _, data, offs in read_rows(b):
                a = segments(data, offs, least)[4]
                held.append(a)
                total += len(a)
                if total >= FLUSH:
                    yield tell()
                    held, total = [], 0
        if held:
            yield tell()

    found = cut(texts.mapInArrow(count, "anchor long, n long, total long").groupBy("anchor").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where((F.col("n") >= limit) | (F.col("anchor") == 0)))
    total = found.agg(F.sum("total")).first()[0] or 0
    rows = found.where((F.col("n") >= max(limit, share * total)) & (F.col("anchor") != 0)).select("anchor").toArrow()
    return np.sort(np.asarray(rows.column("anchor")).astype(np.int64).view(U)), int(total)


def _ranked(value: np.ndarray) -> np.ndarray:
    """Each value's rank among the distinct ones. One sort and no more: what a pool takes follows from this."""
    order = np.argsort(value)
    new = np.empty(len(value), bool)
    new[:1] = False
    sorted_ = value[order]
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
    del sorted_
    rank = np.empty(len(value), np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32)
    return rank


def suffix_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their first depth bytes (at least), and each place's rank. Places take 32 bits: pools are far smaller."""
    n = len(data)
    require(n < 1 << 31, "repeats:PoolTooLarge", str(n))
    word = np.zeros(n, U)
    for k in range(min(8, n)):
        word[: n - k] |= data[k:].astype(U) << U(56 - 8 * k)
    rank = _ranked(word)
    del word
    have = 8
    while have < depth:
        pair = rank.astype(np.int64)
        pair *= n + 2
        pair[: n - have] += rank[have:]
        pair[: n - have] += 1
        rank = _ranked(pair)
        del pair
        have *= 2
    order = np.argsort(rank, kind="stable").astype(np.int32)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    return order, place


def intervals(data: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order of data, and the numbers of intervals of suffixes that share their first least bytes.

    The transform gives the byte before each suffix; the step from a suffix to the one that is
    longer by that byte maps every interval of length l, byte by byte, into intervals of length l + 1.
    """
    order, place = suffix_order(data, least)
    n = len(data)
    before = data[order - 1]  # the Burrows-Wheeler transform
    longer = place[order - 1]  # where each suffix goes when its byte is put before it
    del place
    source = np.empty(n, np.int32)
    source[longer] = np.arange(n, dtype=np.int32)
    letter = np.empty(n, np.uint8)
    letter[longer] = before
    del longer, before
    apart = np.ones(n, bool)
    apart[1:] = letter[1:] != letter[:-1]  # length 1
    open_ = np.flatnonzero(~apart).astype(np.int32)
    for _ in range(1, least):
        if not len(open_):
            break
        number = np.cumsum(apart, dtype=np.int32)
        cut_ = number[source[open_]] != number[source[open_ - 1]]
        apart[open_[cut_]] = True
        open_ = open_[~cut_]
    return order, np.cumsum(apart, dtype=np.int32) - 1


def covered_windows(data: np.ndarray, doc: np.ndarray, valid: np.ndarray, least: int) -> np.ndarray:
    """Places whose window also starts in a smaller document. doc: by place; valid: places where a window starts."""
    order, number = intervals(data, least)
    d = np.where(valid[order], doc[order], np.iinfo(doc.dtype).max)
    low = np.minimum.reduceat(d, np.flatnonzero(np.r_[True, number[1:] != number[:-1]]))
    out = np.zeros(len(data), bool)
    out[order] = valid[order] & (d > low[number])
    return out


PIECE = ("bucket", "share", "doc", "key", "start", "size")
CANDIDATE = np.dtype([("bucket", "<i4"), ("share", "<u4"), ("start", "<u4"), ("size", "<u4")])


def find(docs: DataFrame, least: int = 50, bucket_entries: int = 1_500_000, hot: int = 100_000, share: float = 1e-6, pool: int = 2 << 20):
    """The texts dealt by document (id, key, text) and the spans of their covered bytes (id, key, spans)."""
    session = docs.sparkSession
    # id and key are never null, so that joins add no filters and the exchange of the texts serves both of them.
    # The last bit of the key tells whether there is an id.
    tagged = F.shiftleft(F.xxhash64("text"), 1).bitwiseOR(F.col("doc_id").isNotNull().cast("long"))
    texts = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), tagged.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    placed_texts = texts.withColumn("known", F.col("key").bitwiseAND(F.lit(1)) == 1)
    found_hot, total = hot_anchors(placed_texts, least, hot, share)
    buckets = max(16, math.ceil(total / bucket_entries))
    sent = session.sparkContext.broadcast(found_hot)

    def local(batches):
        held, docs_, keys_, base = [], [], [], 0

        def tell():
            doc, key = np.concatenate(docs_), np.concatenate(keys_)
            number, deal, *fields = (np.concatenate(x) for x in zip(*held))
            first = firsts(fields[0], fields[1], doc[number])
            gone = np.flatnonzero(~first)
            start = fields[3][gone].astype(np.int64)
            yield covers(doc[number[gone]], key[number[gone]], start, start + fields[4][gone] + least - 1, buckets)
            bucket = ((deal >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
            pick = np.flatnonzero(first)
            pick = pick[np.argsort(bucket[pick], kind="stable")]
            number, bucket, fields = number[pick], bucket[pick], [f[pick] for f in fields]
            at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
            rows = [(int(bucket[a]), pack(doc, key, number[a:b], [f[a:b] for f in fields])) for a, b in zip(at, [*at[1:], len(bucket)])]
            n = len(rows)
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([ENTRIES] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=SPANS)

        size_ = 0
        for b in batches:
            for d, k, data, offs in read_rows(b):
                text, fields, deal = entries_of(data, offs, least, sent.value)
                held.append((text + base, deal, *fields))
                docs_.append(d)
                keys_.append(k)
                base += len(d)
                size_ += len(text)
                if size_ >= FLUSH:
                    yield from tell()
                    held, docs_, keys_, base, size_ = [], [], [], 0, 0
        if held:
            yield from tell()

    def settle(batches):
        def tell(bucket, bodies):
            doc, key, seg, left, right, start, windows, lefts = (np.concatenate(x) for x in zip(*map(unpack, bodies)))
            first = firsts(seg, left, doc)
            gone = np.flatnonzero(~first)
            s = start[gone].astype(np.int64)
            yield covers(doc[gone], key[gone], s, s + windows[gone] + least - 1, buckets)
            doc, key, left, right, start, windows, lefts = (x[first] for x in (doc, key, left, right, start, windows, lefts))
            out = []
            # Windows that reach far to the left go by the left side, the others by the right.
            for side, begin, count in ((left, start, lefts), (right, start + lefts, windows - lefts)):
                pick = np.flatnonzero(shared(side, doc) & (count > 0))
                c = np.empty(len(pick), CANDIDATE)
                c["bucket"], c["share"], c["start"], c["size"] = bucket, side[pick], begin[pick], count[pick].astype(np.uint32) + np.uint32(least - 1)
                out.append((doc[pick], key[pick], c))
            doc, key, c = (np.concatenate(x) for x in zip(*out))
            order = np.lexsort((key, doc))
            yield by_document(CANDIDATES, doc[order], key[order], c[order], buckets)

        now, bodies = None, []
        for b in batches:
            passed = b.filter(pa.compute.equal(b.column("kind"), COVER))
            if passed.num_rows:
                yield passed
            b = b.filter(pa.compute.equal(b.column("kind"), ENTRIES))
            for bucket, body in zip(b.column("bucket").to_pylist(), b.column("body").to_pylist()):
                if bucket != now and bodies:
                    yield from tell(now, bodies)
                    bodies = []
                now = bucket
                bodies.append(body)
        if bodies:
            yield from tell(now, bodies)

    parts = max(buckets, int(session.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(placed_texts.mapInArrow(local, SPANS_DDL).repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(settle, SPANS_DDL))
    dealt = texts.repartition("id", "key")

    def cut_out(batches):
        """Candidates with their bytes. Of equal pieces in a batch only the smallest document's go on; the others are covered."""
        for b in batches:
            rows, parts = [], []
            least_of: dict[tuple, int] = {}
            for doc, key, text, found in zip(b.column("id").to_pylist(), b.column("key").to_pylist(), b.column("text").to_pylist(), b.column("found").to_pylist()):
                raw = text.encode()
                for bucket, side, start, size_ in np.frombuffer(b"".join(found), CANDIDATE).tolist():
                    piece = raw[start : start + size_]
                    rows.append((bucket, side, doc, key, start, size_))
                    parts.append(piece)
                    low = least_of.get((bucket, side, piece))
                    if low is None or doc < low:
                        least_of[bucket, side, piece] = doc
            cols = np.array(rows, np.int64).reshape(-1, 6)
            low = np.array([least_of[r[0], r[1], x] for r, x in zip(rows, parts)], np.int64)
            gone = cols[:, 2] > low
            cols[gone, 1] = -1 - cols[gone, 2] % 1024  # covered: spread by document
            parts = [None if g else x for g, x in zip(gone.tolist(), parts)]
            yield pa.record_batch([*(pa.array(np.ascontiguousarray(cols[:, i])) for i in range(6)), pa.array(parts, pa.binary())], [*PIECE, "bytes"])

    def pools(batches):
        def tell(rows):
            # Equal pieces first: the smallest document's stays for the transform.
            least_of: dict[tuple, int] = {}
            distinct: dict[tuple, int] = {}
            for group, doc, _, _, piece in rows:
                low = least_of.get((group, piece))
                if low is None:
                    distinct[group] = distinct.get(group, 0) + 1
                if low is None or doc < low:
                    least_of[group, piece] = doc
            gone = [r for r in rows if r[1] > least_of[r[0], r[4]]]
            stay = [r for r in rows if r[1] == least_of[r[0], r[4]] and distinct[r[0]] > 1]
            doc, key, start, size_ = (np.array(x, np.int64) for x in zip(*((r[1], r[2], r[3], len(r[4])) for r in gone))) if gone else [np.empty(0, np.int64)] * 4
            yield covers(doc, key, start, start + size_, buckets)
            if not stay:
                return
            _, doc, key, start, parts = (list(x) for x in zip(*stay))
            lengths = np.array([len(x) + 1 for x in parts])
            data = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
            # By place: its piece, its number in there, and its document's rank; 32 bits each, as they stay while the transform runs.
            seg = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)
            inside = np.arange(len(data), dtype=np.int32)
            inside -= (np.cumsum(lengths) - lengths).astype(np.int32)[seg]
            valid = inside <= (lengths - 1 - least).astype(np.int32)[seg]
            doc, key, start = np.array(doc, np.int64), np.array(key, np.int64), np.array(start, np.int64)
            rank = np.unique(doc, return_inverse=True)[1].astype(np.int32)
            hit = np.flatnonzero(covered_windows(data, rank[seg], valid, least))
            s = start[seg[hit]] + inside[hit]
            yield covers(doc[seg[hit]], key[seg[hit]], s, s + least, buckets)

        held, size_, last = [], 0, None
        for b in batches:
            passed = b.filter(b.column("bytes").is_null())
            if passed.num_rows:
                doc, key, start, n = (np.asarray(passed.column(c)) for c in ("doc", "key", "start", "size"))
                yield covers(doc, key, start, start + n, buckets)
                b = b.filter(b.column("bytes").is_valid())
            for bucket, share_, *row in zip(*(b.column(c).to_pylist() for c in ("bucket", "share", "doc", "key", "start", "bytes"))):
                if (bucket, share_) != last and size_ >= pool:
                    yield from tell(held)
                    held, size_ = [], 0
                last = bucket, share_
                held.append((last, *row))
                size_ += len(row[-1]) + 1
        if held:
            yield from tell(held)

    candidates = placed.where(F.col("kind") == CANDIDATES).select(F.col("doc").alias("id"), "key", "body").groupBy("id", "key").agg(F.collect_list("body").alias("found"))
    with_text = dealt.join(candidates, ["id", "key"]).select("id", "key", "text", "found")
    cut_ = with_text.mapInArrow(cut_out, ", ".join(f"{c} long" for c in PIECE) + ", bytes binary")
    more = cut_.repartition("bucket", "share").sortWithinPartitions("bucket", "share").mapInArrow(pools, SPANS_DDL)
    spans = placed.where(F.col("kind") == COVER).union(more).select(F.coalesce("doc", F.lit(0)).alias("id"), F.coalesce("key", F.lit(0)).alias("key"), "body").groupBy("id", "key").agg(F.collect_list("body").alias("spans"))
    return dealt, spans


def kept_and_spans(text: bytes, bodies: list[bytes] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes outside of all spans, and the maximal removed runs."""
    if not bodies:
        return text, []
    s = np.concatenate([np.frombuffer(x, "<i4").reshape(-1, 2) for x in bodies]).astype(np.int64)
    _, start, end = merged(np.zeros(len(s), np.int64), s[:, 0], s[:, 1])
    runs = list(zip(start.tolist(), end.tolist()))
    out, past = [], 0
    for a, b in runs:
        out.append(text[past:a])
        past = b
    return b"".join([*out, text[past:]]), runs


def removals(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document."""
    dealt, spans = find(docs, **options)

    def tell(texts: pa.Array, spans_: pa.Array) -> pa.Array:
        rows = []
        for t, s in zip(texts.to_pylist(), spans_.to_pylist()):
            raw = t.encode()
            kept, runs = kept_and_spans(raw, s)
            rows.append({"n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(runs), "kept_sha256": hashlib.sha256(kept).hexdigest()})
        return pa.array(rows, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    new = F.arrow_udf(tell, "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>")
    return dealt.join(spans, ["id", "key"], "left").select(F.when(F.col("key").bitwiseAND(F.lit(1)) == 1, F.col("id")).alias("doc_id"), new("text", "spans").alias("told")).select("doc_id", "told.*")
