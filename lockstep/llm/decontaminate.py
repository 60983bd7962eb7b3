"""Benchmark decontamination by size-partitioned MinHash containment.

Items are partitioned by their number of distinct word shingles, by powers of two. An item of q
shingles is contained at level t in a text only if the text holds at least
``ceil(t q)`` of them, so any ``q - ceil(t q) + 1`` of its shingles include one that the text has. The
item's sketch is that many of its least MinHash values: its partition fixes the sketch
length, and a candidate is a text that holds one of an item's sketch values. No window or
signature of the text is needed, so a short item is found inside a text of any length, and
none is missed. Candidates are then verified by exact containment of shingles, comparing words.

The documents are read once for every block of items; a block is bounded by ``block_bytes`` of item text and only
its items are sent to the tasks. Documents are never shuffled: rows out are matches only.

Words are runs of ASCII letters and digits and of all non-ASCII characters, with A-Z in lower case;
an item with fewer than ``width`` words is one shingle of all of them.
Nulls: null or wordless texts and items match nothing. A null doc_id or item_id is carried.
Repeated rows repeat their matches. Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, LOWER, U, prefix_sums, range_hash, slices, stir, words


def shingle_hashes(data: np.ndarray, offs: np.ndarray, width: int):
    """For lower-cased bytes: hashes of each run of width words, its word number, and the word bounds by text."""
    starts, ends, first = words(data, offs, LETTERS)
    if len(starts) < width:
        return np.empty(0, U), np.empty(0, np.int64), starts, ends, first
    h = range_hash(prefix_sums(data), starts, ends)
    n = len(h) - width + 1
    out = np.zeros(n, U)
    for k in range(width):
        out = stir(out * U(0x9FB21C651E98DF25) + h[k : k + n])
    last = np.repeat(first[1:], np.diff(first))[:n]
    inside = np.flatnonzero(np.arange(n) + width <= last)
    return out[inside], inside, starts, ends, first


def tokens(text: str) -> list[bytes]:
    data = LOWER[np.frombuffer(text.encode(), np.uint8)] if text else np.empty(0, np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]), LETTERS)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


class Items:
    """Sketches of a block of items, by the number of words in their shingles."""

    def __init__(self, ids: list, texts: list[str], width: int, level: float):
        self.ids, self.sets, self.level = ids, [], level
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, text in enumerate(texts):
            t = tokens(text or "")
            n = min(width, len(t))
            self.sets.append({b" ".join(t[i : i + n]) for i in range(len(t) - n + 1)} if n else set())
            if not n:
                continue
            data = LOWER[np.frombuffer(text.encode(), np.uint8)]
            h = np.unique(shingle_hashes(data, np.array([0, len(data)]), n)[0])
            size = 1 << (len(h) - 1).bit_length()  # the partition's upper size; its least level fixes the sketch
            length = min(len(h), size - math.ceil(level * size - 1e-9) + 1)
            found.setdefault(n, []).append((h[:length], k))
        self.sketch = {n: self._joined(x) for n, x in found.items()}

    @staticmethod
    def _joined(parts):
        h = np.concatenate([x for x, _ in parts])
        of = np.concatenate([np.full(len(x), k) for x, k in parts])
        order = np.argsort(h, kind="stable")
        return h[order], of[order]

    def matches(self, texts: pa.Array):
        """(row, item, containment) of all matches."""
        for base, _, data, offs in slices(texts):
            data = LOWER[data]
            wanted: dict[int, set[int]] = {}
            kept = {}
            for n, (sketch, of) in self.sketch.items():
                h, at, starts, ends, first = kept[n] = shingle_hashes(data, offs, n)
                if not len(h):
                    continue
                # a small table of 2^16 slots passes few values on to the exact lookup
                slots = np.zeros(1 << 16, bool)
                slots[(sketch & U(0xFFFF)).astype(np.int64)] = True
                hit = np.flatnonzero(slots[(h & U(0xFFFF)).astype(np.int64)])
                lo, hi = np.searchsorted(sketch, h[hit], "left"), np.searchsorted(sketch, h[hit], "right")
                hit, lo, hi = hit[hi > lo], lo[hi > lo], hi[hi > lo]
                rows = np.searchsorted(first, at[hit], "right") - 1
                for row, a, b in zip(rows.tolist(), lo.tolist(), hi.tolist()):
                    wanted.setdefault(row, set()).update(of[a:b].tolist())
            raw = data.tobytes() if wanted else b""
            for row, items in wanted.items():
                sets: dict[int, set[bytes]] = {}
                for n, (_, _, starts, ends, first) in kept.items():
                    t = [raw[a:b] for a, b in zip(starts[first[row] : first[row + 1]].tolist(), ends[first[row] : first[row + 1]].tolist())]
                    sets[n] = {b" ".join(t[i : i + n]) for i in range(len(t) - n + 1)}
                for k in sorted(items):
                    own = self.sets[k]
                    n = next(iter(own)).count(b" ") + 1
                    share = len(own & sets[n]) / len(own)
                    if share >= self.level - 1e-12:
                        yield base + row, k, share


def blocks(items: DataFrame, block_bytes: int):
    """The items in blocks of about block_bytes of text, one block on the driver at a time. Rows alike in id and text are in one block."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield part.select("item_id", "text").toArrow()


def matches(docs: DataFrame, items: DataFrame, width: int = 5, level: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, item_id, containment): every document that contains at least level of an item's shingles."""
    sc, out = docs.sparkSession.sparkContext, None
    for part in blocks(items, block_bytes):
        sent = sc.broadcast((part.column("item_id").to_pylist(), part.column("text").to_pylist()))

        def find(batches, sent=sent):
            own = Items(*sent.value, width, level)
            for b in batches:
                found = list(own.matches(b.column("text")))
                rows, ks, shares = zip(*found) if found else ((), (), ())
                ids = b.column("doc_id").take(pa.array(rows, pa.int64()))
                yield pa.record_batch([ids, pa.array([own.ids[k] for k in ks], pa.int64()), pa.array(shares, pa.float64())], ["doc_id", "item_id", "containment"])

        found = docs.select("doc_id", "text").mapInArrow(find, "doc_id long, item_id long, containment double")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, width: int = 5, level: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """docs without those that contain an item; the rows are filtered where they are read.

    All columns pass unchanged. A null or empty text contains no item and stays, as do null ids; rows that are alike stay or go alike. Without items all stay.
    """
    sc = docs.sparkSession.sparkContext
    for part in blocks(items.dropDuplicates(["text"]), block_bytes):
        sent = sc.broadcast((part.column("item_id").to_pylist(), part.column("text").to_pylist()))

        def keep(batches, sent=sent):
            own = Items(*sent.value, width, level)
            for b in batches:
                bad = {row for row, _, _ in own.matches(b.column("text"))}
                yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
