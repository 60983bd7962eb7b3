"""Fingerprints by consistent weighted sampling of weighted terms.

A text's terms are its words in small letters (A-Z), weighted by how often they occur; of a word of over
``LONG`` bytes, as in scripts without spaces, they are its strings of ``RUN`` bytes. For each of a
fingerprint's places every term gets two gamma values and a uniform one from its hash. They
give its weight a quantised step and a cost; the term of least cost is drawn together with its step. Two texts draw alike in
a place with the probability of their generalised Jaccard index, the sum of the smaller weights over that of
the larger ones. A fingerprint holds 16 bits of each draw, so different draws agree once in 65,536.

Documents meet their successors by one shuffle of texts into blocks of neighbouring ids. The blocks' first keys
are found from ids alone; a block's first document is sent to the block before it as well (of the first block, to the last).

Nulls: a null text is empty, and an empty one or one of spaces has no terms and a fingerprint of zeros, like any other such. Null ids come
first; ids that repeat are ordered by a hash of the text. Repeated rows give repeated results. An empty table gives no rows; a
single document succeeds itself. Other columns are ignored. Very long texts are hashed in parts of ``PART`` bytes that end at a space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SOLID, U, prefix_sums, range_hash, stir, words

SIZE = 64
LONG, RUN = 64, 8
PART = 1 << 20
#: Terms that are drawn for at a time.
BLOCK = 1024
ODD = U(0x9E3779B97F4A7C15)
KEYS = stir(np.arange(1, SIZE + 1, dtype=U) * ODD)


def gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """The n-quantiles' middles of the gamma distribution of shape 2, by Newton's method on 1 - (1 + x) exp(-x)."""
    level = (np.arange(n) + 0.5) / n
    x = np.full(n, 1.0)  # the density's peak, from which the method always settles
    for _ in range(60):
        x -= (1 - (1 + x) * np.exp(-x) - level) / (x * np.exp(-x))
    return x


_GAMMA = gamma_quantiles().astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)


def parts(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number of each row's text, bytes, offsets) of about PART bytes; longer texts are cut after a space where they have one."""
    held: list[bytes] = []
    rows: list[int] = []
    size = 0

    def told():
        offs = np.zeros(len(held) + 1, np.int64)
        np.cumsum([len(x) for x in held], out=offs[1:])
        return np.array(rows), np.frombuffer(b"".join(held), np.uint8), offs

    for i, text in enumerate(texts):
        a = 0
        while a < len(text) or a == 0:
            b = min(len(text), a + PART)
            if b < len(text):
                b = max(text.rfind(b" ", a, b), text.rfind(b"\n", a, b)) + 1 or b
            held.append(text[a:b])
            rows.append(i)
            size += b - a
            a = max(b, 1)
            if size >= PART:
                yield told()
                held, rows, size = [], [], 0
    if held:
        yield told()


def terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each occurrence of a term."""
    low = LOWER[data]
    starts, ends, first = words(low, offs, SOLID)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    far = ends - starts > LONG
    if far.any():
        n = (ends - starts)[far] - RUN + 1
        inner = np.repeat(starts[far] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        row = np.append(row[~far], np.repeat(row[far], n))
        starts, ends = np.append(starts[~far], inner), np.append(ends[~far], inner + RUN)
    return row, range_hash(prefix_sums(low), starts, ends)


def counted(text: np.ndarray, term: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with equal text and term in one, n summed; by term."""
    order = np.lexsort((text, term))
    text, term, n = text[order], term[order], n[order]
    at = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (term[1:] != term[:-1]))) if len(text) else np.empty(0, np.int64)
    return text[at], term[at], np.add.reduceat(n, at) if len(at) else n


def draws(term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each term of some weight and each place: its cost in the upper 32 bits, what is drawn in the lower ones."""
    x = stir(term[:, None] ^ KEYS)
    u = x.view(np.uint16).reshape(*x.shape, 4)
    r, c = _GAMMA[u[..., 0]], _LOG_GAMMA[u[..., 1]]
    beta = u[..., 2] * np.float32(2.0**-16)
    step = np.floor(np.log(weight.astype(np.float32))[:, None] / r + beta)
    cost = c - r * (step - beta + np.float32(1))
    bits = cost.view(np.int32)
    rank = (bits ^ (bits >> 31 | np.int32(-(1 << 31)))).view(np.uint32)  # ascending with cost
    drawn = (x ^ (step.astype(np.int32).view(np.uint32) * U(0xD6E8FEB86659FD93))) * ODD >> U(32)
    return rank.astype(U) << U(32) | drawn


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """SIZE numbers of 16 bits for each text."""
    found = [np.empty(0, np.int64), np.empty(0, U), np.empty(0, np.int64)]
    for rows, data, offs in parts(texts):
        row, term = terms(data, offs)
        some = counted(rows[row], term, np.ones(len(term), np.int64))
        found = [np.append(a, b) for a, b in zip(found, some)]
    text, term, n = counted(*found)
    least = np.full((len(texts), SIZE), ~U(0))
    order = np.lexsort((text, n, term))  # equal terms of equal weight draw alike, whichever text has them
    text, term, n = text[order], term[order], n[order]
    new = np.append(True, (term[1:] != term[:-1]) | (n[1:] != n[:-1])) if len(term) else np.empty(0, bool)
    kind, at = np.cumsum(new) - 1, np.flatnonzero(new)
    for a in range(0, len(at), BLOCK):
        block = at[a : a + BLOCK]
        drawn = draws(term[block], n[block])
        lo, hi = block[0], at[a + BLOCK] if a + BLOCK < len(at) else len(text)
        by_text = lo + np.argsort(text[lo:hi], kind="stable")
        of = text[by_text]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        least[of[first]] = np.minimum(least[of[first]], np.minimum.reduceat(drawn[kind[by_text] - a], first, axis=0))
    out = (least & U(0xFFFF)).astype(np.uint16)
    out[np.bincount(text, minlength=len(texts))[: len(texts)] == 0] = 0
    return out


def written(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """text, its last quarter replaced by as much of the beginning of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compared(batches: Iterable[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows (block, guest, doc_id, text) in order: each but guests with its edited text's fingerprint and its successor's."""

    def told(rows: list[tuple]) -> pa.RecordBatch:
        """rows: (block, guest, id, text); all but the last with what follows them."""
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
        changed = [edited(a[3], b[3]) for a, b in pairs]
        whole = [r[3].encode() for r in rows]
        prints = fingerprints([*whole, *(x.encode() for x in changed)])
        place = {id(r): k for k, r in enumerate(rows)}
        own, after, new = prints[[place[id(a)] for a, _ in pairs]], prints[[place[id(b)] for _, b in pairs]], prints[len(rows) :]
        return pa.record_batch(
            {
                "doc_id": pa.array([a[2] for a, _ in pairs], pa.int64()),
                "n_chars": pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
                "fingerprint": pa.array(map(written, own), pa.string()),
                "edited_fingerprint": pa.array(map(written, new), pa.string()),
                "near_edited": pa.array(map(likeness, own, new), pa.float64()),
                "near_next": pa.array(map(likeness, own, after), pa.float64()),
            }
        )

    rows: list[tuple] = []
    size = 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("block", "guest", "doc_id", "text"))):
            rows.append(row)
            size += len(row[3])
            if size >= limit and len(rows) > 1:
                yield told(rows)
                rows, size = rows[-1:], 0
    if len(rows) > 1:
        yield told(rows)


def blocked(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, guest, at, tie, doc_id, text): neighbouring ids in one block, the first of each also as guest in the one before."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("at", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))).withColumn("tie", F.xxhash64("text"))
    keys = docs.select("at", "tie").repartitionByRange(blocks, "at", "tie")
    first = sorted(tuple(r.least) for r in keys.groupBy(F.spark_partition_id()).agg(F.min(F.struct("at", "tie")).alias("least")).collect())
    ids, ties = np.array([x[0] for x in first], np.int64), np.array([x[1] for x in first], np.int64)
    n = len(first)

    @F.pandas_udf("array<int>")
    def block_of(at: pd.Series, tie: pd.Series) -> pd.Series:
        at, tie = at.to_numpy(np.int64), tie.to_numpy(np.int64)
        lo, hi = np.searchsorted(ids, at, "left"), np.searchsorted(ids, at, "right")
        block = hi - 1
        for i in np.flatnonzero(hi > lo).tolist():  # an id that begins blocks: its rows lie by their ties
            block[i] = lo[i] + np.searchsorted(ties[lo[i] : hi[i]], tie[i], "right") - 1
        begins = (ids[block] == at) & (ties[block] == tie)
        return pd.Series([[b, (b - 1) % n] if x else [b] for b, x in zip(block.tolist(), begins.tolist())])

    placed = docs.withColumn("blocks", block_of("at", "tie")).select("doc_id", "text", "at", "tie", F.posexplode("blocks").alias("guest", "block"))
    return placed.withColumn("guest", F.col("guest") > 0).repartition(blocks, "block").sortWithinPartitions("block", "guest", "at", "tie", "text")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each document."""
    session = docs.sparkSession
    blocks = max(docs.rdd.getNumPartitions(), int(session.conf.get("spark.sql.shuffle.partitions")))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return blocked(docs, blocks).select("block", "guest", "doc_id", "text").mapInArrow(compared, schema)
