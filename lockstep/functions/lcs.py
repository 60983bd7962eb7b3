"""Longest common subsequences of many pairs of short sequences side by side."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CELLS = 1 << 21  # of the tables that are filled together


def walked(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The reference's place (from 0) of each observed one in their longest common subsequence, or -1; equal: pair, observed, reference; n, m: lengths.

    The table of lengths is filled row by row from the end: a place takes the best of those to its right, where an equal one counts one more than
    what follows it. Equal ones are taken where they meet, else the observed one is passed over unless that loses length.
    """
    many, rows, columns = equal.shape
    table = np.zeros((rows + 1, many, columns + 1), np.int32)
    for i in range(rows - 1, -1, -1):
        own = table[i + 1].copy()
        own[:, :-1] += equal[:, i] * (table[i + 1][:, 1:] + 1 - own[:, :-1])
        table[i] = np.maximum.accumulate(own[:, ::-1], axis=1)[:, ::-1]
    out = np.full((many, rows), -1, np.int64)
    b, i, j = np.arange(many), np.zeros(many, np.int64), np.zeros(many, np.int64)
    while True:
        inside = (i < n[b]) & (j < m[b])
        b, i, j = b[inside], i[inside], j[inside]
        if not len(b):
            return out
        hit = equal[b, i, j]
        over = table[i + 1, b, j] >= table[i, b, j + 1]
        out[b[hit], i[hit]] = j[hit]
        i, j = i + (hit | over), j + (hit | ~over)


def _edges(lists: pa.Array, kinds: dict):
    """Lengths, numbers, codes of types and intervals of a column of edge lists."""
    flat = lists.flatten()
    code = [np.array([kinds.setdefault(x, len(kinds)) if x is not None else -1 for x in column.dictionary.to_pylist() + [None]])[column.indices.fill_null(len(column.dictionary)).to_numpy()] for column in (flat.field(k).dictionary_encode() for k in ("source_type", "destination_type"))]
    value = flat.field("interval_sec").cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    return np.diff(lists.offsets.to_numpy()), flat.field("interval_number"), *code, value


def _padded(lengths: np.ndarray, values: np.ndarray, pick: np.ndarray, fill) -> np.ndarray:
    """The picked lists as rows of one width."""
    start = (np.cumsum(lengths) - lengths)[pick]
    k = np.arange(max(1, int(lengths[pick].max())))
    inside = k < lengths[pick][:, None]
    return np.where(inside, np.append(values, fill)[np.where(inside, start[:, None] + k, len(values))], fill)


def numbers(batch: pa.RecordBatch, tolerance: float) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Row, interval_number and the reference's number of every observed edge (column o) of a batch, by the reference's edges in column r."""
    kinds: dict = {}
    n, own, source, destination, value = _edges(batch.column("o"), kinds)
    m, known, source2, destination2, value2 = _edges(batch.column("r"), kinds)
    at, first = np.cumsum(n) - n, np.cumsum(m) - m
    found = np.full(int(n.sum()), -1, np.int64)
    for pick in _parts(n, m):
        x, y = (_padded(a, v, pick, np.nan) for a, v in ((n, value), (m, value2)))
        x, y = x[:, :, None], y[:, None, :]
        equal = np.ones(np.broadcast_shapes(x.shape, y.shape), bool)
        for a, b in ((source, source2), (destination, destination2)):
            equal &= _padded(n, a, pick, -1)[:, :, None] == _padded(m, b, pick, -2)[:, None, :]
        equal &= np.abs(x - y) <= tolerance + 10 * np.spacing(np.maximum(1.0, np.maximum(np.abs(x), np.abs(y))))
        got = walked(equal, n[pick], m[pick])
        row, k = np.nonzero(got >= 0)
        found[at[pick[row]] + k] = first[pick[row]] + got[row, k]
    return np.repeat(np.arange(len(n)), n), own, known.take(pa.array(found, mask=found < 0))


def _parts(n: np.ndarray, m: np.ndarray) -> Iterator[np.ndarray]:
    """Rows that are looked at together: of like length, CELLS of their tables at most, or one row."""
    order = np.lexsort((m, n))
    a = 0
    while a < len(order):
        size = (n[order[a:]] + 1) * (np.maximum.accumulate(m[order[a:]]) + 1) * np.arange(1, len(order) - a + 1)
        b = a + max(1, int(np.searchsorted(size > CELLS, True)))
        yield order[a:b]
        a = b
