"""Media columns: texts stored as lossless WebP images, read back and described.

A text's UTF-8 bytes, filled with 255 up to a positive multiple of ``UNIT``, are the RGBA samples of an image of
``UNIT / 4`` columns (wider, in whole multiples, where it would have over 16384 rows; the last row is then filled as well).
All steps are map-only; a row's memory follows its own text.

Nulls: a null text is empty, which is stored as one unit of 255. Null ids are carried. Texts of up to 1 GB
fit the format. Repeated rows give repeated results. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import webp

UNIT = 576
ROW = UNIT // 4
HIGH = webp.MOST


def samples_of(text: bytes) -> np.ndarray:
    """A text's image."""
    rows = max(1, -(-len(text) // UNIT))
    wide = -(-rows // HIGH)
    high = -(-rows // wide)
    samples = np.full(high * wide * UNIT, 255, np.uint8)
    samples[: len(text)] = np.frombuffer(text, np.uint8)
    return samples.reshape(high, wide * ROW, 4)


def store(text: bytes) -> bytes:
    """The stored form of a text."""
    return webp.encode(samples_of(text))


def store_all(texts: Iterable[bytes], limit: int = 1 << 20) -> Iterator[bytes]:
    """The stored forms of texts, about limit bytes at a time."""
    held: list[np.ndarray] = []
    size = 0
    for text in texts:
        held.append(samples_of(text))
        size += held[-1].size
        if size >= limit:
            yield from webp.encode_all(held)
            held, size = [], 0
    yield from webp.encode_all(held)


@lru_cache(1024)
def grid(h: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rows and columns of the cells of an 8 x 8 grid, and the cells' areas."""
    rows, cols = np.linspace(0, h, 9).astype(int)[:-1], np.linspace(0, w, 9).astype(int)[:-1]
    return rows, cols, np.outer(np.diff(np.r_[rows, h]).clip(1), np.diff(np.r_[cols, w]).clip(1))


def feature(samples: np.ndarray) -> str:
    """Channel means and a 64-bit pattern of the cells of an 8 x 8 grid that are brighter than their mean."""
    h, w, _ = samples.shape
    rows, cols, area = grid(h, w)
    by_column = np.add.reduceat(samples.reshape(h, w * 4), 4 * cols, axis=1, dtype=np.int64)
    mean = np.add.reduceat(by_column, rows, axis=0) / area
    pattern = np.packbits(mean > mean.mean()).tobytes().hex()
    means = samples.reshape(-1, 4).sum(axis=0, dtype=np.int64) / (h * w)
    return ",".join(f"{x:.3f}" for x in means.tolist()) + ":" + pattern


def describe(stored: bytes, n_bytes: int, samples: np.ndarray | None = None) -> dict:
    """What the stored bytes of a text of n_bytes hold; samples: these bytes decoded, if they are already."""
    samples = webp.decode(stored) if samples is None else samples
    payload = samples.reshape(-1)[: max(1, -(-n_bytes // UNIT)) * UNIT].tobytes()
    return {
        "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-32:]),
        "media_bytes": len(stored), "media_sha256": hashlib.sha256(stored).hexdigest(), "feature": feature(samples),
    }


def describe_all(stored: Iterable[bytes], n_bytes: Iterable[int], limit: int = 1 << 21) -> Iterator[dict]:
    """What stored forms hold, those of texts of about limit bytes decoded at a time."""

    def tell():
        for (x, n), samples in zip(held, webp.decode_all([x for x, _ in held])):
            yield describe(x, n, samples)

    held: list[tuple[bytes, int]] = []
    size = 0
    for x, n in zip(stored, n_bytes):
        held.append((x, n))
        size += n + UNIT
        if size >= limit:
            yield from tell()
            held, size = [], 0
    yield from tell()


DESCRIPTION = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def with_media(docs: DataFrame, column: str = "media") -> DataFrame:
    """docs with the stored form of text."""
    put = F.arrow_udf(lambda t: pa.array(list(store_all((x.as_py() or "").encode() for x in t)), pa.binary()), "binary")
    return docs.withColumn(column, put("text"))


def described(docs: DataFrame, column: str = "media") -> DataFrame:
    """docs with their n_bytes and what their stored forms hold when read back."""
    kinds = pa.struct([(k, pa.int64() if v == "long" else pa.string()) for k, v in (x.split() for x in DESCRIPTION.split(", "))])
    tell = F.arrow_udf(lambda m, n: pa.array(list(describe_all((x.as_py() for x in m), n.to_pylist())), kinds), "struct<" + ",".join(x.replace(" ", ":") for x in DESCRIPTION.split(", ")) + ">")
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.withColumn("n_bytes", n).withColumn("__told", tell(column, n)).select("*", "__told.*").drop("__told")
