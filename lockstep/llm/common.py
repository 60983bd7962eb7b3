"""What the operators share: reading, lineage cuts and vectorised byte kernels.

The kernels work on the buffers of whole Arrow string columns, in slices of about
``SLICE`` bytes, so that a task's memory follows the slice (or its longest text), not
the batch. A null text counts as empty unless an operator says otherwise.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE = 1 << 19
U = np.uint64
#: Multiplier of the polynomial hash, odd, and its inverse modulo 2^64.
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def small_batches(spark: SparkSession) -> None:
    """At most 2000 rows go to Python at a time, so that a task's buffers hold some megabytes of long texts, not some hundred."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > 2000:
        spark.conf.set(key, "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(session: SparkSession) -> str:
    """The folder that all machines see: that of spark.checkpoint.dir, or one of this machine where all of Spark runs on it."""
    folder = session.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not session.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "checkpoints")


def own_folder(session: SparkSession, name: str) -> str:
    """A new place for a table in the shared folder."""
    return f"{shared_folder(session)}/{name}-{uuid.uuid4().hex}"


def kept_as_table(df: DataFrame, name: str) -> DataFrame:
    """df written to a compressed table in the shared folder, and read from it."""
    path = own_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_names(columns: Iterable[str], results: Iterable[str]) -> dict[str, str]:
    """The names that columns have beside results: those that clash get _kept added."""
    columns, results = list(columns), set(results)
    out: dict[str, str] = {}
    for c in columns:
        name = c
        while name in results or name in out.values() or (name != c and name in columns):
            name += "_kept"
        out[c] = name
    return out


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the cluster's shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def groups_of(batches, columns: tuple[str, ...]):
    """Rows of batches sorted by their first column, as tuples of lists with whole groups."""
    held: list[list] = [[] for _ in columns]
    for b in batches:
        for x, c in zip(held, columns):
            x += b.column(c).to_pylist()
        if held[0]:
            last = len(held[0]) - 1
            while last and held[0][last - 1] == held[0][-1]:
                last -= 1
            if last:
                yield tuple(x[:last] for x in held)
                held = [x[last:] for x in held]
    if held[0]:
        yield tuple(held)


def sieve(nodes: DataFrame, bits: int = 26, piece: int = 16) -> np.ndarray:
    """2^bits bits, set at the low bits of the nodes: 8 MB at any number of nodes, which then only let more others pass."""

    def fill(batches):
        for key, low in groups_of(batches, ("piece", "low")):
            at = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
            for a, b in zip(at, at[1:]):
                part = np.zeros(1 << piece, bool)
                part[low[a:b]] = True
                yield pa.record_batch([pa.array([key[a]], pa.int64()), pa.array([np.packbits(part).tobytes()], pa.binary())], ["piece", "body"])

    low = F.col("node").bitwiseAND((1 << bits) - 1)
    rows = nodes.select(F.shiftright(low, piece).alias("piece"), low.bitwiseAND((1 << piece) - 1).alias("low")).distinct()
    out = np.zeros((1 << (bits - piece), 1 << (piece - 3)), np.uint8)
    found = rows.repartition("piece").sortWithinPartitions("piece").mapInArrow(fill, "piece long, body binary").toArrow()
    for k, body in zip(found.column("piece").to_pylist(), found.column("body").to_pylist()):
        out[k] = np.frombuffer(body, np.uint8)
    return out.reshape(-1)


def _trim() -> None:
    """Give what a batch has left free back to the system: idle workers keep little, beside an executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last, bytes, offsets) of parts of a string column with about limit bytes; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    offs = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None and whole.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j
    _trim()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i up to n."""
    n = max(SLICE, 1 << int(n).bit_length())
    if n not in _powers:
        _powers.clear()
        up, down = np.full(n + 1, BASE, U), np.full(n + 1, INVERSE, U)
        up[0] = down[0] = 1
        _powers[n] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[n]


def stir(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = the polynomial of bytes i..j-1, times BASE^i."""
    up, _ = powers(len(data))
    p = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=p[1:])
    return p


def range_hash(p: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(p))
    return stir((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(U))


def words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes with inside[byte], and the first run of each text (one more at the end)."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offs), np.int64)
    isw = inside[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = isw[:-1]
    first = offs[:-1]
    before[first[first < len(data)]] = False
    starts = np.flatnonzero(isw & ~before)
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = isw[1:]
    last = offs[1:]
    after[last[last > 0] - 1] = False
    ends = np.flatnonzero(isw & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


#: Bytes outside of whitespace \x20 and \x09-\x0D.
SOLID = np.ones(256, bool)
SOLID[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of words without punctuation: ASCII letters and digits, and all of non-ASCII characters.
LETTERS = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])
#: ASCII capitals to small letters.
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)


def word_counts(texts: pa.Array) -> pa.Array:
    """Number of runs outside of whitespace, by text."""
    out = [np.diff(words(data, offs, SOLID)[2]) for _, _, data, offs in slices(texts)]
    return pa.array(np.concatenate(out) if out else np.empty(0, np.int64), pa.int64())
