"""EDF files: header parsing, a Spark data source with channel and record pruning, and writing.

``register(spark)`` adds the format ``edf``: ``spark.read.format("edf").option("channels", "C3,M1").load(path)`` gives one row
per record and channel (recording, channel, block_id, first_sample, values). A file is cut into ranges of bytes (bytesPerPartition at most) by its size alone,
and a task takes neighbouring ranges up to bytesPerTask, where each range counts at least OPEN bytes: many small files make few tasks. For each
range it reads the file's header, 256 (n + 1) bytes, and the records that begin there, in batches; only the chosen channels are decoded.

Paths may be local or name a store that Arrow's file systems reach (file, s3, gs, hdfs). No file is opened by the driver unless ranges of records are asked for.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import AlignmentError, require

# Names and widths of the header's fields.
FIXED = (("version", 8), ("patient_id", 80), ("recording_id", 80), ("start_date", 8), ("start_time", 8), ("header_bytes", 8), ("reserved", 44), ("n_records", 8), ("record_duration", 8), ("n_signals", 4))
SIGNAL = (("label", 16), ("transducer", 80), ("physical_dimension", 8), ("physical_min", 8), ("physical_max", 8), ("digital_min", 8), ("digital_max", 8), ("prefilter", 80), ("samples_in_record", 8), ("reserved", 32))


@dataclass
class Header:
    fields: dict[str, str]
    signals: list[dict[str, str]]

    @property
    def records(self) -> int:
        return int(self.fields["n_records"])

    @property
    def duration(self) -> float:
        return float(self.fields["record_duration"])

    @property
    def size(self) -> int:
        return 256 * (len(self.signals) + 1)

    @property
    def samples(self) -> list[int]:
        return [int(s["samples_in_record"]) for s in self.signals]

    @property
    def record_bytes(self) -> int:
        return 2 * sum(self.samples)

    def bytes(self) -> bytes:
        out = "".join(self.fields[k].ljust(w)[:w] for k, w in FIXED)
        out += "".join(s[k].ljust(w)[:w] for k, w in SIGNAL for s in self.signals)
        return out.encode("ascii")


def _text(raw: bytes, name: str) -> str:
    require(all(32 <= c < 127 for c in raw), "edf:NonAsciiField", name)
    return raw.decode("ascii")


def parse(head: bytes, size: int | None = None) -> Header:
    """The header of a file's first bytes; with size, its length is checked as well."""
    require(len(head) >= 256, "edf:ShortHeader")
    fields, at = {}, 0
    for name, width in FIXED:
        fields[name] = _text(head[at : at + width], name)
        at += width
    require(fields["version"].strip() == "0", "edf:UnsupportedVersion", fields["version"])
    number = lambda name, kind: _number(fields[name], name, kind)
    n, records, duration = number("n_signals", int), number("n_records", int), number("record_duration", float)
    require(records != -1, "edf:UnknownRecordCount")
    require(records >= 0, "edf:InvalidRecordCount")
    require(np.isfinite(duration) and duration > 0, "edf:InvalidRecordDuration")
    require(n > 0, "edf:NoSignals")
    require(number("header_bytes", int) == 256 * (n + 1), "edf:HeaderSizeMismatch")
    require(len(head) >= 256 * (n + 1), "edf:ShortHeader")
    signals = [{} for _ in range(n)]
    for name, width in SIGNAL:
        for s in signals:
            s[name] = _text(head[at : at + width], name)
            at += width
    for s in signals:
        require(_number(s["samples_in_record"], "samples_in_record", int) > 0, "edf:InvalidSampleCount")
    h = Header(fields, signals)
    if size is not None:
        require(size == h.size + records * h.record_bytes, "edf:FileSizeMismatch", f"{size}")
    return h


def _number(text: str, name: str, kind):
    try:
        return kind(text.strip())
    except ValueError:
        raise AlignmentError("edf:InvalidNumber", f"{name}: {text!r}") from None


def scale(s: dict[str, str]) -> tuple[float, float]:
    """(gain, offset) from digital to physical values."""
    lo, hi, dlo, dhi = (float(s[k]) for k in ("physical_min", "physical_max", "digital_min", "digital_max"))
    gain = (hi - lo) / (dhi - dlo)
    return gain, lo - gain * dlo


def at_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path there."""
    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else (fs.LocalFileSystem(), os.path.abspath(path))


def head_of(f: pa.NativeFile) -> bytes:
    """The header's bytes, and no others: the fixed part tells how many there are."""
    first = f.read_at(256, 0)
    n = first[252:256].strip()
    return first + f.read_at(256 * int(n), 256) if n.isdigit() else first


class _Range(InputPartition):
    """Records that begin from one byte of a file's data up to another; or a range of records."""

    def __init__(self, path: str, size: int, low: int, high: int, records: bool = False):
        self.path, self.size, self.low, self.high, self.records = path, size, low, high, records


class _Task(InputPartition):
    """Ranges that one task reads."""

    def __init__(self, ranges: list[_Range]):
        self.ranges = ranges


#: What a range counts at least when ranges are dealt to tasks, and the rows' bytes that are handed on together.
OPEN, HAND = 1 << 19, 4 << 20


def _dealt(ranges: list[_Range], limit: int) -> list[_Task]:
    """Neighbouring ranges in tasks of about limit bytes."""
    tasks, size = [], limit
    for r in ranges:
        own = max(OPEN, min(r.high, r.size) - r.low)
        if size + own > limit:
            tasks.append(_Task([]))
            size = 0
        tasks[-1].ranges.append(r)
        size += own
    return tasks


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.only = [c.strip() for c in options["channels"].split(",")] if options.get("channels") else None
        self.bytes = int(options.get("bytesPerPartition", 64 << 20))
        self.task = int(options.get("bytesPerTask", 64 << 20))
        self.step = int(options["recordsPerPartition"]) if options.get("recordsPerPartition") else None

    def partitions(self):
        store, path = at_store(self.path)
        infos = [store.get_file_info(path)]
        if infos[0].type == fs.FileType.Directory:
            infos = sorted((i for i in store.get_file_info(fs.FileSelector(path)) if i.type == fs.FileType.File and re.fullmatch(r".*\.edf", i.base_name, re.I)), key=lambda i: i.path)
        if self.step is None:
            return _dealt([_Range(i.path, i.size, a, a + self.bytes) for i in infos for a in range(0, max(1, i.size), self.bytes)], self.task)
        out = []
        for i in infos:
            with store.open_input_file(i.path) as f:
                n = parse(head_of(f), i.size).records
            out += [_Task([_Range(i.path, i.size, a, min(n, a + self.step), True)]) for a in range(0, n, self.step)]
        return out

    def read(self, partition: _Task):
        held, size = [], 0
        for part in partition.ranges:
            for batch in self.records(part):
                held.append(batch)
                size += batch.nbytes
                if size >= HAND:
                    yield pa.concat_batches(held)
                    held, size = [], 0
        if held:
            yield pa.concat_batches(held)

    def records(self, partition: _Range):
        with at_store(self.path)[0].open_input_file(partition.path) as f:
            h = parse(head_of(f), partition.size)
            offsets = np.concatenate([[0], np.cumsum(h.samples)])
            labels = [s["label"].strip() for s in h.signals]
            for name in self.only or ():
                require(labels.count(name) > 0, "edf:MissingChannel", name)
                require(labels.count(name) == 1, "edf:DuplicateChannel", name)
            chosen = [i for i, x in enumerate(labels) if self.only is None or x in self.only]
            first, past = (partition.low, partition.high) if partition.records else (-(-k // h.record_bytes) for k in (partition.low, partition.high))
            name, at_once = partition.path.rsplit("/", 1)[-1], max(1, (4 << 20) // h.record_bytes)
            for a in range(first, min(past, h.records), at_once):
                n = min(at_once, past - a, h.records - a)
                raw = np.frombuffer(f.read_at(n * h.record_bytes, h.size + a * h.record_bytes), "<i2").reshape(n, -1)
                blocks = np.arange(a, a + n)
                for i in chosen:
                    gain, offset = scale(h.signals[i])
                    size = h.samples[i]
                    values = (raw[:, offsets[i] : offsets[i + 1]] * gain + offset).reshape(-1)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * size + 1, size), pa.int32()), pa.array(values))
                    columns = [pa.array([name] * n), pa.array([labels[i]] * n), pa.array([i + 1] * n, pa.int32()), pa.array(blocks), pa.array(blocks * size + 1), pa.array([size / h.duration] * n, pa.float64()), lists]
                    yield pa.RecordBatch.from_arrays(columns, ["recording", "channel", "signal_index", "block_id", "first_sample", "rate", "values"])


class EdfSource(DataSource):
    @classmethod
    def name(cls):
        return "edf"

    def schema(self):
        return "recording string, channel string, signal_index int, block_id long, first_sample long, rate double, values array<double>"

    def reader(self, schema):
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(EdfSource)


def long_form(blocks: DataFrame) -> DataFrame:
    """One row per sample."""
    return blocks.select("recording", "channel", "first_sample", F.posexplode("values").alias("i", "value")).select("recording", "channel", (F.col("first_sample") + F.col("i")).alias("sample"), "value")


def folder(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder (not below it) with their header's facts, or the reason why they are no valid EDF; by name.

    Spark lists the files with their sizes; of each, executors read the header alone. Links are not followed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[eE][dD][fF]").option("recursiveFileLookup", "false").load(path)

    def inspect(batches):
        for pdf in batches:
            rows = []
            for p, size in zip(pdf["path"], pdf["length"]):
                row = {"name": os.path.basename(p), "path": p, "size": size, "patient_id": None, "recording_id": None, "n_records": None, "n_signals": None, "duration_sec": None, "error": None}
                try:
                    store, inner = at_store(p)
                    require(not (isinstance(store, fs.LocalFileSystem) and os.path.islink(inner)), "edf:NotARegularFile")
                    with store.open_input_file(inner) as f:
                        h = parse(head_of(f), size)
                    row |= {"patient_id": h.fields["patient_id"], "recording_id": h.fields["recording_id"], "n_records": h.records, "n_signals": len(h.signals), "duration_sec": h.records * h.duration}
                except AlignmentError as e:
                    row["error"] = e.identifier
                rows.append(row)
            yield pd.DataFrame(rows, columns=["name", "path", "size", "patient_id", "recording_id", "n_records", "n_signals", "duration_sec", "error"]).astype({"n_records": "Int64", "n_signals": "Int64"})

    out = files.select("path", "length").mapInPandas(inspect, "name string, path string, size long, patient_id string, recording_id string, n_records long, n_signals long, duration_sec double, error string")
    return out.orderBy(F.lower("name"), "name")


def encode(values: np.ndarray, signal: dict[str, str]) -> np.ndarray:
    """Digital samples, rounded half away from zero and clipped to the digital limits."""
    gain, offset = scale(signal)
    x = (np.asarray(values, float) - offset) / gain
    x = np.sign(x) * np.floor(np.abs(x) + 0.5)
    return np.clip(x, float(signal["digital_min"]), float(signal["digital_max"])).astype("<i2")


def content(header: Header, signals: list[np.ndarray]) -> bytes:
    """A whole file from one value array per signal."""
    parts = [encode(x, s).reshape(header.records, n) for x, s, n in zip(signals, header.signals, header.samples)]
    return header.bytes() + np.concatenate(parts, axis=1).tobytes()


def write(blocks: DataFrame, headers: dict[str, Header] | Header, target: str) -> DataFrame:
    """Write each recording of blocks (recording, channel, block_id, values) to target/<name>; recording, path, bytes, of what was written.

    One task writes a recording, block by block, to a temporary name that takes the final one when complete, so a repeated task does no harm.
    headers: by recording, or one for all.
    """

    def save(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name = key[0]
        h = headers if isinstance(headers, Header) else headers[name]
        labels = [s["label"].strip() for s in h.signals]
        store, into = at_store(target)
        path = f"{into}/{re.sub(r'[.]edf$', '', name, flags=re.I)}_aligned.edf"
        temporary = f"{path}.{os.getpid()}.tmp"
        store.create_dir(into, recursive=True)
        with store.open_output_stream(temporary) as f:
            f.write(h.bytes())
            for _, record in pdf.groupby("block_id", sort=True):
                by = dict(zip(record["channel"], record["values"]))
                for label, s in zip(labels, h.signals):
                    f.write(encode(by[label], s).tobytes())
        store.move(temporary, path)
        return pd.DataFrame({"recording": [name], "path": [path], "bytes": [store.get_file_info(path).size]})

    return blocks.select("recording", "channel", "block_id", "values").groupBy("recording").applyInPandas(save, "recording string, path string, bytes long")
