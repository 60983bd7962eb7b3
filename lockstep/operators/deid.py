"""De-identification: header checks, identifiers, patient fields, batch rules, and the file replacement itself."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import AlignmentError, require
from ..sources import edf

STUDY_ID = r"^[A-Za-z0-9][A-Za-z0-9_-]{0,39}$"
# Names that Windows reserves.
RESERVED = ("CON", "PRN", "AUX", "NUL", *(f"COM{i}" for i in range(1, 10)), *(f"LPT{i}" for i in range(1, 10)))
FIELD = slice(8, 88)
CHUNK = 4 << 20


def study_id_ok(name: Column) -> Column:
    return F.coalesce(F.rlike(name, F.lit(STUDY_ID)) & ~F.upper(name).isin(*RESERVED), F.lit(False))


def automatic_id(recording_id: Column) -> Column:
    """The third word of a local recording field that begins with Startdate; null otherwise."""
    words = F.split(F.trim(recording_id), " +")
    return F.when((words[0] == "Startdate") & (F.size(words) >= 3), words[2])


def patient_field(auto: Column, study: Column) -> Column:
    """The 80 characters of the new patient field; null if they do not fit."""
    text = F.concat(auto, F.lit(" X 01-JAN-1999 "), study)
    return F.when(F.octet_length(text) <= 80, F.rpad(text, 80, " "))


def header_reasons(headers: DataFrame) -> DataFrame:
    """headers (name, head, size) with the first reason why the fixed header is not valid.

    head is the text of the first 256 characters.
    """
    at = lambda a, n: F.trim(F.substring("head", a + 1, n))
    integer = lambda c: F.when(F.rlike(c, F.lit(r"^-?[0-9]+$")), c.cast("long"))
    n, records, size, duration = integer(at(252, 4)), integer(at(236, 8)), integer(at(184, 8)), F.expr("try_cast(trim(substring(head, 245, 8)) AS double)")
    reason = (
        F.when(F.rlike("head", F.lit("[^\\x20-\\x7e]")), "NonAsciiField").when(at(0, 8) != "0", "UnsupportedVersion").when(n.isNull() | records.isNull() | size.isNull() | duration.isNull(), "InvalidNumber")
        .when(records == -1, "UnknownRecordCount").when(records < 0, "InvalidRecordCount").when(~(duration > 0), "InvalidRecordDuration").when(n <= 0, "NoSignals").when(size != 256 * (n + 1), "HeaderSizeMismatch")
    )
    return headers.select("name", n.alias("n_signals"), records.alias("n_records"), duration.alias("record_duration"), at(8, 80).alias("patient_id"), at(88, 80).alias("recording_id"), reason.alias("reason"))


def unchanged_hash(content: Column) -> Column:
    """SHA-256 of all bytes but the patient field."""
    return F.sha2(F.concat(F.substring(content, 1, 8), F.substring(content, 89, 2147483647)), 256)


def preflight(jobs: DataFrame, existing: DataFrame) -> DataFrame:
    """All problems of a batch: job_id, issue.

    jobs: job_id, folder, source, study_id, target, error; existing: folder, name. Names compare without case; of the
    names in a folder only the source's own, letter by letter, does not stand in its target's way.
    """
    low = lambda c: F.lower(c)
    repeated = lambda c, issue: jobs.withColumn("n", F.count("*").over(Window.partitionBy("folder", low(F.col(c))))).where("n > 1").select("job_id", F.lit(issue).alias("issue"))
    have = existing.select("folder", low(F.col("name")).alias("low"), "name").alias("e")
    j = jobs.alias("j")
    clash = j.join(have, (F.col("j.folder") == F.col("e.folder")) & (low(F.col("j.target")) == F.col("e.low")) & (F.col("j.source") != F.col("e.name"))).select("j.job_id", F.lit("target_exists").alias("issue")).distinct()
    recovery = j.join(existing.where(F.rlike(F.col("name"), F.lit(r"^\.deid-recovery-"))).groupBy("folder").agg(F.min("name").alias("first")).alias("r"), "folder").select("job_id", F.lit("unresolved_recovery").alias("issue"))
    parts = [repeated("source", "duplicate_source"), repeated("target", "duplicate_target"), clash, recovery, jobs.where(~study_id_ok(F.col("study_id"))).select("job_id", F.lit("invalid_study_id").alias("issue")), jobs.where("error is not null").select("job_id", F.lit("invalid_header").alias("issue"))]
    several = jobs.select("folder").distinct().count() > 1
    if several:
        parts.append(jobs.select("job_id", F.lit("several_folders").alias("issue")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def batch_issues(batches: DataFrame, jobs: DataFrame, folders: DataFrame) -> DataFrame:
    """Problems of whole batches: batch, issue.

    batches: batch; jobs: batch, folder, size; folders: folder, free (bytes, null where it cannot be told). A batch needs as much room as its
    largest file, since one copy exists at a time. Room is looked at in batches of one folder only.
    """
    told = jobs.groupBy("batch").agg(F.min("folder").alias("folder"), (F.min("folder") != F.max("folder")).alias("several"), F.max("size").alias("need"))
    j = batches.join(told, "batch", "left").join(folders.withColumn("known", F.lit(True)), "folder", "left")
    one = ~F.col("several") & F.col("known")
    rules = [("empty_batch", F.col("several").isNull()), ("several_folders", F.col("several")), ("unknown_space", one & F.col("free").isNull()), ("insufficient_space", one & (F.col("free") < F.col("need")))]
    found = F.array(*(F.when(c, F.lit(name)) for name, c in rules))
    return j.select("batch", F.explode(F.array_compact(found)).alias("issue"))


def batch_status(steps: DataFrame, keys: list[str]) -> DataFrame:
    """Final status of each step of a batch that stops at its first failure or cancellation; what follows stays untouched."""
    stop = F.min(F.when(F.col("result").isin("failed", "cancelled"), F.col("position"))).over(Window.partitionBy(*keys))
    return steps.withColumn("stop", stop).withColumn("status", F.when(F.col("position") > F.col("stop"), "untouched").otherwise(F.col("result"))).drop("stop")


# The side effect, one file at a time.


@dataclass
class FileResult:
    source: str
    target: str
    status: str
    error: str | None = None


class Cancelled(Exception):
    pass


def make_field(auto: str, study: str) -> bytes:
    require(bool(re.match(STUDY_ID, study)) and study.upper() not in RESERVED, "deid:InvalidStudyId", study)
    text = f"{auto} X 01-JAN-1999 {study}".encode("ascii")
    require(len(text) <= 80, "deid:PatientFieldTooLong")
    return text.ljust(80)


def _digest(path: str) -> tuple[str, bytes]:
    """Hash of all bytes but the patient field, and that field."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        first = f.read(256)
        h.update(first[: FIELD.start] + first[FIELD.stop :])
        while part := f.read(CHUNK):
            h.update(part)
    return h.hexdigest(), first[FIELD]


def _signature(path: str):
    s = os.stat(path, follow_symlinks=False)
    return s.st_size, s.st_mtime_ns, s.st_dev, s.st_ino


def _move(path: str, to: str) -> None:
    """Rename without ever replacing: fails if the new name is taken."""
    os.link(path, to, follow_symlinks=False)
    os.unlink(path)


def _sync(folder: str) -> None:
    handle = os.open(folder, os.O_RDONLY)
    try:
        os.fsync(handle)
    finally:
        os.close(handle)


def _retire(source: str, before: tuple, digest: str, target: str, published: tuple) -> None:
    """Remove the source once its bytes are known to be in the published file.

    It first gets a name of its own aside, where no other writer looks for it. If it or the published file is not what was verified, it
    gets its name back, and the published file goes if it still is the one that was put there.
    """
    aside = os.path.join(os.path.dirname(source), f".deid-{os.getpid()}-{uuid.uuid4().hex}.aside")
    _move(source, aside)
    try:
        _sync(os.path.dirname(source))
        require(_signature(aside) == before and _digest(aside)[0] == digest, "deid:SourceChanged")
        require(_signature(target) == published and _digest(target)[0] == digest, "deid:OutputChanged")
    except (AlignmentError, OSError):
        _move(aside, source)  # where its name was taken meanwhile, it stays aside and the error names that
        if os.path.exists(target) and _signature(target) == published:
            os.unlink(target)
        raise
    os.unlink(aside)
    _sync(os.path.dirname(source))


def deidentify(source: str, study: str, cancel: Callable[[], bool] = lambda: False) -> FileResult:
    """Replace a file by <study>.edf in its folder, with a new patient field and all other bytes as they were.

    The copy is written and read back before it takes the final name, which must be free. The source then goes aside, both
    are verified again, and only then it is removed. On failure or cancellation the folder is as before.
    """
    folder = os.path.dirname(source)
    target, temporary = os.path.join(folder, f"{study}.edf"), os.path.join(folder, f".deid-{os.getpid()}-{study}.tmp")
    try:
        require(not os.path.islink(source) and os.path.isfile(source), "deid:NotARegularFile")
        before = _signature(source)
        with open(source, "rb") as f:
            first = f.read(256)
            header = edf.parse(first + f.read(256 * int(first[252:256])), before[0])
        words = header.fields["recording_id"].split()
        require(len(words) >= 3 and words[0] == "Startdate", "deid:MissingAutomaticId")
        field = make_field(words[2], study)
        with open(source, "rb") as f, open(temporary, "xb") as out:
            while part := f.read(CHUNK):
                if cancel():
                    raise Cancelled
                out.write(part)
            out.seek(FIELD.start)
            out.write(field)
            out.flush()
            os.fsync(out.fileno())
        digest = _digest(source)[0]
        require(_digest(temporary) == (digest, field), "deid:VerificationFailed")
        require(_signature(source) == before, "deid:SourceChanged")
        s = os.stat(source)
        os.chmod(temporary, s.st_mode & 0o7777)
        os.utime(temporary, ns=(s.st_atime_ns, s.st_mtime_ns))
        if cancel():
            raise Cancelled
        # Only the source's own entry may be replaced: another one, even a hard link of it, is somebody's file.
        own, wanted = os.path.basename(source), os.path.basename(target).casefold()
        require(not any(name.casefold() == wanted and name != own for name in os.listdir(folder or ".")), "deid:TargetExists")
        if os.path.exists(target):
            os.replace(temporary, target)
        else:
            published = _signature(temporary)
            _move(temporary, target)
            _retire(source, before, digest, target, published)
        return FileResult(source, target, "completed")
    except Cancelled:
        status, error = "cancelled", None
    except (AlignmentError, OSError, ValueError) as e:
        status, error = "failed", getattr(e, "identifier", str(e))
    finally:
        if os.path.exists(temporary):
            os.unlink(temporary)
    return FileResult(source, target, status, error)


def process(jobs: list[tuple[str, str]], cancel: Callable[[], bool] = lambda: False) -> list[FileResult]:
    """Jobs (source, study id) one after another; after a failure or cancellation the rest is untouched."""
    out, stopped = [], False
    for source, study in jobs:
        if stopped:
            out.append(FileResult(source, "", "untouched"))
            continue
        r = deidentify(source, study, cancel)
        out.append(r)
        stopped = r.status != "completed"
    return out
