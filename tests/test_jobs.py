"""The jobs on given tables against their SQL, over growing input, and run again."""

import hashlib
import logging

import pytest

from jobs import deidentify_records, recording_quality
from jobs import queries as jobs
from jobs.common import config_of
from oracle import DATA, compare


@pytest.mark.parametrize("name", sorted(jobs.queries()))
def test_rows(spark, name):
    assert compare(spark, jobs.queries()[name], jobs.oracle_sql()[name]) > 0


RECORDS = "doc_id long, text string, lang string, source string"
HEAD = "0       " + "someone".ljust(80) + "x" * 200


def deliver(spark, rows, folder, name):
    spark.createDataFrame(rows, RECORDS).coalesce(1).write.parquet(f"{folder}/{name}")


def account(spark, folder):
    rows = spark.read.schema(deidentify_records.SCHEMA).parquet(f"{folder}/out").collect()
    return sorted((r.record_id is not None, r.record_id, r.batch, r.status, r.reason or "") for r in rows), rows


def test_only_new_records_are_taken(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO)
    go = lambda: deidentify_records.run(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    deliver(spark, [(1, HEAD + "one", "en", "a"), (2, "short", "en", None), (3, None, "en", ""), (4, HEAD.replace("someone", "jemänd "), "de", "b"), (None, HEAD, "en", "a"), (5, HEAD, "en", "a"), (5, HEAD + "2", "en", "a")], f"{tmp_path}/in", "first")
    go()
    first = [(False, None, 0, "rejected", "InvalidStudyId")] + [(True, i, 0, s, r) for i, s, r in [(1, "completed", ""), (2, "rejected", "TooShort"), (3, "rejected", "NoContent"), (4, "rejected", "NonAsciiField"), (5, "rejected", "duplicate_target"), (5, "rejected", "duplicate_target")]]
    told, rows = account(spark, tmp_path)
    assert told == first
    new = HEAD[:8] + "AUTO X 01-JAN-1999 corpus_1".ljust(80) + HEAD[88:] + "one"
    done = next(r for r in rows if r.record_id == 1)
    assert bytes(done.content).decode() == new and done.content_sha256 == hashlib.sha256(new.encode()).hexdigest() and done.source == "a"
    assert {r.source for r in rows} == {"a", "b", None, ""}
    go()
    assert account(spark, tmp_path)[0] == first
    deliver(spark, [(1, HEAD + "again", "en", "a"), (6, HEAD, "en", "c")], f"{tmp_path}/in", "second")
    go()
    assert account(spark, tmp_path)[0] == sorted([*first, (True, 1, 1, "rejected", "target_exists"), (True, 6, 1, "completed", "")])
    assert "read 2 new records" in caplog.text and "wrote 1 records" in caplog.text


def test_a_batch_that_failed_is_taken_again(spark, tmp_path, monkeypatch):
    deliver(spark, [(1, HEAD, "en", "a")], f"{tmp_path}/in", "first")
    go = lambda: deidentify_records.run(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    with monkeypatch.context() as m:
        m.setattr(deidentify_records.log, "info", lambda *_: 1 / 0)  # after the batch's rows are written
        with pytest.raises(Exception):
            go()
    go()
    assert account(spark, tmp_path)[0] == [(True, 1, 0, "completed", "")]


def test_nights_of_the_input_are_replaced_and_others_stay(spark, tmp_path):
    e = spark.read.parquet(f"{DATA}/events.parquet")
    config = config_of("recording_quality") | {"recording_id": "event_id div 100", "sample": "event_id % 100 + 1"}
    read = lambda: sorted(map(tuple, spark.read.schema(recording_quality.SCHEMA).parquet(f"{tmp_path}/out").collect()), key=str)
    e.where("event_id < 500").write.parquet(f"{tmp_path}/a")
    e.where("event_id >= 300 and event_id not in (355, 356)").write.parquet(f"{tmp_path}/b")
    recording_quality.run(spark, f"{tmp_path}/a", f"{tmp_path}/out", config)
    before = read()
    recording_quality.run(spark, f"{tmp_path}/a", f"{tmp_path}/out", config)
    assert read() == before and len(before) == 5
    recording_quality.run(spark, f"{tmp_path}/b", f"{tmp_path}/out", config)
    after = read()
    nights = {r[-1] for r in after if r[0] >= 3}
    assert [r for r in before if r[-1] not in nights] == [r for r in after if r[-1] not in nights] and len(after) > len(before)
    assert next(r for r in after if r[0] == 3)[2] == 2 and next(r for r in after if r[0] == 3)[-2] == "samples_missing"


def test_recordings_without_pulses_are_told(spark):
    rows = spark.createDataFrame([(1, s, 0.2, None) for s in range(1, 5)] + [(2, 1, 36.5, None)], "recording_id long, sample long, volts double, time timestamp")
    got = {r.recording_id: (r.n_pulses, r.n_split, r.longest, r.verdict, r.night) for r in recording_quality.quality(rows, config_of("recording_quality")).collect()}
    assert got == {1: (0, 0, None, "no_pulses", None), 2: (1, 0, 1, "usable", None)}
