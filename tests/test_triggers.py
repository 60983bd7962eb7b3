"""Trigger extraction and cycle consensus on small recordings with known results."""

import pytest

from lockstep.operators import cycle, segments, triggers

VOLTS = {"1": 5.5, "2": 11.5, "4": 18.5, "8": 24.5, "16": 30.5, "32": 36.5, "63": 36.5, "64": 42.5}


def trace(spark, codes, width=3):
    rows = [(1, 5 + 10 * k + w, VOLTS[c]) for k, c in enumerate(codes) for w in range(width)]
    rows += [(1, s, 0.0) for s in range(1, 10 * len(codes) + 10) if (1, s) not in {r[:2] for r in rows}]
    return spark.createDataFrame(rows, "recording_id long, sample long, volts double")


def numbered(found):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    return found.withColumn("event_index", F.row_number().over(Window.partitionBy("recording_id").orderBy("latency")))


def test_two_validations(spark):
    codes = [*triggers.RAW_VALIDATION, *["64"] * 4, *["63"] * 3, *triggers.RAW_VALIDATION, *["64"] * 4, *["63"] * 6]
    events = triggers.relabel(numbered(triggers.pulses(trace(spark, codes))))
    found = triggers.validation_sequences(events).orderBy("start_latency").collect()
    assert [(r.start_latency, r.end_latency, r.is_authoritative) for r in found] == [(5, 65, False), (145, 205, True)]
    kept = triggers.clean_triggers(numbered(triggers.pulses(trace(spark, codes)))).orderBy("event_index").collect()
    assert [r.type for r in kept] == ["64"] * 4 + ["63"] * 3 + ["64"] * 4 + ["63"] * 6
    assert sum(r.latency < 145 for r in kept) == 7


def test_merged_pulse_is_split(spark):
    rows = [(1, s, v) for s, v in enumerate([0, 36.5, 36.5, 36.5, 39, 42.5, 42.5, 42.5, 0, 42.5, 42.5, 42.5, 36.5, 36.5, 36.5, 0, 36.5, 36.5, 42.5, 42.5, 42.5, 0], 1)]
    got = triggers.split_pulses(spark.createDataFrame([(a, b, float(c)) for a, b, c in rows], "recording_id long, sample long, volts double"))
    assert sorted((r.latency, r.end) for r in got.collect()) == [(2, 4), (6, 8), (10, 15), (17, 21)]


@pytest.mark.parametrize("markers, anchors, status", [([(2501, "9001"), (2601, "9002")], (2, 3), "paired"), ([(2001, "9001"), (4001, "9002")], (2, 4), "paired"), ([(8501, "9001")], (8, None), "missing_reconnect")])
def test_anchors(spark, markers, anchors, status):
    m = spark.createDataFrame([(1, i + 1, t, c) for i, (t, c) in enumerate(markers)], "recording_id long, raw_event_index long, latency long, code string")
    t = spark.createDataFrame([(1, k, 1000 * k + 1) for k in range(1, 11)], "recording_id long, event_index long, latency long")
    (r,) = triggers.interruption_anchors(triggers.amplifier_pairs(m), t).collect()
    assert (r.eeg_start_anchor_event_index, r.eeg_end_anchor_event_index, r.pairing_status, r.problem) == (*anchors, status, None)


def schedule(spark, shift=None):
    times = []
    for c in range(8):
        offsets = [0, 1, 2, 3, 10, 20, 35, 50]
        if c == 0:
            offsets.remove(35)
        times += [(60 * c + o, "63" if o > 3 else "64") for o in offsets if not (c == 4 and o <= 3)]
    rows = [(1, k + 1, t * 1000 + 1 + (shift or {}).get(k, 0), x) for k, (t, x) in enumerate(times)]
    return spark.createDataFrame(rows, "recording_id long, event_index long, latency long, type string")


def test_consensus(spark):
    shapes = cycle.shapes(cycle.chunks(schedule(spark), 1000))
    canon = cycle.canonical(shapes, 0.002)
    c = canon.orderBy("position").collect()
    assert [r.relative_time_sec for r in c] == [-10, -9, -8, -7, 0, 10, 25, 40]
    assert [r.interval_to_next_sec for r in c] == [1, 1, 1, 7, 10, 15, 15, 10]
    report = cycle.report(shapes, canon, 0.002).orderBy("chunk_index").collect()
    assert [r.status for r in report] == ["mismatch", "match", "match", "ambiguous", "match", "match", "partial_end"]


@pytest.mark.parametrize("by, status", [(2, "match"), (3, "mismatch")])
def test_consensus_tolerance(spark, by, status):
    shapes = cycle.shapes(cycle.chunks(schedule(spark, {12: by}), 1000))
    report = cycle.report(shapes, cycle.canonical(shapes, 0.002), 0.002).orderBy("chunk_index").collect()
    assert report[1].status == status and (status == "match" or report[1].reason == "interval_timing")


def test_exclusion_of_open_gaps(spark):
    p = spark.createDataFrame([(1, k) for k in range(10)], "recording_id long, source_event_index long")
    left = lambda a, b: [r.source_event_index for r in segments.excluded(p, spark.createDataFrame([(1, a, b)], "recording_id long, start long, end long")).orderBy("source_event_index").collect()]
    assert left(None, None) == [] and left(None, 4) == [4, 5, 6, 7, 8, 9] and left(7, None) == [0, 1, 2, 3, 4, 5, 6]
    assert left(3, 5) == [0, 1, 2, 5, 6, 7, 8, 9] and left(3, 3) == [0, 1, 2, 4, 5, 6, 7, 8, 9]
