"""Two recordings of one schedule through all steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lockstep.errors import AlignmentError
from lockstep.operators import montage, triggers
from lockstep.plans.align import RecordingPair, align

LEVEL = {code: (low + high) / 2 for code, low, high in triggers.BANDS}
TYPES = ["64"] * 4 + ["63"] * 46
GAPS = 0.3 + 0.01 * np.arange(50)
TIMES = np.concatenate([[0], np.cumsum(GAPS)])[:50]
CYCLE, START = float(GAPS.sum()), 8.0
HEADERS = "recording_id long, channel string, unit string, samples_in_record int, physical_min double, physical_max double, digital_min double, digital_max double"


def recording(spark, cycles=3, stray=False, lead=True, gap=False, loud=False, bad=False):
    """A pair whose EEG clock starts a second late; a tone of 10 Hz on one electrode, levels on the clinical mastoids."""
    times = np.concatenate([START + CYCLE * k + TIMES for k in range(cycles)])
    types = TYPES * cycles
    total = times[-1] + 2
    n = int(total * 128)
    volts = np.zeros(n)
    for code, t in list(zip(triggers.RAW_VALIDATION, 1 + 0.3 * np.arange(7))) + list(zip(types, times)):
        at = int(round(t * 128))
        volts[at : at + 6] = LEVEL[code]
    events = [(i + 1, 100 + i * 10, c if lead or i != 3 else "63") for i, c in enumerate(triggers.VALIDATION)]
    late = lambda i: -100 if gap and i > 59 else 0  # noqa: E731  (the amplifier lost 0.2 s)
    events += [(10 + i, int(round((t - 1) * 500)) + 1 + late(i), c + ",x") for i, (t, c) in enumerate(zip(times, types))]
    if stray:
        events.append((5000, int(total * 500), "99"))
    if gap:
        a, b = events[7 + 59][1], events[7 + 60][1]
        events += [(69, a + 5, "9001, off"), (69, b - 5, "9002, on")]
        events = sorted(events, key=lambda e: e[1])
        events = [(i + 1, e, c) for i, (_, e, c) in enumerate(events)]
    eeg_n = int((total - 1) * 500)
    ids = spark.range(1).select(F.lit(1).cast("long").alias("recording_id"))
    samples = lambda n: ids.withColumn("sample", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))))
    moved = f"IF(sample > {events[7 + 59][1] if gap else 10**12}, 100, 0)"
    value = F.when(F.col("channel") == "L1", 50 * F.sin(2 * np.pi * 10 * (F.expr(f"sample - 1 + {moved}") / 500 + 1))).otherwise(0.0)
    eeg = samples(eeg_n).withColumn("channel", F.explode(F.array(*map(F.lit, montage.ELECTRODES.values())))).withColumn("value", value)
    level = F.when(F.col("channel") == "M2", 5000.0 if loud else 7.0).otherwise(3.0)
    clinical = samples(2 * n).withColumn("channel", F.explode(F.array(*map(F.lit, montage.OUTPUT)))).withColumn("value", level)
    if bad:
        clinical = clinical.withColumn("value", F.when((F.col("sample") == 1) & (F.col("channel") == "E1"), float("nan")).otherwise(F.col("value")))
    trace = spark.createDataFrame([(1, i + 1, float(v)) for i, v in enumerate(volts)], "recording_id long, sample long, volts double")
    rows = spark.createDataFrame([(1, i, e, t) for i, e, t in events], "recording_id long, event_index long, latency long, type string")
    headers = spark.createDataFrame([(1, c, "uV", 256, -400.0, 400.0, -32768.0, 32767.0) for c in montage.OUTPUT], HEADERS)
    return RecordingPair(rows, trace, eeg, clinical, headers), times


def test_whole(spark):
    pair, times = recording(spark)
    got = align(pair)
    assert got["errors"].collect() == []
    (s,) = got["segments"].collect()
    assert (s.eeg_start_sample, s.edf_start_sample, s.error) == (int((START - 1) * 500) + 1, int(START * 128) + 1, None)
    (up,) = got["startup"].collect()
    assert (up.validations, up.before_last) == (1, 0)
    out = got["output"].where("channel in ('Fp1', 'M2', 'E1')").toPandas()
    x = out[out.channel == "Fp1"].sort_values("sample")
    middle = x[x["sample"].between((s.edf_start_sample + s.edf_end_sample) - 2000, (s.edf_start_sample + s.edf_end_sample) + 2000)]
    # The segment's first and last samples are where the triggers fell on both clocks.
    step = (s.eeg_end_sample - s.eeg_start_sample) / (2 * (s.edf_end_sample - s.edf_start_sample))
    second = ((s.eeg_start_sample - 1) + (middle["sample"].to_numpy() - 1 - 2 * (s.edf_start_sample - 1)) * step) / 500 + 1
    assert np.abs(middle["value"].to_numpy() - 7 - 50 * np.sin(2 * np.pi * 10 * second)).max() < 0.05
    assert (x[~x.matched]["value"] == 7.0).all() and (out[out.channel == "E1"].value == 3.0).all()
    covered = 2 * (s.edf_end_sample - s.edf_start_sample) + 1
    (c,) = got["coverage"].collect()
    assert c.matched == covered == int(x.matched.sum()) and c.total == len(x) and c.coverage_percent == pytest.approx(100 * covered / len(x))
    assert {(r.channel, r.fails, r.n_bad) for r in got["bounds"].collect()} == {(c, False, 0) for c in montage.OUTPUT}


def test_an_interruption_parts_segments(spark):
    pair, _ = recording(spark, cycles=4, gap=True)
    got = align(pair)
    assert [r.error for r in got["segments"].collect()] == [None, None]
    a, b = sorted(got["segments"].collect(), key=lambda r: r.segment_index)
    gap = got["interruptions"].collect()
    assert len(gap) == 1 and a.eeg_end_sample <= gap[0].disconnect_latency and b.eeg_start_sample >= gap[0].reconnect_latency


def test_contracts(spark):
    errors = lambda pair, step: [r.error for r in align(pair)["errors"].where(f"step = '{step}'").collect()]
    assert errors(recording(spark, stray=True)[0], "eeg_events") == ["extract_triggers:UnexpectedEEGEventType"]
    assert errors(recording(spark, lead=False)[0], "eeg_events") == ["extract_triggers:InvalidLeadingValidation"]
    assert errors(recording(spark, bad=True)[0], "bounds") == ["substitute_eeg_data:NonfiniteSignalData"]
    pair, _ = recording(spark)
    short = RecordingPair(pair.eeg_events, pair.trace.where("sample > 1"), pair.eeg, pair.clinical, pair.headers)
    assert errors(short, "inputs") == ["align_recordings:LengthRatio"]
    with pytest.raises(AlignmentError, match="UnexpectedRate"):
        align(RecordingPair(pair.eeg_events, pair.trace, pair.eeg, pair.clinical, eeg_rate=512.0))


def test_fault_inputs(spark):
    mask = spark.createDataFrame([(i, s, i != 3) for i in range(1, 7) for s in (1, 2)], "recording_id long, sample long, matched boolean")
    rows = [(i, c, s, float("nan") if i == 2 and s == 1 else 1.0) for i in range(1, 7) for c in ("M1", "M2") for s in (1, 2) if (i, c) != (4, "M1") and (i, c, s) != (5, "M2", 2)]
    clinical = spark.createDataFrame(rows, "recording_id long, channel string, sample long, value double")
    headers = spark.createDataFrame([(i, c, "mV" if i == 6 else "uV", 256) for i in range(1, 7) for c in ("M1", "M2")], "recording_id long, channel string, unit string, samples_in_record int")
    got = {r.recording_id: r.error.split(":")[1] for r in montage.fault_inputs(clinical, mask, headers).collect()}
    assert got == {2: "NonfiniteMatchedSamples", 3: "NoMatchedSamples", 4: "MissingEdfChannel", 5: "MaskLengthMismatch", 6: "InvalidPhysicalDimension"}


def test_faulty_mastoids(spark):
    pair, _ = recording(spark, loud=True)
    got = align(pair)
    assert got["faults"].collect()[0].faulty
    assert {r.derivation for r in got["output"].select("derivation").distinct().collect()} == {f"aligned {c}" for c in montage.FAULTY.values()}


def test_steps_are_saved_and_told(spark, tmp_path):
    from lockstep.plans import steps

    pair, _ = recording(spark, bad=True)
    got = align(pair)
    told = {r.step: r for r in steps.save(pair, got, str(tmp_path)).collect()}
    assert [told[s].step_number for s in steps.STEPS] == list(range(1, 11))
    for number, name in enumerate(steps.STEPS, 1):
        kept = spark.read.parquet(f"{tmp_path}/{number:02d}_{name}")
        assert told[name].rows == kept.count() and told[name].recordings == kept.select("recording_id").distinct().count()
    assert told["output"].rows == 0 and told["saved"].flagged == told["saved"].rows > 0 and told["checks"].flagged > 0 and told["resampled"].rows > 0
