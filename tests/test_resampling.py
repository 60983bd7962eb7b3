"""Blocks of samples give what a whole channel gives."""

import numpy as np
import pandas as pd
import pytest

from lockstep.functions import cascade, dsp
from lockstep.operators import resampling

RATE, RATIO = 128, 2


def whole(x, eeg, span, filtered=True, native=False):
    rate = eeg / (span / RATE)
    x = x - x.mean()
    x = dsp.highpass(x, rate) if filtered else x
    return dsp.resample(x[None], 1.0 if native else eeg / (span * RATIO), eeg + 1 if native else span * RATIO + 1, dsp.kaiser_plan(rate))[0]


def case(spark):
    rng = np.random.default_rng(4)
    spans = {(1, 1): (41000, 10490), (1, 2): (900, 230), (2, 1): (4096, 1049), (2, 2): (1500, 384)}
    rows, segments, values = [], [], {}
    for (r, s), (eeg, span) in spans.items():
        start = 1000 * s
        segments.append((r, s, start, start + eeg, 1, 1 + span))
        for c in ("C3", "M1"):
            x = np.cumsum(rng.normal(size=eeg + 1)) * 5 + 1e4 * r
            values[r, s, c] = x
            rows.append(pd.DataFrame({"recording_id": r, "segment_index": s, "channel": c, "sample": np.arange(start, start + eeg + 1), "value": x}))
    samples = spark.createDataFrame(pd.concat(rows).sample(frac=1, random_state=1)).repartition(3)
    told = spark.createDataFrame(segments, "recording_id long, segment_index long, eeg_start_sample long, eeg_end_sample long, edf_start_sample long, edf_end_sample long")
    return spans, values, samples, told


@pytest.mark.parametrize("filtered, native", [(True, False), (False, False), (True, True)])
def test_blocks_give_the_whole_channels_values(spark, filtered, native):
    spans, values, samples, told = case(spark)
    got = (resampling.antialiased(samples, told, RATE, filtered, 2048) if native else resampling.resample_blocks(samples, told, RATE, RATIO, filtered, 2048)).toPandas()
    for (r, s, c), x in values.items():
        one = got[(got.recording_id == r) & (got.segment_index == s) & (got.channel == c)].sort_values("sample")
        want = whole(x, *spans[r, s], filtered, native)
        assert one["sample"].tolist() == list(range(1, len(want) + 1))
        assert np.abs(one["value"].to_numpy() - want).max() < 1e-9 * np.abs(x - x.mean()).max()


def test_a_long_channel_is_never_in_one_task(spark):
    _, _, samples, told = case(spark)
    rows = resampling.with_halo(resampling.highpassed(resampling.blocked(samples, told, 2048), RATE, 2048), 512)
    sizes = rows.selectExpr("size(body) AS n", "size(left) AS l", "size(right) AS r").toPandas()
    assert sizes.n.max() == 2048 and sizes.l.max() <= 512 and sizes.r.max() <= 512 and len(sizes) == 2 * (21 + 1 + 3 + 1)


def test_lengths_that_do_not_fit_are_errors(spark):
    _, _, samples, told = case(spark)
    lost = samples.where("not (recording_id = 1 and segment_index = 2 and channel = 'M1' and sample = 2500) and not (recording_id = 2 and segment_index = 1) and not (recording_id = 2 and channel = 'C3')")
    got = {(r.recording_id, r.segment_index): r.error.split(":")[1] for r in resampling.length_problems(lost, told, 2).collect()}
    assert got == {(1, 2): "UnexpectedEegSegmentLength", (2, 1): "SegmentCountMismatch", (2, 2): "ChannelCountMismatch"}
    left = {(r.recording_id, r.segment_index, r.channel) for r in resampling.resample_blocks(lost, told, RATE, RATIO, True, 2048).select("recording_id", "segment_index", "channel").distinct().collect()}
    assert left == {(1, 1, "C3"), (1, 1, "M1"), (1, 2, "C3"), (2, 2, "M1")}


@pytest.mark.parametrize("rate", [500.0, 499.3, 7800.0])
def test_summaries_compose(rate):
    rng = np.random.default_rng(2)
    x = rng.normal(size=3000)
    f = cascade.highpass(rate)
    whole_run, after = f.run(x, np.zeros(len(f.b)))
    first, state = f.run(x[:1100], np.zeros(len(f.b)))
    end, _, last = f.summary(x[1100:])
    maps = f.maps(1900)
    assert np.allclose(maps[0] @ state + end, after, atol=1e-9) and np.isclose(maps[2] @ state + last, whole_run[-1], atol=1e-10)
    assert np.allclose(f.run(np.full(500, 3.0), f.steady(3.0))[0], 0, atol=1e-12)


def test_rational_steps_against_the_whole_recording(spark):
    rng = np.random.default_rng(9)
    plan = dsp.kaiser_plan(500)
    data = {k: rng.normal(size=n) for k, n in enumerate([5000, 1025, 1024, 900, 200, 2, 1])}
    rows = [(k, i + 1, float(v)) for k, x in data.items() for i, v in enumerate(x)]
    samples = spark.createDataFrame(rows, "recording_id long, source long, value double").repartition(5)
    got = resampling.resample_rational(samples, 64, 125, plan)
    found = got.toPandas()
    for k, x in data.items():
        one = found[found.recording_id == k].sort_values("k")
        count = int((len(x) - 1) * 64 / 125) + 1
        want = dsp.resample(x[None], 125 / 64, count, plan)[0]
        assert one.k.tolist() == list(range(count)) and np.abs(one["value"].to_numpy() - want).max() < 1e-12
    plan_text = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan_text and "BroadcastNestedLoopJoin" not in plan_text
    assert resampling.phase_weights(spark, 64, 125, plan).count() == 64


def test_frames_are_bounded_by_bytes():
    import numpy as np
    import pyarrow as pa

    from lockstep.operators import resampling

    values = pa.ListArray.from_arrays(pa.array(np.arange(0, 2_000_001, 2000), pa.int32()), pa.array(np.zeros(2_000_000)))
    frames = list(resampling._parts([pa.RecordBatch.from_arrays([pa.array(np.arange(1000)), values], ["block", "body"])]))
    assert [k for f in frames for k in f["block"]] == list(range(1000))
    assert max(sum(x.nbytes for x in f["body"]) for f in frames) <= resampling.PART
