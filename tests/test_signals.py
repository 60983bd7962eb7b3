"""Signal processing, EDF files, de-identification, and the whole alignment on a short cut of the data."""

import os

import numpy as np
import pytest

from lockstep.errors import AlignmentError
from lockstep.functions import dsp
from lockstep.operators import deid, montage
from lockstep.sources import edf


def test_kernel():
    order, beta, cutoff = dsp.kaiser_plan(500)
    assert order + 1 == 315
    t = np.arange(-(order // 2), order // 2 + 1)
    w = dsp.kernel(t, order, beta, cutoff)
    gain = lambda f: abs((w * np.exp(-2j * np.pi * f / 500 * t)).sum())
    assert 0.999 < gain(120) < 1.001 and all(gain(f) <= 1.2e-4 for f in (128, 128.3, 180))
    with pytest.raises(AlignmentError):
        dsp.kaiser_plan(200)


@pytest.mark.parametrize("frequency, low, high", [(0.15, 0, 1.05e-4), (0.30, 0.9943, 1.0058), (10, 0.9943, 1.0058)])
def test_highpass(frequency, low, high):
    n = 240 * 500
    x = np.sin(2 * np.pi * frequency * np.arange(n) / 500)
    y = dsp.highpass(x[None], 500)[0][80 * 500 : 160 * 500]
    assert low <= np.sqrt(2 * (y**2).mean()) <= high


def test_offsets_vanish():
    assert np.abs(dsp.highpass(np.array([[1e9], [-2e9]]) * np.ones(60 * 500), 500)[:, 20 * 500 : 40 * 500]).max() < 5e-7


def test_sections_match_the_recursion():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2, 1500))
    s = dsp.highpass_sections(500, 4, 1.0)
    want = x.copy()
    for b0, b1, b2, a1, a2 in s:
        y = np.empty_like(want)
        g = (b0 + b1 + b2) / (1 + a1 + a2)
        x1 = x2 = want[:, 0]
        y1 = y2 = want[:, 0] * g
        for k in range(want.shape[1]):
            v = b0 * want[:, k] + b1 * x1 + b2 * x2 - a1 * y1 - a2 * y2
            x2, x1, y2, y1 = x1, want[:, k], y1, v
            y[:, k] = v
        want = y
    assert np.abs(dsp._run(x, s) - want).max() < 1e-9


def test_resampled_tone():
    n, span = 60000, 15361
    x = np.sin(2 * np.pi * 10 * np.arange(n + 1) / 500)
    y = dsp.resample(x[None], n / (span * 2), span * 2 + 1, dsp.kaiser_plan(n / (span / 128)))[0]
    at = np.arange(len(y)) * n / (span * 2) / 500
    inner = (at > 40) & (at < 80)
    assert len(y) == 30723 and np.abs(y - np.sin(2 * np.pi * 10 * at))[inner].max() <= 5e-4


def test_reflection():
    assert dsp.reflect(np.array([-1, 0, 4, 5, 8, 9]), 5).tolist() == [1, 0, 4, 3, 0, 1]


def test_spectra():
    t = np.arange(2000) / 500
    f, db = dsp.welch(np.sin(2 * np.pi * 10 * t), 500)
    assert f[db.argmax()] == pytest.approx(10, abs=0.2)
    _, f, p = dsp.multitaper(np.sin(2 * np.pi * 10 * t), 500)
    assert p.shape[::-1] == (656, 61) and f[p.mean(axis=0).argmax()] == pytest.approx(10, abs=1)
    assert dsp.multitaper(np.sin(2 * np.pi * 10 * np.arange(1024) / 256), 256)[2].shape[::-1] == (641, 60)


def header(records=3, labels=("C3", "M1")):
    fields = dict(zip([k for k, _ in edf.FIXED], ["0", "123456 M 12-SEP-1950 NAME", "Startdate 25-FEB-2026 AUTO85061915252301 X DEVICE_01", "25.02.26", "22.00.00", str(256 * (len(labels) + 1)), "", str(records), "1", str(len(labels))]))
    signal = lambda n, s: dict(zip([k for k, _ in edf.SIGNAL], [n, "", "uV", "-1465", "1465", "-32768", "32767", "", str(s), ""]))
    return edf.Header(fields, [signal(n, 4 * (i + 1)) for i, n in enumerate(labels)])


def test_edf_round_trip(spark, tmp_path):
    h = header()
    values = [np.linspace(-100, 100, 12), np.linspace(0, 1400, 24)]
    (tmp_path / "a.edf").write_bytes(edf.content(h, values))
    (tmp_path / "B.EDF").write_bytes(b"no header")
    edf.register(spark)
    rows = spark.read.format("edf").option("channels", "M1").option("recordsPerPartition", "2").load(str(tmp_path / "a.edf")).orderBy("block_id").collect()
    got = np.concatenate([r["values"] for r in rows])
    assert [r.first_sample for r in rows] == [1, 9, 17] and np.abs(got - values[1]).max() < 0.03 and {r.channel for r in rows} == {"M1"}
    listed = edf.folder(spark, str(tmp_path)).collect()
    assert [(r.name, r.error) for r in listed] == [("a.edf", None), ("B.EDF", "edf:ShortHeader")] and listed[0].n_records == 3
    (tmp_path / "B.EDF").unlink()
    blocks = spark.read.format("edf").load(str(tmp_path))
    out = edf.write(blocks, {"a.edf": h}, str(tmp_path)).collect()
    assert out[0].path.endswith("a_aligned.edf")
    assert (tmp_path / "a_aligned.edf").read_bytes() == (tmp_path / "a.edf").read_bytes()
    assert edf.long_form(blocks.where("channel = 'C3'")).count() == 12


@pytest.mark.parametrize("change, identifier", [({"version": "1"}, "UnsupportedVersion"), ({"n_records": "-1"}, "UnknownRecordCount"), ({"n_records": "x"}, "InvalidNumber"), ({"record_duration": "0"}, "InvalidRecordDuration"), ({"header_bytes": "512"}, "HeaderSizeMismatch")])
def test_bad_headers(change, identifier):
    h = header()
    h.fields |= change
    with pytest.raises(AlignmentError, match=identifier):
        edf.parse(h.bytes(), 1000)


def test_ranges_of_bytes_give_all_records(spark, tmp_path):
    h = header(records=50)
    values = [np.arange(200.0), np.arange(400.0)[::-1] - 100]
    for name in ("a.edf", "b.EDF", "c.edf"):
        (tmp_path / name).write_bytes(edf.content(h, values))
    os.symlink(tmp_path / "a.edf", tmp_path / "link.edf")
    edf.register(spark)
    for size in ("24", "600", "100000"):
        rows = spark.read.format("edf").option("bytesPerPartition", size).load(f"file://{tmp_path}/b.EDF")
        assert rows.rdd.getNumPartitions() == -(-(768 + 1200) // int(size)) and rows.count() == 100
        got = edf.long_form(rows.where("channel = 'M1'")).orderBy("sample").toPandas()
        assert np.abs(got["value"].to_numpy() - values[1]).max() < 0.03 and got["sample"].tolist() == list(range(1, 401))
    listed = {r.name: r.error for r in edf.folder(spark, str(tmp_path)).collect()}
    assert listed == {"a.edf": None, "b.EDF": None, "c.edf": None, "link.edf": "edf:NotARegularFile"}
    reads = edf.folder(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in reads


def test_another_entry_of_the_source_is_no_free_target(tmp_path):
    raw = edf.content(header(), [np.zeros(12), np.zeros(24)])
    for name, other in (("raw.edf", "st1.edf"), ("ST2.edf", "st2.EDF")):
        (tmp_path / name).write_bytes(raw)
        os.link(tmp_path / name, tmp_path / other)
        study = other.split(".")[0]
        r = deid.deidentify(str(tmp_path / name), study)
        assert (r.status, r.error) == ("failed", "deid:TargetExists")
        assert (tmp_path / name).read_bytes() == raw == (tmp_path / other).read_bytes()
    (tmp_path / "st3.edf").write_bytes(raw)
    assert deid.deidentify(str(tmp_path / "st3.edf"), "st3").status == "completed"
    assert (tmp_path / "st3.edf").read_bytes()[8:26] == b"AUTO85061915252301"


def test_preflight_allows_only_the_sources_own_name(spark):
    jobs = spark.createDataFrame([(1, "f", "ST1.edf", "st1", "st1.edf", None), (2, "f", "st2.edf", "st2", "st2.edf", None), (3, "f", "a.edf", "st3", "st3.edf", None)], "job_id long, folder string, source string, study_id string, target string, error string")
    names = spark.createDataFrame([("f", n) for n in ("ST1.edf", "st1.edf", "st2.edf", "a.edf", "St3.EDF")], "folder string, name string")
    assert sorted(tuple(r) for r in deid.preflight(jobs, names).collect()) == [(1, "target_exists"), (3, "target_exists")]


def test_deidentify(tmp_path):
    raw = edf.content(header(), [np.zeros(12), np.zeros(24)])
    source = tmp_path / "old name.edf"
    source.write_bytes(raw)
    r = deid.deidentify(str(source), "sas_023")
    assert r.status == "completed" and sorted(os.listdir(tmp_path)) == ["sas_023.edf"]
    new = (tmp_path / "sas_023.edf").read_bytes()
    assert new[8:88] == b"AUTO85061915252301 X 01-JAN-1999 sas_023".ljust(80) and new[:8] + new[88:] == raw[:8] + raw[88:]
    other = tmp_path / "other.edf"
    other.write_bytes(raw)
    assert deid.deidentify(str(other), "sas_023").status == "failed" and other.read_bytes() == raw
    assert [x.status for x in deid.process([(str(other), "bad id"), (str(other), "fine")])] == ["failed", "untouched"]
    assert deid.deidentify(str(other), "later", cancel=lambda: True).status == "cancelled" and sorted(os.listdir(tmp_path)) == ["other.edf", "sas_023.edf"]


def test_fault_threshold(spark):
    def faulty(m1, m2):
        rows = [(1, c, 2000.0 if i < n else 0.0, True) for c, n in (("M1", m1), ("M2", m2)) for i in range(1000)]
        return montage.fault(spark.createDataFrame(rows, "recording_id int, channel string, value double, matched boolean")).first().faulty

    assert not faulty(20, 20) and faulty(21, 20)


def test_a_source_that_changes_late_is_kept(tmp_path, monkeypatch):
    """A write between the copy and the removal: the source gets its name back, the output goes."""
    source = tmp_path / "one.edf"
    raw = edf.content(header(), [np.zeros(12), np.zeros(24)])
    source.write_bytes(raw)
    first = deid._sync

    def late(folder):
        (aside,) = [f for f in os.listdir(folder) if f.endswith(".aside")]
        with open(os.path.join(folder, aside), "r+b") as f:
            f.seek(-1, 2)
            f.write(b"\x07")
        first(folder)

    monkeypatch.setattr(deid, "_sync", late)
    changed = raw[:-1] + b"\x07"
    r = deid.deidentify(str(source), "later")
    assert (r.status, r.error) == ("failed", "deid:SourceChanged") and os.listdir(tmp_path) == ["one.edf"] and source.read_bytes() == changed


def test_align(spark):
    """Trigger extraction, pairing and segments through the plan, from events and a trace."""
    from lockstep.operators.triggers import VALIDATION
    from lockstep.plans.align import RecordingPair, edf_events, edf_triggers, eeg_triggers
    from lockstep.operators.replay import segment_recordings
    from test_matcher import build, keep

    a, b = build("eeg", keep(3), 500, 0), build("edf", keep(3), 128, 100)
    events = spark.createDataFrame([(7, i + 1, int(x), f" {t}, mark ") for i, (x, t) in enumerate(zip(a.latency, a.types))] + [(7, 900, 5, "boundary")] + [(7, k - 9, 1, c) for k, c in enumerate(VALIDATION)], "recording_id long, event_index long, latency long, type string")
    volts = {"63": 36.5, "64": 42.5}
    trace = spark.createDataFrame([(7, int(x) + k, volts[t]) for x, t in zip(b.latency, b.types) for k in range(3)], "recording_id long, sample long, volts double")
    pair = RecordingPair(events, trace, None, None)
    eeg, other = eeg_triggers(pair), edf_triggers(edf_events(pair))
    assert eeg.count() == other.count() == 150
    rows = segment_recordings(eeg, other, 500, 128).collect()
    assert len(rows) == 1 and rows[0].error is None and (rows[0].end_eeg_chunk, rows[0].end_interval) == (3, 49)


def test_all_outputs_of_all_recordings(spark, tmp_path):
    from lockstep.functions import dsp
    from lockstep.plans import registry

    rng = np.random.default_rng(4)
    values = np.round(rng.normal(size=3300), 3)  # three recordings, and one of 300 samples
    spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {(r.recording_id, r.sample): r.value for r in registry.QUERIES["sinc_resample"](spark, str(tmp_path)).collect()}
    order, beta, cutoff = dsp.kaiser_plan(500)
    t = np.arange(-(order // 2), order // 2 + 1)
    want = {}
    for r in range(4):
        x = values[1000 * r : 1000 * (r + 1)]
        n = len(x)
        for k in range(int((n - 1) * 256 // 500) + 1):
            pos = k * 500 / 256
            centre = int(np.floor(pos + 0.5))
            w = cutoff * np.sinc(cutoff * (pos - centre - t)) * np.i0(beta * np.sqrt(np.maximum(0, 1 - (t / (order / 2)) ** 2)))
            at = np.abs((centre + t) % (2 * n - 2))
            want[r, k + 1] = float((w * x[np.where(at >= n, 2 * n - 2 - at, at)]).sum() / w.sum())
    assert got.keys() == want.keys() and len(got) == 3 * 512 + 154
    assert max(abs(got[k] - want[k]) for k in got) < 1e-5


def test_many_small_files_make_few_tasks(tmp_path):
    from lockstep.sources import edf

    for i in range(300):
        (tmp_path / f"r{i:03}.edf").write_bytes(bytes(4768))
    tasks = edf.EdfSource({"path": str(tmp_path), "bytesPerPartition": "1500"}).reader(None).partitions()
    ranges = [(r.path, r.low, r.high) for t in tasks for r in t.ranges]
    assert len(ranges) == len(set(ranges)) == 1200 and len(tasks) < 20


def test_samples_are_dealt_by_their_number(spark, monkeypatch):
    from lockstep.operators import montage

    monkeypatch.setattr(montage, "ROWS", 500)
    samples = spark.range(10000).selectExpr("id div 100 AS recording_id", "'A' AS channel", "id % 100 AS sample", "cast(id AS double) AS value")
    out = montage.mean_centred(samples, ["recording_id", "channel"])
    assert out.rdd.getNumPartitions() == 20
    assert out.where("sample = 0 AND value = -49.5").count() == 100
