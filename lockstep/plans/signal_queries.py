"""Queries over samples: slicing, centring, resampling, timelines, channels."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dsp
from ..functions.lineage import shared_folder
from ..operators import montage, qa, resampling, segments
from ..sources import edf
from . import views
from .views import table

QUERIES, ORACLE = {}, {}
LABELS = ("Fp1", "Fp2", "F3", "F4", "C3", "C4", "O1", "O2", "M1", "M2", "E1", "E2")
N = views.SAMPLES


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _values(labels, scale: int) -> str:
    """value of each label, from rational arithmetic."""
    return ", ".join(f"('{c}', value * {i + scale} - event_id % {7 + i})" for i, c in enumerate(labels))


def channel_sql(name: str, labels, scale: int) -> str:
    return f"{name} AS (SELECT event_id // {N} AS recording_id, event_id % {N} + 1 AS sample, c.channel, c.value, event_id % {N} BETWEEN 100 AND 899 AS matched FROM events, LATERAL (VALUES {_values(labels, scale)}) c(channel, value))"


def channels(spark, sf_dir, labels=LABELS, scale=1):
    e = table(spark, sf_dir, "events")
    rows = F.array(*(F.struct(F.lit(c).alias("channel"), F.expr(f"value * {i + scale} - event_id % {7 + i}").alias("value")) for i, c in enumerate(labels)))
    return e.select(F.expr(f"event_id div {N}").alias("recording_id"), F.expr(f"event_id % {N} + 1").alias("sample"), F.inline(rows), F.expr(f"event_id % {N} BETWEEN 100 AND 899").alias("matched")).select("recording_id", "sample", "channel", "value", "matched")


CLINICAL = channel_sql("clinical", LABELS, 1)
ALIGNED_LABELS = tuple(montage.ELECTRODES)
ALIGNED = channel_sql("aligned", ALIGNED_LABELS, 3)
RAW = channel_sql("raw", tuple(montage.ELECTRODES.values()) + ("X9",), 2)


def aligned(spark, sf_dir):
    return channels(spark, sf_dir, ALIGNED_LABELS, 3)


_BOUNDS = f"bounds AS (SELECT DISTINCT event_id // {N} AS recording_id, k AS segment_index, k * 300 + 11 AS start_sample, k * 300 + 210 AS end_sample FROM events, range(0, 3) r(k))"


def bounds(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.expr(f"event_id div {N}").alias("recording_id")).distinct()
    return e.select("recording_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("segment_index")).select("*", (F.col("segment_index") * 300 + 11).alias("start_sample"), (F.col("segment_index") * 300 + 210).alias("end_sample"))


@query(f"WITH {views.TRACE}, {_BOUNDS} SELECT t.*, b.segment_index FROM trace t JOIN bounds b ON t.recording_id = b.recording_id AND t.sample BETWEEN b.start_sample AND b.end_sample")
def segment_slice(spark, sf_dir):
    return segments.slices(views.trace(spark, sf_dir), bounds(spark, sf_dir), ["recording_id"])


@query(f"WITH {CLINICAL} SELECT recording_id, channel, sample, round(value - avg(value) OVER (PARTITION BY recording_id, channel), 6) AS value FROM clinical")
def mean_center(spark, sf_dir):
    c = montage.mean_centred(channels(spark, sf_dir).drop("matched"), ["recording_id", "channel"])
    return c.select("recording_id", "channel", "sample", F.round("value", 6).alias("value"))


_MAP = ", ".join(f"('{v}', '{k}', {i + 1})" for i, (k, v) in enumerate(montage.ELECTRODES.items()))


@query(f"WITH {RAW} SELECT r.recording_id, r.sample, m.name AS channel, r.value, m.n AS channel_order FROM raw r JOIN (VALUES {_MAP}) m(source, name, n) ON r.channel = m.source")
def channel_select(spark, sf_dir):
    return montage.select_channels(channels(spark, sf_dir, tuple(montage.ELECTRODES.values()) + ("X9",), 2).drop("matched"))


_SEG = f"SELECT event_id // {N} AS recording_id, min(event_id) AS a, max(event_id) AS b, count(*) AS n FROM events GROUP BY 1"


@query(f"WITH s AS ({_SEG}) SELECT recording_id, 0::BIGINT AS segment_index, (n * 500 - 1)::DOUBLE / (n * 128 / 128.0::DOUBLE) AS effective_rate, (n * 500 - 1)::DOUBLE / (n * 256) AS step, (n * 256 + 1)::BIGINT AS output_count FROM s")
def resample_grid(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy(F.expr(f"event_id div {N}").alias("recording_id")).agg(F.count("*").alias("n"))
    b = e.select("recording_id", F.lit(0).cast("long").alias("segment_index"), F.lit(1).alias("eeg_start_sample"), (F.col("n") * 500).alias("eeg_end_sample"), F.lit(1).alias("edf_start_sample"), (F.col("n") * 128 + 1).alias("edf_end_sample"))
    return resampling.grid(b, 128, 2)


_FOLD = "((((i - 1) % 38) + 38) % 38)"


@query(f"SELECT i, CASE WHEN {_FOLD} >= 20 THEN 38 - {_FOLD} ELSE {_FOLD} END + 1 AS folded FROM (SELECT event_id - 500 AS i FROM events)")
def reflect_index(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("event_id") - 500).alias("i"))
    return e.select("i", resampling.reflected(F.col("i"), 20).cast("long").alias("folded"))


PLAN = ORDER, BETA, CUTOFF = dsp.kaiser_plan(500)
UP, DOWN = 64, 125  # 256 Hz from 500 Hz


def _i0_sql(x: str) -> str:
    return f"list_sum(list_transform(range(0, {resampling.I0_TERMS}), lambda k: pow(pow({x} / 2, k) / gamma(k + 1), 2)))"


_KERNEL = f"""taps AS MATERIALIZED (SELECT phase, t, ahead, phase * {DOWN} / {UP}::DOUBLE - ahead - t AS d FROM (SELECT p.phase, r.t, floor(p.phase * {DOWN} / {UP}::DOUBLE + 0.5)::BIGINT AS ahead FROM range({UP}) p(phase), range({-(ORDER // 2)}, {ORDER // 2 + 1}) r(t))),
weights AS MATERIALIZED (SELECT phase, t, ahead, w / sum(w) OVER (PARTITION BY phase) AS w FROM (SELECT *, (CASE WHEN d = 0 THEN {CUTOFF} ELSE {CUTOFF} * sin(pi() * {CUTOFF} * d) / (pi() * {CUTOFF} * d) END) * {_i0_sql(f"({BETA} * sqrt(greatest(0, 1 - pow(t / {ORDER / 2}, 2))))")} AS w FROM taps))"""


@query(f"WITH {_KERNEL} SELECT event_id, event_id % {UP} AS phase, event_id % {ORDER + 1} - {ORDER // 2} AS t, round(w, 9) + 0.0 AS weight FROM events JOIN weights ON phase = event_id % {UP} AND t = event_id % {ORDER + 1} - {ORDER // 2}")
def kaiser_weights(spark, sf_dir):
    """One tap's weight of each output of the anti-aliasing kernel at 500 Hz, 315 taps in 64 phases; outputs and taps by event."""
    e = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % UP).alias("phase"), (F.col("event_id") % (ORDER + 1) - ORDER // 2).alias("t"))
    w = resampling.phase_weights(spark, UP, DOWN, PLAN).withColumnRenamed("phase", "p")
    tap = F.element_at("weights", (F.col("t") + ORDER // 2 + 1).cast("int"))
    return e.join(F.broadcast(w), F.col("phase") == F.col("p")).select("event_id", "phase", "t", (F.round(tap, 9) + 0.0).alias("weight"))


@query(f"""WITH {_KERNEL}, src AS (SELECT event_id // {N} AS recording_id, event_id % {N} AS i, value FROM events), n AS (SELECT recording_id, count(*) AS n FROM src GROUP BY 1),
outs AS (SELECT recording_id, n, k, k % {UP} AS phase, (k // {UP}) * {DOWN} AS base FROM (SELECT recording_id, n, unnest(range(0, floor((n - 1) * {UP} / {DOWN}::DOUBLE)::BIGINT + 1)) AS k FROM n)),
hits AS (SELECT recording_id, k, w, n, (base + ahead + t) % greatest(2 * (n - 1), 1) AS m FROM outs JOIN weights USING (phase)),
placed AS (SELECT recording_id, k, w, n, CASE WHEN m < 0 THEN m + 2 * (n - 1) ELSE m END AS m FROM hits)
SELECT p.recording_id, k + 1 AS sample, round(sum(w * value), 6) AS value FROM placed p JOIN src s ON s.recording_id = p.recording_id AND s.i = CASE WHEN p.m >= p.n THEN 2 * (p.n - 1) - p.m ELSE p.m END GROUP BY p.recording_id, k""")
def sinc_resample(spark, sf_dir):
    """All outputs at 256 Hz of all recordings at 500 Hz: blocks of samples with reflected ends, and the kernel's weights by phase."""
    src = table(spark, sf_dir, "events").select(F.expr(f"event_id div {N}").alias("recording_id"), F.expr(f"event_id % {N} + 1").alias("source"), "value")
    return resampling.resample_rational(src, UP, DOWN, PLAN).select("recording_id", (F.col("k") + 1).alias("sample"), F.round("value", 6).alias("value"))


@query()
def segment_resample(spark, sf_dir):
    """High-pass and resampling of all channels of all recordings, by grouped numpy."""
    c = channels(spark, sf_dir).drop("matched").withColumn("segment_index", F.lit(1).cast("long"))
    top = c.groupBy("recording_id").agg(F.max("sample").alias("n"))
    seg = top.select("recording_id", F.lit(1).cast("long").alias("segment_index"), F.lit(1).cast("long").alias("eeg_start_sample"), F.col("n").alias("eeg_end_sample"), F.lit(1).cast("long").alias("edf_start_sample"), (F.floor((F.col("n") - 1) * 128 / 500) + 1).alias("edf_end_sample")).where("edf_end_sample > 100")
    return resampling.resample_blocks(c, seg, 128, 2)


@query(f"""WITH {CLINICAL}, x AS (SELECT recording_id, channel, list(value ORDER BY sample) AS v, count(*) AS len, least(1024, count(*)) AS n FROM clinical GROUP BY ALL),
shape AS (SELECT *, greatest(256, pow(2, ceil(log2(n)))::BIGINT) AS size, greatest(1, n - n // 2) AS hop FROM x),
parts AS (SELECT recording_id, channel, v, n, size, unnest(range(0, len - n + 1, hop)) AS s FROM shape),
taps AS (SELECT recording_id, channel, n, size, s, t, v[s + t + 1] * (0.54 - 0.46 * cos(2 * pi() * t / n)) AS y FROM (SELECT *, unnest(range(0, n)) AS t FROM parts)),
ft AS (SELECT recording_id, channel, n, size, s, k, sum(y * cos(2 * pi() * ((k * t) % size) / size)) AS re, sum(y * sin(2 * pi() * ((k * t) % size) / size)) AS im FROM taps, range(0, 513) f(k) WHERE k <= size // 2 GROUP BY ALL),
loud AS (SELECT n, sum(pow(0.54 - 0.46 * cos(2 * pi() * t / n), 2)) AS w FROM (SELECT n, unnest(range(0, n)) AS t FROM (SELECT DISTINCT n FROM x)) GROUP BY n),
sums AS (SELECT recording_id, channel, k, size, avg(re * re + im * im) AS a, max(w) AS w FROM ft JOIN loud USING (n) GROUP BY recording_id, channel, k, size),
power AS (SELECT recording_id, channel, k, size, a / (256 * w) * CASE WHEN k = 0 OR 2 * k = size THEN 1 ELSE 2 END AS p FROM sums)
SELECT recording_id, channel, 0.0::DOUBLE AS time_sec, k * 256 / size::DOUBLE AS frequency, round(10 * log10(greatest(p, 2.2250738585072014e-308)), 6) AS db FROM power""")
def welch_psd(spark, sf_dir):
    """Power density of each channel, in dB."""
    return resampling.spectra(channels(spark, sf_dir).drop("matched"), 256).withColumn("db", F.round("db", 6))


@query(f"WITH {CLINICAL} SELECT recording_id, count(*) FILTER (matched) AS matched, count(*) AS total, 100.0 * count(*) FILTER (matched) / count(*) AS coverage_percent FROM (SELECT DISTINCT recording_id, sample, matched FROM clinical) GROUP BY recording_id")
def coverage_report(spark, sf_dir):
    """How much of each recording's time is matched."""
    return montage.coverage(channels(spark, sf_dir, LABELS[:1]).select("recording_id", "sample", "matched"))


@query(f"SELECT event_id // {N} AS recording_id, min(value) AS low, max(value) AS high FROM events GROUP BY 1")
def shared_limits(spark, sf_dir):
    """Limits that a recording's plots share."""
    return qa.limits(table(spark, sf_dir, "events").select(F.expr(f"event_id div {N}").alias("recording_id"), F.col("value").alias("db")), ["recording_id"])


#: Ten records of one second, with 100 samples of each signal: an event is a sample.
_EDF_ROWS = f"event_id % {N} - 500"


def _edf_folder(spark, sf_dir) -> str:
    """All recordings as EDF files in a new folder: signal A is a ramp, signal B the events' values in whole units."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.expr(f"concat('r', event_id div {N}, '.edf')").alias("recording"), F.expr(f"event_id % {N}").alias("i"), F.expr(_EDF_ROWS).cast("double").alias("A"), F.round("value").alias("B"))
    both = rows.select("recording", "i", F.inline(F.array(*(F.struct(F.lit(c).alias("channel"), F.col(c).alias("value")) for c in "AB"))))
    body = F.transform(F.sort_array(F.collect_list(F.struct("i", "value"))), lambda x: x["value"])
    blocks = both.groupBy("recording", "channel", F.expr("i div 100").alias("block_id")).agg(body.alias("values"))
    fields = dict(zip([k for k, _ in edf.FIXED], ["0", "X X X X", "Startdate 25-FEB-2026 X X X", "25.02.26", "22.00.00", str(256 * 3), "", "10", "1", "2"]))
    signal = {"transducer": "", "physical_dimension": "uV", "physical_min": "-32768", "physical_max": "32767", "digital_min": "-32768", "digital_max": "32767", "prefilter": "", "samples_in_record": "100", "reserved": ""}
    folder = f"{shared_folder(spark)}/edf-{uuid.uuid4().hex}"
    edf.write(blocks, edf.Header(fields, [{"label": c} | signal for c in "AB"]), folder).agg(F.sum("bytes")).collect()
    edf.register(spark)
    return folder


_EDF_SQL = f"SELECT 'r' || event_id // {N} || '_aligned.edf' AS recording, event_id % {N} + 1 AS sample, {_EDF_ROWS} AS a, round(value) AS b FROM events"


@query(f"WITH e AS ({_EDF_SQL}) SELECT recording, 'A' AS channel, sample, a::DOUBLE AS value FROM e UNION ALL SELECT recording, 'B', sample, b FROM e")
def edf_scan(spark, sf_dir):
    """All samples of recordings that were written as EDF, by ranges of bytes."""
    return edf.long_form(spark.read.format("edf").option("bytesPerPartition", "1500").load(_edf_folder(spark, sf_dir)))


@query(f"WITH e AS ({_EDF_SQL}) SELECT recording, 'B' AS channel, sample, b AS value FROM e")
def edf_channel_scan(spark, sf_dir):
    """One channel of these recordings; the other's samples are not decoded."""
    return edf.long_form(spark.read.format("edf").option("channels", "B").load(_edf_folder(spark, sf_dir)))


@query(f"SELECT 'r' || event_id // {N} || '_aligned.edf' AS name, 768 + 4 * count(*) AS size, 10 AS n_records, 2 AS n_signals, 10.0::DOUBLE AS duration_sec, NULL::VARCHAR AS error FROM events GROUP BY event_id // {N}")
def edf_folder(spark, sf_dir):
    """The files of that folder with their headers' facts."""
    return edf.folder(spark, _edf_folder(spark, sf_dir)).select("name", "size", "n_records", "n_signals", "duration_sec", "error")


_TAPERS = ", ".join(f"({j}, {v.tolist()})" for j, v in enumerate(dsp.slepian(256, 2.0, 3)))


@query(f"""WITH {CLINICAL}, x AS (SELECT recording_id, list(d ORDER BY sample) AS v FROM (SELECT recording_id, sample, max(CASE WHEN channel = 'C3' THEN value END) - max(CASE WHEN channel = 'M2' THEN value END) AS d FROM clinical WHERE channel IN ('C3', 'M2') GROUP BY recording_id, sample) GROUP BY recording_id),
cut AS (SELECT recording_id, s, v[s + 1:s + 256] AS w FROM (SELECT *, unnest(range(0, len(v) - 255, 13)) AS s FROM x)),
level AS (SELECT recording_id, s, list_transform(w, lambda y: y - m) AS w FROM (SELECT *, list_sum(w) / 256 AS m FROM cut)),
tapers AS (SELECT j, unnest(v) AS v, unnest(range(0, 256)) AS t FROM (VALUES {_TAPERS}) q(j, v)),
waves AS MATERIALIZED (SELECT j, k, list(v * cos(2 * pi() * ((k * t) % 4096) / 4096) ORDER BY t) AS c, list(v * sin(2 * pi() * ((k * t) % 4096) / 4096) ORDER BY t) AS i FROM tapers, range(0, 641) f(k) GROUP BY j, k),
power AS (SELECT recording_id, s, k, avg(pow(list_inner_product(w, c), 2) + pow(list_inner_product(w, i), 2)) / 256 AS p FROM level, waves GROUP BY recording_id, s, k)
SELECT recording_id, 'C3:M2' AS channel, (s + 128) / 256::DOUBLE AS time_sec, k * 256 / 4096::DOUBLE AS frequency, round(10 * log10(greatest(p, 2.2250738585072014e-308)), 6) AS db FROM power""")
def multitaper_spectrogram(spark, sf_dir):
    """Spectrogram of C3 against M2, in dB."""
    c3 = channels(spark, sf_dir).where(F.col("channel").isin("C3", "M2"))
    diff = montage.bipolar(montage.pivot(c3, ("C3", "M2")), {"C3:M2": ("C3", "M2")}).select("recording_id", F.lit("C3:M2").alias("channel"), "sample", F.col("C3:M2").alias("value"))
    return resampling.spectra(diff, 256, "multitaper").withColumn("db", F.round("db", 6))


@query(f"WITH {views.TRACE}, {_BOUNDS} SELECT t.recording_id, t.sample, coalesce(CASE WHEN b.segment_index IS NOT NULL THEN t.volts END, 0) AS value, b.segment_index IS NOT NULL AS matched FROM trace t LEFT JOIN bounds b ON t.recording_id = b.recording_id AND t.sample BETWEEN b.start_sample AND b.end_sample")
def timeline_zero_fill(spark, sf_dir):
    t = views.trace(spark, sf_dir)
    placed = segments.slices(t, bounds(spark, sf_dir), ["recording_id"]).select("recording_id", "sample", F.col("volts").alias("value"))
    totals = t.groupBy("recording_id").agg(F.max("sample").alias("n_samples"))
    return montage.zero_filled(bounds(spark, sf_dir), placed, totals)


@query(f"WITH {_BOUNDS} SELECT recording_id, segment_index, (start_sample - 1) * 2 + 1 AS start_sample, (end_sample - 1) * 2 + 1 AS end_sample FROM bounds")
def scalp_bounds(spark, sf_dir):
    """Segment bounds on the trigger channel's grid, on the scalp channels' grid."""
    at = lambda c: ((F.col(c) - 1) * 2 + 1).alias(c)
    return bounds(spark, sf_dir).select("recording_id", "segment_index", at("start_sample"), at("end_sample"))


@query(f"WITH b AS (SELECT event_id // {N} AS recording_id, event_id AS start_sample, event_id + (value / 4)::BIGINT AS end_sample FROM events), o AS (SELECT *, lag(end_sample) OVER (PARTITION BY recording_id ORDER BY start_sample) AS before FROM b) SELECT * FROM o WHERE start_sample <= before".replace("(value / 4)::BIGINT", "round(value / 4)::BIGINT"))
def segment_overlaps(spark, sf_dir):
    b = table(spark, sf_dir, "events").select(F.expr(f"event_id div {N}").alias("recording_id"), F.col("event_id").alias("start_sample"), F.expr("event_id + cast(round(value / 4) AS BIGINT)").alias("end_sample"))
    return montage.overlaps(b)


_LOUD = "loud AS (SELECT recording_id, channel, sample, value * 12 AS value, matched FROM clinical)"


@query(f"WITH {CLINICAL}, {_LOUD}, s AS (SELECT recording_id, channel, avg(CASE WHEN abs(value) >= 1000 THEN 1.0 ELSE 0 END) AS share FROM loud WHERE matched AND channel IN ('M1', 'M2') GROUP BY ALL) SELECT recording_id, round(max(CASE WHEN channel = 'M1' THEN 100 * share END), 9) AS m1_percent, round(max(CASE WHEN channel = 'M2' THEN 100 * share END), 9) AS m2_percent, avg(share) > 0.02 AS faulty FROM s GROUP BY recording_id")
def fault_detection(spark, sf_dir):
    loud = channels(spark, sf_dir).withColumn("value", F.col("value") * 12)
    return montage.fault(loud).select("recording_id", F.round("m1_percent", 9).alias("m1_percent"), F.round("m2_percent", 9).alias("m2_percent"), "faulty")


def _splice(spark, sf_dir, faulty):
    flags = table(spark, sf_dir, "events").select(F.expr(f"event_id div {N}").alias("recording_id")).distinct().withColumn("faulty", F.lit(faulty))
    s = montage.splice(aligned(spark, sf_dir), channels(spark, sf_dir), flags)
    return s.withColumn("value", F.round("value", 6))


def _splice_sql(faulty: bool) -> str:
    rows = []
    for c in montage.OUTPUT:
        if faulty:
            rows.append(f"SELECT recording_id, sample, '{c}' AS channel, round(value, 6) AS value, 'aligned {montage.FAULTY[c]}' AS derivation FROM aligned WHERE channel = '{montage.FAULTY[c]}'")
        elif c in montage.REFERENCE:
            m = montage.REFERENCE[c]
            rows.append(f"SELECT a.recording_id, a.sample, '{c}' AS channel, round(a.value - m.value + k.value, 6) AS value, '{c} - {m} + clinical {m}' AS derivation FROM aligned a JOIN aligned m USING (recording_id, sample) JOIN clinical k USING (recording_id, sample) WHERE a.channel = '{c}' AND m.channel = '{m}' AND k.channel = '{m}'")
        else:
            rows.append(f"SELECT recording_id, sample, '{c}' AS channel, round(value, 6) AS value, 'clinical {c}' AS derivation FROM clinical WHERE channel = '{c}'")
    return f"WITH {CLINICAL}, {ALIGNED} " + " UNION ALL ".join(rows)


@query(_splice_sql(False))
def splice_normal(spark, sf_dir):
    return _splice(spark, sf_dir, False)


@query(_splice_sql(True))
def splice_faulty(spark, sf_dir):
    return _splice(spark, sf_dir, True)


@query(f"WITH {CLINICAL}, c AS (SELECT recording_id, channel, sample, matched, CASE WHEN sample % 50 = 7 AND NOT matched THEN 'NaN'::DOUBLE ELSE value END AS value FROM clinical), s AS (SELECT recording_id, channel, 100 * avg(CASE WHEN value < -300 OR value > 900 THEN 1.0 ELSE 0 END) FILTER (matched) AS p, count(*) FILTER (isnan(value)) AS n_bad FROM c GROUP BY ALL) SELECT recording_id, channel, round(p, 3) AS percent_outside, coalesce(p > 1, false) AS fails, n_bad FROM s")
def bounds_report(spark, sf_dir):
    """Samples outside of limits where matched, and samples that are not finite anywhere."""
    c = channels(spark, sf_dir)
    c = c.withColumn("value", F.when((F.col("sample") % 50 == 7) & ~F.col("matched"), float("nan")).otherwise(F.col("value")))
    limits = c.select("recording_id", "channel").distinct().withColumn("physical_min", F.lit(-300.0)).withColumn("physical_max", F.lit(900.0))
    return montage.bounds(c, limits)


_P = "max(CASE WHEN channel = '{0}' THEN value END)"


@query(f"WITH {CLINICAL}, w AS (SELECT recording_id, sample, {', '.join(_P.format(c) + ' AS ' + c for c in ('M1', 'M2', 'E1', 'E2', 'C3'))} FROM clinical GROUP BY ALL) SELECT recording_id, sample, round(E1 - M2, 6) AS \"E1:M2\", round(E2 - M1, 6) AS \"E2:M1\", round(E2 - M2, 6) AS \"E2:M2\", round(C3 - M2, 6) AS \"C3:M2\" FROM w")
def eog_montage(spark, sf_dir):
    pairs = {"E1:M2": ("E1", "M2"), "E2:M1": ("E2", "M1"), "E2:M2": ("E2", "M2"), "C3:M2": ("C3", "M2")}
    wide = montage.pivot(channels(spark, sf_dir), ("M1", "M2", "E1", "E2", "C3"))
    return montage.bipolar(wide, pairs).select("recording_id", "sample", *(F.round(k, 6).alias(k) for k in pairs))


_LAB = f"lab AS (SELECT event_id // {N} AS recording_id, CASE event_id % 13 WHEN 0 THEN 'C3' WHEN 1 THEN 'M1' WHEN 2 THEN 'M2' WHEN 3 THEN 'E1' ELSE 'X' || event_id END AS label FROM events WHERE value > 38 OR event_id % 97 = 0)"


@query(f"WITH {_LAB}, want AS (SELECT DISTINCT recording_id, l.label FROM lab, (VALUES ('C3'), ('M1'), ('M2'), ('E1'), ('E2')) l(label)), n AS (SELECT recording_id, label, count(*) AS n FROM lab GROUP BY ALL) SELECT recording_id, label, CASE WHEN n IS NULL THEN 'missing' ELSE 'duplicate' END AS problem FROM want LEFT JOIN n USING (recording_id, label) WHERE n IS NULL OR n > 1")
def label_exactly_one(spark, sf_dir):
    label = F.expr("CASE event_id % 13 WHEN 0 THEN 'C3' WHEN 1 THEN 'M1' WHEN 2 THEN 'M2' WHEN 3 THEN 'E1' ELSE concat('X', event_id) END")
    lab = table(spark, sf_dir, "events").where("value > 38 OR event_id % 97 = 0").select(F.expr(f"event_id div {N}").alias("recording_id"), label.alias("label"))
    return montage.missing(["C3", "M1", "M2", "E1", "E2"], lab)


_HEAD = "head AS (SELECT o_custkey % 200 AS recording_id, CASE WHEN o_orderkey % 101 = 0 THEN 'mV' ELSE ' uV ' END AS unit, CASE WHEN o_orderkey % 53 = 0 THEN 128 ELSE 256 END AS samples_in_record, -1465.0::DOUBLE AS physical_min, CASE WHEN o_orderkey % 67 = 0 THEN -2000.0 ELSE 1465.0 END::DOUBLE AS physical_max, -32768.0::DOUBLE AS digital_min, CASE WHEN o_orderkey % 71 = 0 THEN 40000.5 ELSE 32767.0 END::DOUBLE AS digital_max FROM orders)"


@query(f"""WITH {_HEAD}, g AS (SELECT recording_id, bool_or(trim(unit) <> 'uV') AS a, count(DISTINCT samples_in_record) > 1 OR bool_or(samples_in_record <= 0) AS b, bool_or(physical_min >= physical_max) AS c, count(DISTINCT physical_min) > 1 OR count(DISTINCT physical_max) > 1 AS d, count(DISTINCT digital_min) > 1 OR count(DISTINCT digital_max) > 1 AS e,
bool_or(digital_min <> floor(digital_min) OR digital_max <> floor(digital_max) OR digital_min < -32768 OR digital_max > 32767 OR digital_min >= digital_max) AS f FROM head GROUP BY recording_id)
SELECT recording_id, 'InvalidPhysicalDimension' AS problem FROM g WHERE a UNION ALL SELECT recording_id, 'InconsistentSamplingRates' FROM g WHERE b UNION ALL SELECT recording_id, 'InvalidPhysicalLimits' FROM g WHERE c
UNION ALL SELECT recording_id, 'InconsistentPhysicalLimits' FROM g WHERE d UNION ALL SELECT recording_id, 'InconsistentDigitalLimits' FROM g WHERE e UNION ALL SELECT recording_id, 'InvalidDigitalLimits' FROM g WHERE f""")
def header_problems(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    h = o.select(F.expr("o_custkey % 200").alias("recording_id"), F.expr("CASE WHEN o_orderkey % 101 = 0 THEN 'mV' ELSE ' uV ' END").alias("unit"), F.expr("CASE WHEN o_orderkey % 53 = 0 THEN 128 ELSE 256 END").alias("samples_in_record"), F.lit(-1465.0).alias("physical_min"), F.expr("CASE WHEN o_orderkey % 67 = 0 THEN -2000.0D ELSE 1465.0D END").alias("physical_max"), F.lit(-32768.0).alias("digital_min"), F.expr("CASE WHEN o_orderkey % 71 = 0 THEN 40000.5D ELSE 32767.0D END").alias("digital_max"))
    return montage.header_problems(h)


@query(f"WITH {CLINICAL}, {views.TRACE} SELECT recording_id, channel, sample, (sample - 1) / 256.0::DOUBLE AS time_sec, value FROM clinical WHERE channel IN ('C3', 'M1', 'E2') UNION ALL SELECT recording_id, 'trigger', sample, (sample - 1) / 128.0::DOUBLE, volts FROM trace")
def native_traces(spark, sf_dir):
    """The trigger channel and three clinical channels, each on its own grid."""
    return qa.native_traces(views.trace(spark, sf_dir), channels(spark, sf_dir), 128.0, 256.0)


@query(f"WITH {CLINICAL}, m AS (SELECT recording_id, max(sample) AS n FROM clinical GROUP BY 1) SELECT recording_id, channel, sample, (sample - 1) / 256.0::DOUBLE AS time_sec, value FROM clinical JOIN m USING (recording_id) WHERE channel = 'C3' AND sample BETWEEN least(n, 600 * 256) // 2 - 15 * 256 + 1 AND least(n, 600 * 256) // 2 + 15 * 256")
def trace_window(spark, sf_dir):
    """Thirty seconds of C3 in the middle of the first ten minutes."""
    c = channels(spark, sf_dir)
    n = F.max("sample").over(Window.partitionBy("recording_id"))
    only = c.where("channel = 'C3'").withColumn("n", n)
    mid = F.floor(F.least(F.col("n"), F.lit(600 * 256)) / 2)
    return only.where(F.col("sample").between(mid - 15 * 256 + 1, mid + 15 * 256)).select("recording_id", "channel", "sample", ((F.col("sample") - 1) / 256).alias("time_sec"), "value")
