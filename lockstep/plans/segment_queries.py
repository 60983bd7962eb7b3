"""Queries over pairs of recordings: gaps, segments, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cycle, ordered, segments
from . import views
from .trigger_queries import _EDGE_SAME, eeg_chunks, eeg_cycle
from .views import EEG_RATE, SAMPLES, TOLERANCE, TRIGGER_RATE, edge_sql, schedule, table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_GAPS = f"gaps AS (SELECT event_id // {SAMPLES} AS recording_id, event_id AS gap, CASE WHEN event_id % {SAMPLES} = 0 THEN NULL ELSE event_id * 10 END AS start, CASE WHEN event_id % 170 = 0 THEN NULL ELSE event_id * 10 + (value * 3)::BIGINT END AS stop FROM events)"


def gaps(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.expr(f"event_id div {SAMPLES}").alias("recording_id"), F.col("event_id").alias("gap"), F.expr(f"CASE WHEN event_id % {SAMPLES} <> 0 THEN event_id * 10 END").alias("start"), F.expr("CASE WHEN event_id % 170 <> 0 THEN event_id * 10 + cast(round(value * 3) AS BIGINT) END").alias("stop"))


@query(f"""WITH {_GAPS.replace('(value * 3)::BIGINT', 'round(value * 3)::BIGINT')}, m AS (SELECT *, coalesce(start::DOUBLE, '-inf'::DOUBLE) AS low, CASE WHEN stop IS NULL THEN 'inf'::DOUBLE ELSE greatest(stop::DOUBLE, coalesce(start::DOUBLE, '-inf'::DOUBLE) + 1) END AS high FROM gaps),
n AS (SELECT *, CASE WHEN coalesce(low > max(high) OVER (PARTITION BY recording_id ORDER BY low, gap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS fresh FROM m)
SELECT recording_id, gap, start, stop, (sum(fresh) OVER (PARTITION BY recording_id ORDER BY low, gap))::INT AS gap_group_index FROM n""")
def gap_groups(spark, sf_dir):
    return ordered.overlap_groups(gaps(spark, sf_dir), ["recording_id"], "start", "stop", "gap")


@query(f"""WITH {_GAPS.replace('(value * 3)::BIGINT', 'round(value * 3)::BIGINT')}, m AS (SELECT *, coalesce(start::DOUBLE, '-inf'::DOUBLE) AS low, CASE WHEN stop IS NULL THEN 'inf'::DOUBLE ELSE greatest(stop::DOUBLE, coalesce(start::DOUBLE, '-inf'::DOUBLE) + 1) END AS high FROM gaps),
n AS (SELECT *, CASE WHEN coalesce(low > max(high) OVER (PARTITION BY recording_id ORDER BY low, gap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS fresh FROM m),
g AS (SELECT *, (sum(fresh) OVER (PARTITION BY recording_id ORDER BY low, gap))::INT AS gap_group_index FROM n)
SELECT recording_id, gap_group_index, min(start) AS start, max(stop) AS stop, bool_or(start IS NULL) AS is_leading, bool_or(stop IS NULL) AS is_terminal, count(*) AS members FROM g GROUP BY ALL""")
def gap_group_bounds(spark, sf_dir):
    """Bounds of each group, and whether it is open before or after all."""
    g = ordered.overlap_groups(gaps(spark, sf_dir), ["recording_id"], "start", "stop", "gap")
    return g.groupBy("recording_id", "gap_group_index").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.bool_or(F.col("start").isNull()).alias("is_leading"), F.bool_or(F.col("stop").isNull()).alias("is_terminal"), F.count("*").alias("members"))


_EXCL = f"excl AS (SELECT event_id // {views.EVENTS} AS recording_id, CASE WHEN event_id % 4 <> 1 THEN event_id % {views.EVENTS} END AS start, CASE WHEN event_id % 4 <> 2 THEN event_id % {views.EVENTS} + event_id % 3 * 5 END AS stop FROM events WHERE event_id % {views.EVENTS} IN (60, 201, 333, 410) AND value < 25 AND NOT (event_id % 4 = 1 AND event_id % 2 = 0))"


@query(f"""WITH {edge_sql('eeg')}, {_EXCL} SELECT p.* FROM eeg_edges p WHERE NOT EXISTS (SELECT 1 FROM excl g WHERE g.recording_id = p.recording_id AND
CASE WHEN g.start IS NULL AND g.stop IS NULL THEN true WHEN g.start IS NULL THEN p.source_event_index < g.stop WHEN g.stop IS NULL THEN p.source_event_index >= g.start
  WHEN g.stop > g.start THEN p.source_event_index >= g.start AND p.source_event_index < g.stop ELSE p.source_event_index = g.start END)""")
def interval_exclusion(spark, sf_dir):
    n = views.EVENTS
    e = table(spark, sf_dir, "events").where(f"event_id % {n} IN (60, 201, 333, 410) AND value < 25 AND NOT (event_id % 4 = 1 AND event_id % 2 = 0)")
    excl = e.select(F.expr(f"event_id div {n}").alias("recording_id"), F.expr(f"CASE WHEN event_id % 4 <> 1 THEN event_id % {n} END").alias("start"), F.expr(f"CASE WHEN event_id % 4 <> 2 THEN event_id % {n} + event_id % 3 * 5 END").alias("end"))
    return segments.excluded(cycle.edges(eeg_chunks(spark, sf_dir)), excl)


# Pairs of edges of chunks with equal numbers whose edges match in both systems, at equal positions.
_PAIRS = f"""WITH {edge_sql('eeg')}, {edge_sql('edf')},
pairs AS (SELECT a.recording_id, a.source_event_index AS eeg_source, a.destination_event_index AS eeg_destination, b.source_event_index AS edf_source, b.destination_event_index AS edf_destination
  FROM eeg_edges a JOIN edf_edges b ON a.recording_id = b.recording_id AND a.chunk_index = b.chunk_index AND a.interval_number = b.interval_number WHERE {_EDGE_SAME}),
seg AS (SELECT *, sum(fresh) OVER (PARTITION BY recording_id ORDER BY eeg_source) AS segment_index FROM (
  SELECT *, CASE WHEN coalesce(eeg_source <> lag(eeg_destination) OVER w OR edf_source <> lag(edf_destination) OVER w, true) THEN 1 ELSE 0 END AS fresh FROM pairs WINDOW w AS (PARTITION BY recording_id ORDER BY eeg_source)))"""


def _pairs(spark, sf_dir):
    a, b = (cycle.edges(eeg_chunks(spark, sf_dir, s)) for s in ("eeg", "edf"))
    keys = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("recording_id", "chunk_index", "interval_number")]
    j = a.alias("a").join(b.alias("b"), [*keys, segments.same_edge(TOLERANCE)])
    return j.select("a.recording_id", *(F.col(f"{t}.{c}_event_index").alias(f"{n}_{c}") for t, n in (("a", "eeg"), ("b", "edf")) for c in ("source", "destination")))


@query(f"{_PAIRS} SELECT recording_id, eeg_source, eeg_destination, edf_source, edf_destination FROM pairs")
def matched_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query(f"{_PAIRS} SELECT recording_id, segment_index::BIGINT AS segment_index, arg_min(eeg_source, eeg_source) AS eeg_start_event, arg_max(eeg_destination, eeg_source) AS eeg_end_event, arg_min(edf_source, eeg_source) AS edf_start_event, arg_max(edf_destination, eeg_source) AS edf_end_event, count(*) AS interval_count FROM seg GROUP BY ALL")
def segment_table(spark, sf_dir):
    return segments.segment_bounds(segments.matched_segments(_pairs(spark, sf_dir)))


_POINTS = f"""{_PAIRS}, pts AS (SELECT s.recording_id, s.segment_index, (e.latency - 1) / {EEG_RATE}::DOUBLE AS eeg_sec, (f.latency - 1) / {TRIGGER_RATE}::DOUBLE AS edf_sec FROM seg s
  JOIN eeg e ON e.recording_id = s.recording_id AND e.event_index = s.eeg_source JOIN edf f ON f.recording_id = s.recording_id AND f.event_index = s.edf_source),
org AS (SELECT recording_id, segment_index, min(eeg_sec) AS eeg0, min(edf_sec) AS edf0 FROM pts GROUP BY ALL),
xy AS (SELECT recording_id, segment_index, eeg_sec - eeg0 AS x, edf_sec - edf0 - (eeg_sec - eeg0) AS y FROM pts JOIN org USING (recording_id, segment_index)),
fit AS (SELECT recording_id, segment_index, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, avg(y) AS my, count(*) AS n FROM xy GROUP BY ALL),
res AS (SELECT recording_id, segment_index, any_value(n) AS n, any_value(slope) AS slope, any_value(intercept) AS intercept, sum(pow(y - slope * x - intercept, 2)) AS ss_res, sum(pow(y - my, 2)) AS ss_tot, max(abs(y - slope * x - intercept)) AS worst FROM xy JOIN fit USING (recording_id, segment_index) GROUP BY ALL)
SELECT recording_id, segment_index::BIGINT AS segment_index, n, round(slope, 9) AS slope, round(intercept, 7) AS intercept,
round(CASE WHEN n < 3 THEN NULL WHEN ss_tot <= n * pow(10 * pow(2, -52), 2) THEN CASE WHEN ss_res <= n * pow(10 * pow(2, -52), 2) THEN 1 ELSE 0 END ELSE 1 - ss_res / ss_tot END, 6) AS r_squared, round(worst, 7) AS max_abs_residual FROM res WHERE n >= 3"""


@query(_POINTS)
def clock_drift(spark, sf_dir):
    seg = segments.matched_segments(_pairs(spark, sf_dir))
    time = lambda side, rate: schedule(spark, sf_dir, side).select("recording_id", F.col("event_index").alias(f"{side}_source"), ((F.col("latency") - 1) / rate).alias(f"{side}_sec"))
    pts = seg.join(time("eeg", EEG_RATE), ["recording_id", "eeg_source"]).join(time("edf", TRIGGER_RATE), ["recording_id", "edf_source"])
    d = segments.drift(pts.select("recording_id", "segment_index", "eeg_sec", "edf_sec"), ["recording_id", "segment_index"])
    return d.where("n >= 3").select("recording_id", "segment_index", "n", F.round("slope", 9).alias("slope"), F.round("intercept", 7).alias("intercept"), F.round("r_squared", 6).alias("r_squared"), F.round("max_abs_residual", 7).alias("max_abs_residual"))


@query(f"WITH {views.schedule_sql('eeg')} SELECT recording_id, min(step) > 0 AS is_chronological, count(*) AS steps FROM (SELECT recording_id, latency - lag(latency) OVER (PARTITION BY recording_id ORDER BY event_index) AS step FROM eeg) WHERE step IS NOT NULL GROUP BY recording_id")
def chronology(spark, sf_dir):
    """Whether event times strictly increase."""
    from pyspark.sql import Window

    w = Window.partitionBy("recording_id").orderBy("event_index")
    steps = schedule(spark, sf_dir, "eeg").withColumn("step", F.col("latency") - F.lag("latency").over(w)).where("step is not null")
    return steps.groupBy("recording_id").agg((F.min("step") > 0).alias("is_chronological"), F.count("*").alias("steps"))


_SIDE = f"WITH {views.schedule_sql('eeg')}, {views.schedule_sql('edf')}"


@query(f"{_SIDE}, s AS (SELECT a.recording_id, (b.l - 1) / {TRIGGER_RATE}::DOUBLE - (a.l - 1) / {EEG_RATE}::DOUBLE AS shift FROM (SELECT recording_id, min(latency) AS l FROM eeg GROUP BY 1) a JOIN (SELECT recording_id, min(latency) AS l FROM edf GROUP BY 1) b USING (recording_id)) SELECT recording_id, event_index, (latency - 1) / {EEG_RATE}::DOUBLE + shift AS shifted_sec FROM eeg JOIN s USING (recording_id)")
def recording_shift(spark, sf_dir):
    """EEG times on the EDF's axis, shifted by the first anchors."""
    eeg, edf = schedule(spark, sf_dir, "eeg"), schedule(spark, sf_dir, "edf")
    first = lambda d, rate, name: d.groupBy("recording_id").agg(((F.min("latency") - 1) / rate).alias(name))
    shift = first(eeg, EEG_RATE, "a").join(first(edf, TRIGGER_RATE, "b"), "recording_id").select("recording_id", (F.col("b") - F.col("a")).alias("shift"))
    return eeg.join(shift, "recording_id").select("recording_id", "event_index", ((F.col("latency") - 1) / EEG_RATE + F.col("shift")).alias("shifted_sec"))


_REPORT = f"eeg_b AS (SELECT recording_id, chunk_index, min(event_index) AS lo, max(event_index) AS hi FROM eeg_chunks GROUP BY ALL), edf_b AS (SELECT recording_id, chunk_index, min(event_index) AS lo, max(event_index) AS hi FROM edf_chunks GROUP BY ALL)"


@query(f"WITH {views.chunk_sql('eeg')}, {views.chunk_sql('edf')}, {_REPORT} SELECT e.recording_id, e.event_index AS eeg_event_index, b.lo + e.event_index - a.lo AS edf_event_index FROM eeg e JOIN eeg_b a ON a.recording_id = e.recording_id AND e.event_index BETWEEN a.lo AND a.hi JOIN edf_b b ON b.recording_id = e.recording_id AND b.chunk_index = a.chunk_index JOIN edf f ON f.recording_id = e.recording_id AND f.event_index = b.lo + e.event_index - a.lo WHERE f.event_index <= b.hi AND f.type = e.type")
def offset_translation(spark, sf_dir):
    """EEG anchors on the EDF side: the same offset in the chunk of equal number, if it exists there with the same type."""
    shapes = {s: cycle.shapes(eeg_chunks(spark, sf_dir, s)).select("recording_id", "chunk_index", F.col("start_event_index").alias("lo"), F.col("end_event_index").alias("hi")) for s in ("eeg", "edf")}
    anchors = segments.containing(schedule(spark, sf_dir, "eeg"), shapes["eeg"], "event_index", "lo", "hi")
    there = anchors.join(shapes["edf"].select("recording_id", "chunk_index", F.col("lo").alias("lo2"), F.col("hi").alias("hi2")), ["recording_id", "chunk_index"]).withColumn("edf_event_index", F.col("lo2") + F.col("event_index") - F.col("lo"))
    edf = schedule(spark, sf_dir, "edf").select("recording_id", F.col("event_index").alias("edf_event_index"), F.col("type").alias("edf_type"))
    ok = there.where("edf_event_index <= hi2").join(edf, ["recording_id", "edf_event_index"]).where("edf_type = type")
    return ok.select("recording_id", F.col("event_index").alias("eeg_event_index"), "edf_event_index")


def _light(spark, sf_dir, side):
    """A schedule that loses few triggers, and none on the EDF side."""
    from pyspark.sql import Window

    latency, _ = (x.format(div="div") for x in views._SIDES[side])
    e = table(spark, sf_dir, "events")
    if side == "eeg":
        e = e.where("NOT (event_id % 50 >= 4 AND value < 0.03)")
    rows = e.select(F.expr(f"event_id div {views.EVENTS}").alias("recording_id"), F.expr(latency).cast("long").alias("latency"), F.expr("CASE WHEN event_id % 50 < 4 THEN '64' ELSE '63' END").alias("type"))
    return rows.withColumn("event_index", F.row_number().over(Window.partitionBy("recording_id").orderBy("latency")).cast("long"))


@query()
def matcher_summary(spark, sf_dir):
    """The pairing of every recording: where it starts and ends, and what stopped it."""
    from ..operators.matcher import match_recordings

    return match_recordings(_light(spark, sf_dir, "eeg"), _light(spark, sf_dir, "edf"), EEG_RATE, TRIGGER_RATE)


@query()
def matcher_history(spark, sf_dir):
    """Every comparison of two chunks, in order."""
    from ..operators.matcher import match_recordings

    return match_recordings(_light(spark, sf_dir, "eeg"), _light(spark, sf_dir, "edf"), EEG_RATE, TRIGGER_RATE, "history")


@query()
def matched_segment_table(spark, sf_dir):
    """Trusted segments with sample bounds and drift, replayed from the history."""
    from ..operators.replay import segment_recordings

    return segment_recordings(_light(spark, sf_dir, "eeg"), _light(spark, sf_dir, "edf"), EEG_RATE, TRIGGER_RATE)


_T = "event_id % 500 * 60.0 + value"
_PARTS = {
    "extents": "SELECT recording_id, (recording_id % 7 - 3) * 10.0 AS shift_hr, max(start_hr) + 20 - recording_id % 5 * 10 AS eeg_hr, max(start_hr) + 25.0 AS output_hr FROM parts GROUP BY recording_id",
    "segments": "SELECT recording_id, start_hr, end_hr FROM parts WHERE k < 5",
    "lost": "SELECT recording_id, start_hr, CASE WHEN k <> 5 OR event_id % 50 <> 0 THEN end_hr END AS end_hr FROM parts WHERE k IN (5, 6) AND event_id % 3 = 0",
    "interrupted": "SELECT recording_id, CASE WHEN event_id % 100 <> 7 OR event_id % 500 > 20 THEN start_hr END AS start_hr, start_hr + 0.75 AS end_hr FROM parts WHERE k = 7",
}


@query(f"""WITH parts AS (SELECT event_id, event_id // 500 AS recording_id, event_id % 10 AS k, ({_T}) / 3600 AS start_hr, ({_T}) / 3600 + 0.1 + value / 100 AS end_hr FROM events), {', '.join(f'{n} AS ({x})' for n, x in _PARTS.items())},
e AS (SELECT *, shift_hr + eeg_hr AS end_hr, least(0.0, shift_hr) AS low, greatest(output_hr, shift_hr + eeg_hr) AS high FROM extents),
told AS (
  SELECT recording_id, 4 AS p, 0.0 AS a, least(shift_hr, output_hr) AS b FROM e UNION ALL SELECT recording_id, 4, greatest(end_hr, 0.0), output_hr FROM e
  UNION ALL SELECT recording_id, 3, greatest(output_hr, shift_hr), end_hr FROM e UNION ALL SELECT recording_id, 3, shift_hr, least(0.0, end_hr) FROM e UNION ALL SELECT recording_id, 6, low, high FROM e
  UNION ALL SELECT s.recording_id, 5, greatest(s.start_hr, low), least(s.end_hr, high) FROM segments s JOIN e USING (recording_id)
  UNION ALL SELECT s.recording_id, 2, greatest(coalesce(s.start_hr, low), low), least(coalesce(s.end_hr, high), high) FROM lost s JOIN e USING (recording_id)
  UNION ALL SELECT s.recording_id, 1, greatest(coalesce(s.start_hr, low), low), least(coalesce(s.end_hr, high), high) FROM interrupted s JOIN e USING (recording_id)),
real AS (SELECT * FROM told WHERE a < b), cuts AS (SELECT recording_id, a AS x FROM real UNION SELECT recording_id, b FROM real),
pieces AS (SELECT recording_id, x, lead(x) OVER (PARTITION BY recording_id ORDER BY x) AS y FROM cuts),
kinds AS (SELECT c.recording_id, x, y, min(p) AS p FROM pieces c JOIN real r ON r.recording_id = c.recording_id AND r.a <= c.x AND r.b >= c.y WHERE y IS NOT NULL GROUP BY ALL),
marked AS (SELECT *, CASE WHEN p = lag(p) OVER w AND x = lag(y) OVER w THEN 0 ELSE 1 END AS new FROM kinds WINDOW w AS (PARTITION BY recording_id ORDER BY x)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY recording_id ORDER BY x) AS run FROM marked)
SELECT recording_id, ['excluded', 'lost', 'dropped', 'padded', 'trusted', 'uncertain'][p] AS kind, round(min(x), 9) AS start, round(max(y), 9) AS "end" FROM runs GROUP BY recording_id, run, p""")
def trust_timeline(spark, sf_dir):
    """Each recording's hours by class of trust, from constructed segments, losses and interruptions that overlap."""
    from ..operators import qa

    e = table(spark, sf_dir, "events").select("event_id", F.expr("event_id div 500").alias("recording_id"), F.expr("event_id % 10").alias("k"), (F.expr(_T) / 3600).alias("start_hr"), (F.expr(_T) / 3600 + 0.1 + F.col("value") / 100).alias("end_hr"))
    of = {n: spark.sql(x.replace("FROM parts", "FROM {parts}"), parts=e) for n, x in _PARTS.items()}
    rows = qa.trust_timeline(of["extents"], of["segments"], of["lost"], of["interrupted"])
    return rows.select("recording_id", "kind", F.round("start", 9).alias("start"), F.round("end", 9).alias("end"))
