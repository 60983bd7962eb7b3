"""Queries over trigger traces, event tables and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cycle, ordered, triggers
from . import views
from .views import CODES, EEG_RATE, MERGED, TOLERANCE, TRACE, TRIGGER_RATE, codes, cycle_sql, edge_sql, merged_trace, pair_sql, schedule, table, trace

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_RUNS = "SELECT recording_id, min(sample) AS latency, max(sample) AS \"end\", max(volts) AS max_value FROM (SELECT *, sample - row_number() OVER (PARTITION BY recording_id ORDER BY sample) AS g FROM trace WHERE volts > 1) GROUP BY recording_id, g"
_BAND = "CASE WHEN max_value BETWEEN 5 AND 6 THEN '1' WHEN max_value BETWEEN 11 AND 12.1 THEN '2' WHEN max_value BETWEEN 18 AND 19 THEN '4' WHEN max_value BETWEEN 24 AND 25 THEN '8' WHEN max_value BETWEEN 30 AND 31 THEN '16' WHEN max_value BETWEEN 36 AND 37 THEN '63' WHEN max_value BETWEEN 42 AND 43 THEN '64' ELSE 'orphan' END"


@query(f"WITH {TRACE} {_RUNS}")
def pulse_runs(spark, sf_dir):
    return triggers.pulses(trace(spark, sf_dir)).drop("type")


@query(f"WITH {TRACE} SELECT recording_id, latency, max_value, {_BAND} AS type FROM ({_RUNS}) WHERE {_BAND} <> 'orphan'")
def pulse_classify(spark, sf_dir):
    return triggers.pulses(trace(spark, sf_dir)).drop("end").where("type <> 'orphan'")


@query(f"WITH {TRACE}, runs AS ({_RUNS}) SELECT recording_id, count(*) AS pulses, count(*) FILTER ({_BAND} = 'orphan') AS orphans, max(\"end\" - latency + 1) AS longest FROM runs GROUP BY recording_id")
def pulse_counts(spark, sf_dir):
    p = triggers.pulses(trace(spark, sf_dir))
    return p.groupBy("recording_id").agg(F.count("*").alias("pulses"), F.count_if(F.col("type") == "orphan").alias("orphans"), F.max(F.col("end") - F.col("latency") + 1).alias("longest"))


@query(f"""WITH {MERGED}, r AS (SELECT *, sample - row_number() OVER (PARTITION BY recording_id ORDER BY sample) AS g FROM trace WHERE volts > 1),
whole AS (SELECT recording_id, g, min(sample) AS latency, max(sample) AS stop FROM r GROUP BY recording_id, g),
b AS (SELECT recording_id, g, sample, CASE WHEN volts BETWEEN 36 AND 37 THEN '63' WHEN volts BETWEEN 42 AND 43 THEN '64' END AS band FROM r),
parts AS (SELECT recording_id, g, band, min(sample) AS a, max(sample) AS z FROM (SELECT *, sample - row_number() OVER (PARTITION BY recording_id, g, band ORDER BY sample) AS k FROM b WHERE band IS NOT NULL) GROUP BY recording_id, g, band, k HAVING count(*) >= 3),
pairs AS (SELECT q.recording_id, q.g, q.a AS start64, (SELECT max(p.z) FROM parts p WHERE p.recording_id = q.recording_id AND p.g = q.g AND p.band = '63' AND p.a < q.a) AS end63 FROM parts q WHERE q.band = '64'),
cut AS (SELECT recording_id, g, min(start64) AS start64, arg_min(end63, start64) AS end63 FROM pairs WHERE end63 IS NOT NULL GROUP BY recording_id, g)
SELECT recording_id, latency, coalesce(end63, stop) AS "end" FROM whole LEFT JOIN cut USING (recording_id, g)
UNION ALL SELECT recording_id, start64, stop FROM whole JOIN cut USING (recording_id, g)""")
def merged_pulse_split(spark, sf_dir):
    return triggers.split_pulses(merged_trace(spark, sf_dir))


def _pattern(types) -> str:
    return " AND ".join(f"lead(type, {i}) OVER w = '{t}'" if i else f"type = '{t}'" for i, t in enumerate(types))


_W = "WINDOW w AS (PARTITION BY recording_id ORDER BY event_index)"
_RELABELLED = f"""{CODES}, m AS (SELECT *, coalesce({_pattern(triggers.RAW_VALIDATION)}, false) AS hit FROM codes {_W}),
relabelled AS (SELECT recording_id, event_index, latency, CASE WHEN coalesce(lag(hit, 5) OVER w, false) THEN '32' ELSE type END AS type FROM m {_W}),
v AS (SELECT *, coalesce({_pattern(triggers.VALIDATION)}, false) AS hit FROM relabelled {_W}),
marked AS (SELECT recording_id, event_index, latency, type, hit AS is_start, coalesce(max(hit::INT) OVER (PARTITION BY recording_id ORDER BY event_index ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0) = 1 AS is_validation FROM v)"""


@query(f"WITH {_RELABELLED} SELECT recording_id, event_index, latency, type FROM relabelled")
def validation_relabel(spark, sf_dir):
    return triggers.relabel(codes(spark, sf_dir))


@query(f"WITH {_RELABELLED} SELECT recording_id, start_latency, end_latency, start_latency = max(start_latency) OVER (PARTITION BY recording_id) AS is_authoritative FROM (SELECT recording_id, latency AS start_latency, lead(latency, 6) OVER (PARTITION BY recording_id ORDER BY event_index) AS end_latency, is_start FROM marked) WHERE is_start")
def validation_sequences(spark, sf_dir):
    return triggers.validation_sequences(triggers.relabel(codes(spark, sf_dir)))


_BAD = f"""{_RELABELLED}, g AS (SELECT *, event_index - row_number() OVER (PARTITION BY recording_id, type ORDER BY event_index) AS g FROM marked),
kept AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY recording_id, type, g) AS n, first_value(is_validation) OVER (PARTITION BY recording_id, type, g ORDER BY event_index) AS led FROM g) WHERE type <> '64' OR n = 4 OR (n = 5 AND led))"""


@query(f"WITH {_BAD} SELECT recording_id, event_index, latency, type, is_validation FROM kept")
def bad_run_removal(spark, sf_dir):
    return triggers.drop_malformed(triggers.relabel(codes(spark, sf_dir))).drop("is_start")


@query(f"WITH {_BAD} SELECT recording_id, count(*) AS kept, count(*) FILTER (latency < (SELECT max(m.latency) FROM marked m WHERE m.recording_id = k.recording_id AND m.is_start)) AS before_validation FROM kept k WHERE type <> 'orphan' AND NOT is_validation GROUP BY recording_id")
def authoritative_validation(spark, sf_dir):
    """Kept triggers, and how many precede the last validation sequence."""
    raw = triggers.relabel(codes(spark, sf_dir))
    last = triggers.validation_sequences(raw).where("is_authoritative").select("recording_id", "start_latency")
    kept = triggers.drop_malformed(raw).where("type <> 'orphan' and not is_validation")
    return kept.join(last, "recording_id", "left").groupBy("recording_id").agg(F.count("*").alias("kept"), F.count_if(F.col("latency") < F.col("start_latency")).alias("before_validation"))


@query(f"WITH {CODES} SELECT DISTINCT recording_id, type FROM codes WHERE type NOT IN ('63', '64')")
def type_whitelist(spark, sf_dir):
    return triggers.unexpected_types(codes(spark, sf_dir))


_TEXT = "concat(' ', CASE event_type WHEN 'error' THEN '9001, off' WHEN 'click' THEN 'Impedance check' WHEN 'view' THEN 'BOUNDARY' ELSE event_type END, ' ')"
_CODE_SQL = "trim(split_part(trim(type), ',', 1))"


@query(f"""SELECT event_id, trim(type) AS text, {_CODE_SQL} AS code,
CASE WHEN lower(trim(type)) LIKE '%impedance%' THEN 'impedance' WHEN lower(trim(type)) = 'boundary' THEN 'boundary' WHEN {_CODE_SQL} IN ('9001', '9002') THEN 'marker' ELSE 'candidate' END AS kind FROM (SELECT event_id, {_TEXT} AS type FROM events)""")
def event_classes(spark, sf_dir):
    return triggers.normalise(table(spark, sf_dir, "events").select("event_id", F.expr(_TEXT).alias("type"))).drop("type")


@query(f"SELECT recording_id, list(code ORDER BY event_id) = ['error', 'view'] AS is_validation, string_agg(code, ',' ORDER BY event_id) AS codes FROM (SELECT event_id // {views.SAMPLES} AS recording_id, event_id, event_type AS code, row_number() OVER (PARTITION BY event_id // {views.SAMPLES} ORDER BY event_id) AS n FROM events WHERE event_type IN ('error', 'view')) WHERE n <= 7 GROUP BY recording_id")
def leading_codes(spark, sf_dir):
    """The first seven candidates of each recording, compared with a sequence."""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "view")).select(F.expr(f"event_id div {views.SAMPLES}").alias("recording_id"), "event_id", F.col("event_type").alias("code"))
    first = e.withColumn("n", F.row_number().over(Window.partitionBy("recording_id").orderBy("event_id"))).where("n <= 7")
    got = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "code"))), lambda x: x["code"])
    return first.groupBy("recording_id").agg(got.alias("got")).select("recording_id", (F.col("got") == F.array(F.lit("error"), F.lit("view"))).alias("is_validation"), F.array_join("got", ",").alias("codes"))


_MARKS = f"marks AS (SELECT event_id // {views.SAMPLES} AS recording_id, event_id AS raw_event_index, event_id * 10 AS latency, CASE WHEN event_id % 26 = 0 THEN '9001' ELSE '9002' END AS code FROM events WHERE event_id % 13 = 0 AND value < 60)"


def _marks(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_id % 13 = 0 and value < 60").select(F.expr(f"event_id div {views.SAMPLES}").alias("recording_id"), F.col("event_id").alias("raw_event_index"), (F.col("event_id") * 10).alias("latency"), F.expr("CASE WHEN event_id % 26 = 0 THEN '9001' ELSE '9002' END").alias("code"))


@query(f"""WITH {_MARKS}, s AS (SELECT *, lag(code) OVER w AS before, lead(code) OVER w AS after, lead(latency) OVER w AS nl, lead(raw_event_index) OVER w AS ni FROM marks WINDOW w AS (PARTITION BY recording_id ORDER BY raw_event_index)),
p AS (SELECT *, CASE WHEN code = '9001' AND after = '9001' THEN 'double_disconnect' WHEN code = '9002' AND coalesce(before, '') <> '9001' THEN 'orphan_reconnect' WHEN code = '9001' AND nl < latency THEN 'reconnect_before_disconnect' END AS problem FROM s)
SELECT recording_id, raw_event_index AS disconnect_index, latency AS disconnect_latency, CASE WHEN after = '9002' THEN ni END AS reconnect_index, CASE WHEN after = '9002' THEN nl END AS reconnect_latency,
CASE WHEN problem IS NULL THEN CASE WHEN after IS NULL THEN 'missing_reconnect' ELSE 'paired' END END AS pairing_status, problem FROM p WHERE code = '9001' OR problem IS NOT NULL""")
def amplifier_pairs(spark, sf_dir):
    return triggers.amplifier_pairs(_marks(spark, sf_dir))


_LEFT = f"marks AS (SELECT event_id // {views.SAMPLES} AS recording_id, event_id, ts FROM events WHERE event_type = 'error'), trig AS (SELECT event_id // {views.SAMPLES} AS recording_id, event_id AS trigger_id, ts FROM events WHERE event_type <> 'error' AND value > 20)"


def _anchors(spark, sf_dir, forward):
    e = table(spark, sf_dir, "events").withColumn("recording_id", F.expr(f"event_id div {views.SAMPLES}"))
    left, right = e.where("event_type = 'error'").select("recording_id", "event_id", "ts"), e.where("event_type <> 'error' and value > 20").select("recording_id", F.col("event_id").alias("trigger_id"), "ts")
    return ordered.as_of(left, right, ["recording_id"], "ts", "trigger_id", "anchor", forward).select("recording_id", "event_id", "anchor")


@query(f"WITH {_LEFT} SELECT m.recording_id, m.event_id, t.trigger_id AS anchor FROM marks m ASOF LEFT JOIN trig t ON m.recording_id = t.recording_id AND m.ts >= t.ts")
def anchor_backward(spark, sf_dir):
    return _anchors(spark, sf_dir, False)


@query(f"WITH {_LEFT} SELECT m.recording_id, m.event_id, t.trigger_id AS anchor FROM marks m ASOF LEFT JOIN trig t ON m.recording_id = t.recording_id AND m.ts <= t.ts")
def anchor_forward(spark, sf_dir):
    return _anchors(spark, sf_dir, True)


@query(f"WITH {TRACE}, p AS (SELECT recording_id, latency, max_value, {_BAND} AS type, (latency - 1) / 128.0::DOUBLE AS time_sec FROM ({_RUNS})) SELECT *, time_sec - lag(time_sec) OVER (PARTITION BY recording_id ORDER BY latency) AS interval_sec FROM p")
def trigger_intervals(spark, sf_dir):
    return triggers.intervals(triggers.pulses(trace(spark, sf_dir)).drop("end"), TRIGGER_RATE, "latency")


@query(f"WITH {TRACE} SELECT recording_id, count(*) / 128.0::DOUBLE / 3600 AS duration_hr FROM trace GROUP BY recording_id")
def recording_duration(spark, sf_dir):
    return trace(spark, sf_dir).groupBy("recording_id").agg((F.count("*") / TRIGGER_RATE / 3600).alias("duration_hr"))


def eeg_chunks(spark, sf_dir, side="eeg"):
    return cycle.chunks(schedule(spark, sf_dir, side), views.RATES[side])


def eeg_cycle(spark, sf_dir, side="eeg"):
    events = eeg_chunks(spark, sf_dir, side)
    shapes = cycle.shapes(events)
    return events, shapes, cycle.canonical(shapes, TOLERANCE)


_C = "list_transform(range(1, len(gaps) + 1), lambda i: abs(gaps[i] - cg[i]))"


def _report_sql(side):
    eps = "10 * pow(2.0, floor(log2(greatest(1.0, list_max(gaps), list_max(cg)))) - 52)"
    same = "(types = ct AND len(gaps) = len(cg))"
    return f"""WITH {cycle_sql(side)},
c AS (SELECT recording_id, list(type ORDER BY position) AS ct, list(interval_to_next_sec ORDER BY position) AS cg, sum(interval_to_next_sec) AS canon FROM {side}_cycle GROUP BY recording_id),
j AS (SELECT s.*, c.ct, c.cg, c.canon, CASE WHEN has_next_boundary THEN list_sum(gaps) END AS chunk_duration_sec FROM {side}_shapes s JOIN c USING (recording_id)),
k AS (SELECT *, CASE WHEN chunk_duration_sec IS NOT NULL THEN greatest(1, round(chunk_duration_sec / canon))::DOUBLE END AS estimated_cycle_count, CASE WHEN {same} THEN list_max({_C}) END AS max_interval_error_sec FROM j),
l AS (SELECT *, coalesce({same} AND max_interval_error_sec <= {TOLERANCE} + {eps}, false) AS ok FROM k)
SELECT recording_id, chunk_index, start_event_index, end_event_index, start_latency, start_time_sec, observed_trigger_count, chunk_duration_sec, has_next_boundary, estimated_cycle_count,
CASE WHEN is_partial_start THEN 'partial_start' WHEN NOT has_next_boundary THEN 'partial_end' WHEN ok THEN 'match' WHEN estimated_cycle_count > 1 THEN 'ambiguous' ELSE 'mismatch' END AS status,
CASE WHEN is_partial_start THEN 'before_first_boundary' WHEN NOT has_next_boundary THEN 'no_next_boundary' WHEN ok THEN 'canonical_match' WHEN estimated_cycle_count > 1 THEN 'suspected_missing_boundary'
  WHEN len(types) <> len(ct) THEN 'trigger_count' WHEN types <> ct THEN 'trigger_types' ELSE 'interval_timing' END AS reason, max_interval_error_sec FROM l"""


@query(_report_sql("eeg"))
def chunk_report(spark, sf_dir):
    events, shapes, canon = eeg_cycle(spark, sf_dir)
    return cycle.report(shapes, canon, TOLERANCE)


@query(_report_sql("edf"))
def chunk_report_edf(spark, sf_dir):
    events, shapes, canon = eeg_cycle(spark, sf_dir, "edf")
    return cycle.report(shapes, canon, TOLERANCE)


@query(f"SELECT recording_id, count(*) FILTER (status = 'match') AS repeat_count FROM ({_report_sql('eeg')}) GROUP BY recording_id")
def repeat_counts(spark, sf_dir):
    """How often each recording repeats its cycle."""
    return cycle.repeat_counts(chunk_report(spark, sf_dir))


@query(f"WITH {pair_sql('eeg')} SELECT * FROM eeg_pairs")
def cycle_compat(spark, sf_dir):
    return cycle.compatible(cycle.shapes(eeg_chunks(spark, sf_dir)), TOLERANCE)


@query(f"WITH {pair_sql('eeg')} SELECT * FROM eeg_cons")
def cycle_support(spark, sf_dir):
    return cycle.consensus(cycle.compatible(cycle.shapes(eeg_chunks(spark, sf_dir)), TOLERANCE))


@query(f"WITH {cycle_sql('edf')} SELECT recording_id, position, type, relative_time_sec, interval_to_next_sec FROM edf_cycle")
def canonical_cycle(spark, sf_dir):
    return eeg_cycle(spark, sf_dir, "edf")[2].select("recording_id", "position", "type", "relative_time_sec", "interval_to_next_sec")


@query(f"WITH {edge_sql('eeg')} SELECT * FROM eeg_edges")
def edges(spark, sf_dir):
    return cycle.edges(eeg_chunks(spark, sf_dir))


@query(f"WITH {edge_sql('eeg')} SELECT * FROM eeg_canon")
def canonical_edges(spark, sf_dir):
    return cycle.canonical_edges(eeg_cycle(spark, sf_dir)[2])


_EDGE_SAME = "coalesce(a.source_type = b.source_type AND a.destination_type = b.destination_type AND abs(a.interval_sec - b.interval_sec) <= {tol} + 10 * pow(2.0, floor(log2(greatest(1.0, abs(a.interval_sec), abs(b.interval_sec)))) - 52), false)".replace("{tol}", str(TOLERANCE))


@query(f"""WITH {edge_sql('eeg')},
o AS (SELECT *, max(interval_number) OVER (PARTITION BY recording_id, chunk_index) AS n FROM eeg_edges),
r AS (SELECT k.recording_id, k.chunk_index, c.interval_number, c.source_type, c.destination_type, c.interval_sec, max(c.interval_number) OVER (PARTITION BY k.recording_id, k.chunk_index) AS n
  FROM (SELECT DISTINCT recording_id, chunk_index FROM eeg_edges) k JOIN eeg_canon c USING (recording_id)),
p AS (SELECT recording_id, chunk_index, coalesce(min(CASE WHEN NOT {_EDGE_SAME} THEN interval_number END), max(interval_number) + 1) - 1 AS prefix FROM o a FULL JOIN r b USING (recording_id, chunk_index, interval_number) GROUP BY ALL),
s AS (SELECT recording_id, chunk_index, coalesce(min(CASE WHEN NOT {_EDGE_SAME} THEN pos END), max(pos) + 1) - 1 AS suffix FROM (SELECT *, n + 1 - interval_number AS pos FROM o) a FULL JOIN (SELECT *, n + 1 - interval_number AS pos FROM r) b USING (recording_id, chunk_index, pos) GROUP BY ALL),
n AS (SELECT recording_id, chunk_index, any_value(o.n) AS n_observed FROM o GROUP BY ALL), m AS (SELECT recording_id, chunk_index, any_value(r.n) AS n_reference FROM r GROUP BY ALL)
SELECT recording_id, chunk_index, prefix, greatest(0, least(suffix, least(n_observed, n_reference) - prefix)) AS suffix, n_observed, n_reference FROM p JOIN s USING (recording_id, chunk_index) JOIN n USING (recording_id, chunk_index) JOIN m USING (recording_id, chunk_index)""")
def edge_prefix_suffix(spark, sf_dir):
    events, _, canon = eeg_cycle(spark, sf_dir)
    return cycle.prefix_suffix(cycle.edges(events), cycle.canonical_edges(canon), ["recording_id", "chunk_index"], ["recording_id"], TOLERANCE)


@query(f"""WITH {edge_sql('eeg')},
t AS (SELECT recording_id, chunk_index, row_number() OVER (PARTITION BY recording_id, chunk_index ORDER BY interval_number) - 1 AS k, source_type, destination_type, interval_sec FROM eeg_edges WHERE interval_number BETWEEN 20 AND 25),
h AS (SELECT t.recording_id, t.chunk_index, b.interval_number - t.k AS "offset" FROM t a JOIN t USING (recording_id, chunk_index, k) JOIN eeg_canon b ON b.recording_id = a.recording_id AND {_EDGE_SAME}),
z AS (SELECT recording_id, chunk_index, count(*) AS need FROM t GROUP BY ALL)
SELECT h.recording_id, h.chunk_index, h."offset" FROM h JOIN z ON h.recording_id = z.recording_id AND h.chunk_index = z.chunk_index GROUP BY h.recording_id, h.chunk_index, h."offset", z.need HAVING count(*) = z.need""")
def phase_candidates(spark, sf_dir):
    """Offsets of the cycle at which a few edges of each chunk match."""
    from ..operators.segments import sequence_starts

    events, _, canon = eeg_cycle(spark, sf_dir)
    target = cycle.edges(events).where("interval_number between 20 and 25")
    return sequence_starts(target, cycle.canonical_edges(canon), ["recording_id", "chunk_index"], TOLERANCE)


@query(f"WITH {views.chunk_sql('eeg')}, b AS (SELECT recording_id, chunk_index, min(event_index) AS lo, max(event_index) AS hi FROM eeg_chunks GROUP BY ALL) SELECT e.recording_id, e.event_index, b.chunk_index FROM eeg e JOIN b ON e.recording_id = b.recording_id AND e.event_index BETWEEN b.lo AND b.hi")
def chunk_of_event(spark, sf_dir):
    """The chunk that holds each event, by interval containment."""
    from ..operators.segments import containing

    events = schedule(spark, sf_dir, "eeg")
    shapes = cycle.shapes(cycle.chunks(events, EEG_RATE)).select("recording_id", "chunk_index", "start_event_index", "end_event_index")
    return containing(events, shapes, "event_index", "start_event_index", "end_event_index").select("recording_id", "event_index", "chunk_index")
