"""Queries over comparison histories: interval numbers, the lock, and trusted pairs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.lineage import computed
from ..operators import cycle, pairing
from .views import EEG_RATE, TOLERANCE, TRIGGER_RATE, edge_sql, schedule

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _side(spark, sf_dir, side):
    """A side's edges and its cycle's edges."""
    events = computed(cycle.followed(cycle.chunks(schedule(spark, sf_dir, side), {"eeg": EEG_RATE, "edf": TRIGGER_RATE}[side])))
    return cycle.edges(events), computed(cycle.canonical_edges(cycle.canonical(cycle.shapes(events), TOLERANCE)))


_CLOSE = f"coalesce({{a}}.s = {{b}}.s AND {{a}}.d = {{b}}.d AND abs({{a}}.v - {{b}}.v) <= {TOLERANCE} + 10 * pow(2.0, floor(log2(greatest(1.0, abs({{a}}.v), abs({{b}}.v)))) - 52), false)"
_EDGE = "list(struct_pack(n := interval_number, s := source_type, d := destination_type, v := interval_sec) ORDER BY interval_number)"


def lcs_sql(name: str, observed: str, reference: str) -> str:
    """CTEs up to {name}(recording_id, key, interval_number, canonical_number) for a recursive WITH."""
    return f"""{name}_e AS MATERIALIZED (SELECT o.recording_id, key, o, r, list_transform(o, lambda x: list_transform(r, lambda y: {_CLOSE.format(a='x', b='y')})) AS q
  FROM (SELECT recording_id, key, {_EDGE} AS o FROM {observed} GROUP BY ALL) o JOIN (SELECT recording_id, {_EDGE} AS r FROM {reference} GROUP BY ALL) r USING (recording_id)),
{name}_t AS (
  SELECT recording_id, key, len(o) AS i, list_transform(range(len(r) + 1), lambda x: 0) AS best FROM {name}_e
  UNION ALL SELECT recording_id, key, i, list_transform(range(1, len(own) + 1), lambda k: list_max(own[k:])) FROM (
    SELECT t.recording_id, t.key, t.i - 1 AS i, list_append(list_transform(q[t.i], lambda x, k: CASE WHEN x THEN t.best[k + 1] + 1 ELSE t.best[k] END), 0) AS own FROM {name}_t t JOIN {name}_e e USING (recording_id, key) WHERE t.i > 0)),
{name}_w AS (
  SELECT recording_id, key, 1 AS i, 1 AS j, NULL::BIGINT AS at, NULL::BIGINT AS number FROM {name}_e
  UNION ALL SELECT w.recording_id, w.key, w.i + CASE WHEN q[w.i][w.j] OR b.best[w.j] >= a.best[w.j + 1] THEN 1 ELSE 0 END, w.j + CASE WHEN q[w.i][w.j] OR b.best[w.j] < a.best[w.j + 1] THEN 1 ELSE 0 END,
    CASE WHEN q[w.i][w.j] THEN w.i END, CASE WHEN q[w.i][w.j] THEN r[w.j].n END
  FROM {name}_w w JOIN {name}_e e USING (recording_id, key) JOIN {name}_t a ON a.recording_id = w.recording_id AND a.key = w.key AND a.i = w.i - 1 JOIN {name}_t b ON b.recording_id = w.recording_id AND b.key = w.key AND b.i = w.i
  WHERE w.i <= len(o) AND w.j <= len(r)),
{name} AS (SELECT p.recording_id, p.key, p.interval_number, number AS canonical_number FROM (SELECT *, row_number() OVER (PARTITION BY recording_id, key ORDER BY interval_number) AS k FROM {observed}) p LEFT JOIN {name}_w h ON h.recording_id = p.recording_id AND h.key = p.key AND h.at = p.k)"""


@query(f"WITH RECURSIVE {edge_sql('eeg')}, o AS (SELECT recording_id, chunk_index AS key, interval_number, source_type, destination_type, interval_sec FROM eeg_edges), {lcs_sql('numbers', 'o', 'eeg_canon')} SELECT recording_id, key AS chunk_index, interval_number, canonical_number FROM numbers")
def canonical_numbers(spark, sf_dir):
    """The cycle's interval number of each observed interval, by longest common subsequence."""
    edges, canon = _side(spark, sf_dir, "eeg")
    return pairing.canonical_numbers(edges, canon, ["recording_id", "chunk_index"], ["recording_id"], TOLERANCE)


_OUTCOME = """CASE WHEN chunk_index = last THEN 'same_last_trigger' WHEN chunk_index = 1 AND recording_id % 2 = 0 THEN 'partial_start_match' WHEN d < 4 THEN 'match' WHEN d IN (4, 10) THEN 'shared_trigger_glitch'
  WHEN d IN (5, 8) THEN 'eeg_data_loss' WHEN d IN (6, 9) THEN 'edf_data_loss' ELSE 'both_systems_unusable' END"""
_HISTORY = {
    "position": "cast(chunk_index AS BIGINT)", "outcome": _OUTCOME, "eeg_chunk": "chunk_index", "edf_chunk": "chunk_index", "next_eeg_chunk": "CASE WHEN d <> 8 THEN chunk_index + 1 END", "next_edf_chunk": "CASE WHEN d <> 8 THEN chunk_index + 1 END",
    "eeg_first": "CASE WHEN chunk_index = 1 AND recording_id % 2 = 0 THEN 3 END", "first_number": "CASE WHEN chunk_index = 1 AND recording_id % 2 = 0 THEN 5 END", "common": "CASE WHEN chunk_index = last THEN n - recording_id % 3 END",
}


def history(eeg, edf):
    """Outcomes for all chunks that both sides have, many of each kind."""
    n = lambda e, name: e.groupBy("recording_id", "chunk_index").agg(F.count("*").alias(name))
    both = n(eeg, "a").join(n(edf, "b"), ["recording_id", "chunk_index"]).withColumn("n", F.least("a", "b")).withColumn("last", F.max("chunk_index").over(Window.partitionBy("recording_id")))
    return both.withColumn("d", F.expr("(recording_id * 3 + chunk_index * 7) % 11")).select("recording_id", *(F.expr(e).alias(c) for c, e in _HISTORY.items()))


_GAPS = "SELECT recording_id, CASE recording_id % 4 WHEN 0 THEN 100 + recording_id WHEN 1 THEN 200 END AS start, CASE recording_id % 4 WHEN 0 THEN 130 + recording_id WHEN 1 THEN 200 ELSE 12 END AS \"end\" FROM (SELECT DISTINCT recording_id FROM {}) r WHERE recording_id % 4 <> 2"


def gaps(events):
    e = events.select("recording_id").distinct().where("recording_id % 4 <> 2")
    return e.select("recording_id", F.expr("CASE recording_id % 4 WHEN 0 THEN 100 + recording_id WHEN 1 THEN 200 END").alias("start"), F.expr("CASE recording_id % 4 WHEN 0 THEN 130 + recording_id WHEN 1 THEN 200 ELSE 12 END").alias("end"))


_COVERS = "(({g}.start IS NULL AND {x} < {g}.\"end\") OR ({g}.\"end\" > {g}.start AND {x} >= {g}.start AND {x} < {g}.\"end\") OR ({g}.\"end\" <= {g}.start AND {x} = {g}.start))"


def _ends_sql(side: str) -> str:
    """Leading and trailing edges of each chunk that equal the cycle's."""
    run = "coalesce(list_position(list_transform(range(1, least(n, m) + 1), lambda i: {}), false), least(n, m) + 1) - 1"
    lead, trail = run.format(_CLOSE.format(a="o[i]", b="r[i]")), run.format(_CLOSE.format(a="o[n + 1 - i]", b="r[m + 1 - i]"))
    return f"""{side}_ends AS MATERIALIZED (SELECT recording_id, chunk_index, n, m, types, prefix, greatest(0, least(trail, n - prefix)) AS suffix FROM (
  SELECT recording_id, chunk_index, n, m, types, {lead} AS prefix, {trail} AS trail FROM (
    SELECT recording_id, chunk_index, o, r, len(o) AS n, len(r) AS m, list_transform(o, lambda x: x.s || '>' || x.d) AS types
    FROM (SELECT recording_id, chunk_index, {_EDGE} AS o FROM {side}_edges GROUP BY ALL) JOIN (SELECT recording_id, {_EDGE} AS r FROM {side}_canon GROUP BY ALL) USING (recording_id))))"""


_LOCK = f"""{edge_sql('eeg')}, {edge_sql('edf')}, {_ends_sql('eeg')}, {_ends_sql('edf')}, gaps AS ({_GAPS.format('eeg_edges')}),
counted AS (SELECT recording_id, chunk_index, least(a, b) AS n FROM (SELECT recording_id, chunk_index, count(*) AS a FROM eeg_edges GROUP BY ALL) JOIN (SELECT recording_id, chunk_index, count(*) AS b FROM edf_edges GROUP BY ALL) USING (recording_id, chunk_index)),
history AS (SELECT recording_id, {', '.join(f'{e} AS {c}' for c, e in _HISTORY.items())} FROM (SELECT *, max(chunk_index) OVER (PARTITION BY recording_id) AS last, (recording_id * 3 + chunk_index * 7) % 11 AS d FROM counted)),
judged AS MATERIALIZED (
  SELECT h.*, x.prefix AS xp, x.n AS xn, x.m AS xm, y.prefix AS yp, y.n AS yn, y.m AS ym,
    CASE WHEN next_eeg_chunk IS NULL THEN 0 WHEN outcome = 'eeg_data_loss' THEN x.suffix WHEN outcome = 'edf_data_loss' THEN y.suffix END AS s,
    outcome IN ('eeg_data_loss', 'edf_data_loss') AND x.n = y.n AND x.types = y.types
      AND EXISTS (SELECT 1 FROM eeg_edges e JOIN gaps g ON g.recording_id = e.recording_id WHERE e.recording_id = h.recording_id AND e.chunk_index = h.eeg_chunk AND {_COVERS.format(g='g', x='e.source_event_index')}) AS handled,
    row_number() OVER (PARTITION BY h.recording_id ORDER BY position) AS step
  FROM history h JOIN eeg_ends x ON x.recording_id = h.recording_id AND x.chunk_index = h.eeg_chunk JOIN edf_ends y ON y.recording_id = h.recording_id AND y.chunk_index = h.edf_chunk),
folded AS (
  SELECT recording_id, 0::BIGINT AS step, true AS locked FROM (SELECT DISTINCT recording_id FROM judged)
  UNION ALL SELECT f.recording_id, j.step, CASE WHEN outcome IN ('match', 'partial_start_match') THEN true WHEN outcome = 'both_systems_unusable' THEN false WHEN outcome IN ('eeg_data_loss', 'edf_data_loss') AND f.locked THEN handled OR s > 0 ELSE f.locked END
  FROM folded f JOIN judged j ON j.recording_id = f.recording_id AND j.step = f.step + 1),
told AS MATERIALIZED (SELECT j.*, f.locked FROM judged j JOIN folded f ON f.recording_id = j.recording_id AND f.step = j.step - 1)"""

_SPANS = """loss AS (SELECT *, outcome = 'eeg_data_loss' AS eeg FROM told WHERE outcome IN ('eeg_data_loss', 'edf_data_loss') AND locked),
clean AS (SELECT l.*, coalesce(CASE WHEN eeg THEN y.n ELSE x.n END, 0) AS cn FROM loss l LEFT JOIN eeg_ends x ON x.recording_id = l.recording_id AND x.chunk_index = l.next_eeg_chunk - 1 LEFT JOIN edf_ends y ON y.recording_id = l.recording_id AND y.chunk_index = l.next_edf_chunk - 1),
spans AS (
  SELECT recording_id, position, eeg_chunk, 1 AS ef, edf_chunk, 1 AS df, 1 AS nf, least(xn, yn) AS c, true AS whole FROM told WHERE outcome = 'match'
  UNION ALL SELECT recording_id, position, eeg_chunk, eeg_first, edf_chunk, 1, first_number, least(xn - eeg_first + 1, yn), true FROM told WHERE outcome = 'partial_start_match'
  UNION ALL SELECT recording_id, position, eeg_chunk, 1, edf_chunk, 1, NULL, least(xn, yn), true FROM told WHERE outcome = 'shared_trigger_glitch' AND locked
  UNION ALL SELECT recording_id, position, eeg_chunk, 1, edf_chunk, 1, 1, CASE WHEN handled THEN xn ELSE least(CASE WHEN eeg THEN xp ELSE yp END, xn, yn) END, true FROM loss
  UNION ALL SELECT recording_id, position, CASE WHEN eeg THEN eeg_chunk ELSE next_eeg_chunk - 1 END, CASE WHEN eeg THEN xn ELSE cn END - s + 1, CASE WHEN eeg THEN next_edf_chunk - 1 ELSE edf_chunk END, CASE WHEN eeg THEN cn ELSE yn END - s + 1,
    CASE WHEN eeg THEN xm ELSE ym END - s + 1, least(s, cn), true FROM clean WHERE NOT handled
  UNION ALL SELECT recording_id, position, eeg_chunk, 1, edf_chunk, 1, 1, least(xp, yp), true FROM told WHERE outcome = 'both_systems_unusable' AND locked
  UNION ALL SELECT recording_id, position, eeg_chunk, 1, edf_chunk, 1, NULL, least(common - 1, xn, yn), false FROM told WHERE outcome = 'same_last_trigger' AND locked)"""


@query(f"WITH RECURSIVE {_LOCK} SELECT recording_id, position, outcome, locked FROM told")
def lock_flags(spark, sf_dir):
    """Whether the alignment is locked before each comparison: rows that were told so by the last that sets or clears the flag."""
    (eeg, eeg_canon), (edf, edf_canon) = (_side(spark, sf_dir, s) for s in ("eeg", "edf"))
    return pairing.judged(history(eeg, edf), eeg, edf, eeg_canon, edf_canon, gaps(eeg), TOLERANCE).select("recording_id", "position", "outcome", "locked")


@query(f"""WITH RECURSIVE {_LOCK}, {_SPANS},
rows AS MATERIALIZED (SELECT s.recording_id, position, eeg_chunk, edf_chunk, e.interval_number AS en, nf + k AS known, whole, e.source_event_index AS es, e.destination_event_index AS ed, d.source_event_index AS ds, d.destination_event_index AS dd, e.source_type, e.destination_type, e.interval_sec
  FROM (SELECT *, unnest(range(0, c)) AS k FROM spans WHERE c > 0) s JOIN eeg_edges e ON e.recording_id = s.recording_id AND e.chunk_index = eeg_chunk AND e.interval_number = ef + k JOIN edf_edges d ON d.recording_id = s.recording_id AND d.chunk_index = edf_chunk AND d.interval_number = df + k),
oa AS (SELECT recording_id, position AS key, en AS interval_number, source_type, destination_type, interval_sec FROM rows WHERE known IS NULL AND whole),
ob AS (SELECT recording_id, position AS key, en AS interval_number, source_type, destination_type, interval_sec FROM rows WHERE known IS NULL AND NOT whole),
short AS (SELECT recording_id, interval_number, source_type, destination_type, interval_sec FROM (SELECT *, max(interval_number) OVER (PARTITION BY recording_id) AS z FROM eeg_canon) WHERE interval_number < z),
{lcs_sql('na', 'oa', 'eeg_canon')}, {lcs_sql('nb', 'ob', 'short')}
SELECT r.recording_id, r.position, es AS eeg_source, ed AS eeg_destination, ds AS edf_source, dd AS edf_destination, eeg_chunk, edf_chunk, coalesce(known, na.canonical_number, nb.canonical_number) AS interval_number
FROM rows r LEFT JOIN na ON na.recording_id = r.recording_id AND na.key = r.position AND na.interval_number = en AND known IS NULL LEFT JOIN nb ON nb.recording_id = r.recording_id AND nb.key = r.position AND nb.interval_number = en AND known IS NULL
WHERE NOT EXISTS (SELECT 1 FROM gaps g WHERE g.recording_id = r.recording_id AND {_COVERS.format(g='g', x='es')})""")
def replayed_pairs(spark, sf_dir):
    """All trusted pairs of intervals of the constructed histories."""
    (eeg, eeg_canon), (edf, edf_canon) = (_side(spark, sf_dir, s) for s in ("eeg", "edf"))
    return pairing.interval_pairs(history(eeg, edf), eeg, edf, eeg_canon, edf_canon, gaps(eeg), TOLERANCE)
