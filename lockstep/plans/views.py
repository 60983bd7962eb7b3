"""Signal views of the driver's tables, each in Spark and in SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLES = 1000  # of one recording in the trace view
EVENTS = 500  # of one recording in the schedule view
TOLERANCE = 2 / 128
EEG_RATE, TRIGGER_RATE, EDF_RATE = 500, 128, 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.expr(f"event_id div {SAMPLES}").alias("recording_id"), F.expr(f"event_id % {SAMPLES} + 1").alias("sample"), (F.col("value") / 10).alias("volts"))


TRACE = f"trace AS (SELECT event_id // {SAMPLES} AS recording_id, event_id % {SAMPLES} + 1 AS sample, value / 10 AS volts FROM events)"

_SHAPE = """CASE WHEN value > 40 THEN 0 WHEN event_id % 23 BETWEEN 1 AND 3 THEN 36.5 WHEN event_id % 23 BETWEEN 4 AND 6 THEN 42.5
  WHEN event_id % 23 BETWEEN 8 AND 10 THEN 42.5 WHEN event_id % 23 BETWEEN 12 AND 14 THEN 36.5 WHEN event_id % 23 = 15 THEN 40
  WHEN event_id % 23 BETWEEN 16 AND 19 THEN 42.5 ELSE 0 END"""


def merged_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trace in which pulses of 63 and 64 run together."""
    return table(spark, sf_dir, "events").select(F.expr(f"event_id div {SAMPLES}").alias("recording_id"), F.expr(f"event_id % {SAMPLES} + 1").alias("sample"), F.expr(_SHAPE).cast("double").alias("volts"))


MERGED = f"trace AS (SELECT event_id // {SAMPLES} AS recording_id, event_id % {SAMPLES} + 1 AS sample, ({_SHAPE})::DOUBLE AS volts FROM events)"

_CODE = """CASE WHEN value > 45 THEN 'orphan' WHEN event_id % 40 = 0 THEN '1' WHEN event_id % 40 = 1 THEN '2' WHEN event_id % 40 = 2 THEN '4' WHEN event_id % 40 = 3 THEN '8'
  WHEN event_id % 40 = 4 THEN '16' WHEN event_id % 40 = 5 THEN '63' WHEN event_id % 40 = 6 THEN '64' WHEN event_id % 40 BETWEEN 7 AND 10 THEN '64'
  WHEN event_id % 40 BETWEEN 20 AND 23 THEN '64' WHEN event_id % 40 = 30 THEN '64' ELSE '63' END"""


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sequence of codes with validation sequences, runs of 64, and orphans."""
    return table(spark, sf_dir, "events").select(F.expr(f"event_id div {SAMPLES}").alias("recording_id"), F.expr(f"event_id % {SAMPLES} + 1").alias("event_index"), F.expr(f"(event_id % {SAMPLES}) * 64 + 1").alias("latency"), F.expr(_CODE).alias("type"))


CODES = f"codes AS (SELECT event_id // {SAMPLES} AS recording_id, event_id % {SAMPLES} + 1 AS event_index, (event_id % {SAMPLES}) * 64 + 1 AS latency, {_CODE} AS type FROM events)"

_CYCLE = f"(event_id % {EVENTS}) {{div}} 50"
_TIME = f"1725 * ({_CYCLE}) + 10 * (event_id % 50) + ((event_id % 50) * (event_id % 50 - 1)) {{div}} 2"
_SIDES = {
    "eeg": (f"500 * ({_TIME}) + 1", "NOT (event_id % 50 >= 4 AND value < 0.35)"),
    "edf": (f"CAST(round((({_TIME}) + 100) * 128 * (1 + 50e-6)) AS BIGINT) + 1", "NOT (event_id % 50 >= 4 AND value > 250)"),
}


def schedule(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """One side's triggers of paired recordings of ten cycles, with losses."""
    latency, kept = (x.format(div="div") for x in _SIDES[side])
    rows = table(spark, sf_dir, "events").where(F.expr(kept)).select(F.expr(f"event_id div {EVENTS}").alias("recording_id"), F.expr(latency).cast("long").alias("latency"), F.expr("CASE WHEN event_id % 50 < 4 THEN '64' ELSE '63' END").alias("type"))
    from pyspark.sql import Window

    return rows.withColumn("event_index", F.row_number().over(Window.partitionBy("recording_id").orderBy("latency")).cast("long"))


def schedule_sql(side: str) -> str:
    latency, kept = (x.format(div="//") for x in _SIDES[side])
    return f"{side} AS (SELECT recording_id, latency, type, row_number() OVER (PARTITION BY recording_id ORDER BY latency) AS event_index FROM (SELECT event_id // {EVENTS} AS recording_id, ({latency})::BIGINT AS latency, CASE WHEN event_id % 50 < 4 THEN '64' ELSE '63' END AS type FROM events WHERE {kept}))"


RATES = {"eeg": EEG_RATE, "edf": TRIGGER_RATE}


def chunk_sql(side: str, source: str | None = None) -> str:
    """CTEs up to {side}_chunks: events with times, chunks, positions and intervals."""
    rate = RATES[side]
    return f"""{source or schedule_sql(side)},
{side}_runs AS (SELECT recording_id, min(event_index) AS event_index FROM (
    SELECT *, event_index - row_number() OVER (PARTITION BY recording_id ORDER BY event_index) AS g FROM {side} WHERE type = '64') GROUP BY recording_id, g HAVING count(*) = 4),
{side}_n AS (SELECT e.*, (latency - 1) / {rate}::DOUBLE AS time_sec, sum(CASE WHEN r.event_index IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY e.recording_id ORDER BY e.event_index) AS c
    FROM {side} e LEFT JOIN {side}_runs r USING (recording_id, event_index)),
{side}_chunks AS (SELECT recording_id, event_index, latency, type, time_sec, (c - min(c) OVER (PARTITION BY recording_id) + 1)::INT AS chunk_index, c = 0 AS is_partial_start,
    lead(time_sec) OVER (PARTITION BY recording_id ORDER BY event_index) - time_sec AS interval_to_next_sec,
    row_number() OVER (PARTITION BY recording_id, c ORDER BY event_index) AS position FROM {side}_n)"""


def shape_sql(side: str) -> str:
    return chunk_sql(side) + f""",
{side}_shapes AS (SELECT recording_id, chunk_index, list(type ORDER BY position) AS types, list(interval_to_next_sec ORDER BY position) FILTER (interval_to_next_sec IS NOT NULL) AS gaps,
    min(event_index) AS start_event_index, max(event_index) AS end_event_index, min(latency) AS start_latency, min(time_sec) AS start_time_sec, count(*) AS observed_trigger_count,
    chunk_index < max(chunk_index) OVER (PARTITION BY recording_id) AS has_next_boundary, bool_or(is_partial_start) AS is_partial_start FROM {side}_chunks GROUP BY recording_id, chunk_index)"""


_EPS = "10 * pow(2.0, floor(log2(greatest(1.0, {}))) - 52)"


def pair_sql(side: str) -> str:
    worst = "list_max(list_transform(range(1, len(a.gaps) + 1), lambda i: abs(a.gaps[i] - b.gaps[i])))"
    return shape_sql(side) + f""",
{side}_whole AS (SELECT * FROM {side}_shapes WHERE has_next_boundary AND NOT is_partial_start),
{side}_pairs AS (SELECT a.recording_id, a.chunk_index, b.chunk_index AS other FROM {side}_whole a JOIN {side}_whole b ON a.recording_id = b.recording_id AND a.types = b.types
    WHERE len(a.gaps) = len(b.gaps) AND {worst} <= {TOLERANCE} + {_EPS.format("greatest(list_max(a.gaps), list_max(b.gaps))")}),
{side}_support AS (SELECT recording_id, chunk_index, count(*) AS support FROM {side}_pairs GROUP BY ALL),
{side}_top AS (SELECT * FROM (SELECT *, max(support) OVER (PARTITION BY recording_id) AS most FROM {side}_support) WHERE support = most),
{side}_chosen AS (SELECT t.recording_id, min(t.chunk_index) AS chosen, any_value(most) AS support FROM {side}_top t GROUP BY t.recording_id),
{side}_cons AS (SELECT c.*, EXISTS (SELECT 1 FROM {side}_top t WHERE t.recording_id = c.recording_id AND NOT EXISTS (SELECT 1 FROM {side}_pairs p WHERE p.recording_id = c.recording_id AND p.chunk_index = c.chosen AND p.other = t.chunk_index)) AS ambiguous FROM {side}_chosen c)"""


def cycle_sql(side: str) -> str:
    return pair_sql(side) + f""",
{side}_members AS (SELECT p.recording_id, p.other AS chunk_index FROM {side}_pairs p JOIN {side}_cons c ON p.recording_id = c.recording_id AND p.chunk_index = c.chosen WHERE c.support >= 2 AND NOT c.ambiguous),
{side}_mid AS (SELECT recording_id, position, any_value(type) AS type, median(interval_to_next_sec) AS interval_to_next_sec FROM {side}_chunks JOIN {side}_members USING (recording_id, chunk_index) GROUP BY recording_id, position),
{side}_past AS (SELECT *, coalesce(sum(interval_to_next_sec) OVER (PARTITION BY recording_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past FROM {side}_mid),
{side}_cycle AS (SELECT recording_id, position, type, interval_to_next_sec, past - first_value(past) OVER (PARTITION BY recording_id ORDER BY CASE WHEN type = '63' THEN 0 ELSE 1 END, position) AS relative_time_sec FROM {side}_past)"""


def edge_sql(side: str) -> str:
    return cycle_sql(side) + f""",
{side}_edges AS (SELECT * FROM (SELECT recording_id, chunk_index, position AS interval_number, type AS source_type, lead(type) OVER w AS destination_type, interval_to_next_sec AS interval_sec,
    event_index AS source_event_index, lead(event_index) OVER w AS destination_event_index FROM {side}_chunks WINDOW w AS (PARTITION BY recording_id ORDER BY event_index)) WHERE destination_event_index IS NOT NULL),
{side}_canon AS (SELECT recording_id, position AS interval_number, type AS source_type, coalesce(lead(type) OVER w, first_value(type) OVER w) AS destination_type, interval_to_next_sec AS interval_sec FROM {side}_cycle WINDOW w AS (PARTITION BY recording_id ORDER BY position))"""
