"""Queries of the pairing with marked interruptions and start-up counts, over constructed recordings.

Each supplier stands for a pair of recordings with the same schedule of five cycles of fifty triggers; its number decides what
happened to it. What must come out follows from that by arithmetic, which is what the SQL counterparts state.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matcher, replay, triggers
from .views import EEG_RATE, TRIGGER_RATE, table

QUERIES, ORACLE = {}, {}
CYCLES, LENGTH = 5, 50
#: Seconds of a trigger (from 0) of the schedule: cycles of 1725 s, with gaps of 10, 11, 12, ... s within.
_SECONDS = "1725 * (e div 50) + 10 * (e % 50) + ((e % 50) * (e % 50 - 1)) div 2"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def recordings(spark, sf_dir):
    """recording_id and e, from 0, of all triggers."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("recording_id"))
    return ids.withColumn("e", F.explode(F.sequence(F.lit(0), F.lit(CYCLES * LENGTH - 1))))


def side(rows, rate: float, late: int = 0, where: str = "true", moved: str = "0"):
    """Triggers in order: latency in samples from 1, moved by so many samples."""
    kind = F.when(F.expr("e % 50 < 4"), "64").otherwise("63")
    latency = F.expr(f"({late} + {_SECONDS}) * {int(rate)} + 1 + ({moved})")
    kept = rows.where(where).select("recording_id", "e", latency.cast("long").alias("latency"), kind.alias("type"))
    before = F.row_number().over(triggers.Window.partitionBy("recording_id").orderBy("e"))
    return kept.withColumn("event_index", before.cast("long")).drop("e")


#: After the seventieth trigger: a loss of a second, of 7 samples, of none, none with a reconnection fifty triggers later; in the last case a gap before the third trigger.
_MOVED = "CASE WHEN e >= 70 THEN element_at(array(-500, -7, 0, 0, 0), CAST(recording_id % 5 AS INT) + 1) ELSE 0 END"


def interrupted(spark, sf_dir):
    """EEG triggers, EDF triggers, and interruptions from markers of disconnection (9001) and reconnection (9002)."""
    rows = recordings(spark, sf_dir)
    eeg, edf = side(rows, EEG_RATE, moved=_MOVED), side(rows, TRIGGER_RATE, late=100)
    past = F.element_at(F.array(*map(F.lit, (71, 71, 73, 120, 3))), (F.col("recording_id") % 5 + 1).cast("int"))
    told = eeg.withColumn("past", past).withColumn("last", F.when(F.col("recording_id") % 5 < 4, 70))
    down = told.where("event_index = last").select("recording_id", (F.col("latency") + 1).alias("latency"), F.lit("9001").alias("code"))
    first = told.where("last is null and event_index = 1").select("recording_id", F.col("latency") - 1, F.lit("9001"))
    up = told.where("event_index = past").select("recording_id", (F.col("latency") - 1).alias("latency"), F.lit("9002").alias("code"))
    markers = down.union(first).union(up).withColumn("raw_event_index", F.col("latency") * 10 + F.when(F.col("code") == "9002", 1).otherwise(0))
    return eeg, edf, triggers.interruption_anchors(triggers.amplifier_pairs(markers), eeg)


@query("""
SELECT s_suppkey::BIGINT AS recording_id, 1 AS interruption_index, 1 AS "group",
  CASE s_suppkey % 5 WHEN 1 THEN 'retained_within_tolerance' WHEN 3 THEN 'manual_review' WHEN 4 THEN 'leading_relocked' ELSE 'excluded_and_relocked' END AS status,
  s_suppkey % 5 IN (0, 2, 4) AS excluded,
  CASE WHEN s_suppkey % 5 < 4 THEN 70 END AS eeg_start, CASE s_suppkey % 5 WHEN 2 THEN 73 WHEN 3 THEN 120 WHEN 4 THEN 3 ELSE 71 END AS eeg_end
FROM supplier
""")
def matcher_interruptions(spark, sf_dir):
    """How each marked interruption was resolved."""
    eeg, edf, gaps = interrupted(spark, sf_dir)
    return matcher.match_recordings(eeg, edf, EEG_RATE, TRIGGER_RATE, "interruptions", gaps).drop("edf_start", "edf_end")


_LATENCY = "((1725 * (({e} - 1) // 50) + 10 * (({e} - 1) % 50) + (({e} - 1) % 50) * (({e} - 1) % 50 - 1) // 2) * 500 + 1)::BIGINT"
_EDF = "((100 + 1725 * (({e} - 1) // 50) + 10 * (({e} - 1) % 50) + (({e} - 1) % 50) * (({e} - 1) % 50 - 1) // 2) * 128 + 1)::BIGINT"


@query(f"""
WITH kinds(k, segment_index, a, z, moved) AS (VALUES (0, 1, 1, 70, 0), (0, 2, 71, 250, -500), (1, 1, 1, 250, 0), (2, 1, 1, 70, 0), (2, 2, 73, 250, 0), (3, 1, 1, 101, 0), (4, 1, 3, 250, 0))
SELECT s_suppkey::BIGINT AS recording_id, segment_index, {_LATENCY.format(e="a")} + moved AS eeg_start_sample,
  {_LATENCY.format(e="z")} + CASE WHEN k = 1 THEN -7 ELSE moved END AS eeg_end_sample, {_EDF.format(e="a")} AS edf_start_sample, {_EDF.format(e="z")} AS edf_end_sample, NULL::VARCHAR AS error
FROM supplier JOIN kinds ON k = s_suppkey % 5
""")
def segments_with_gaps(spark, sf_dir):
    """Trusted segments: those of both sides of an excluded interruption."""
    eeg, edf, gaps = interrupted(spark, sf_dir)
    found = replay.segment_recordings(eeg, edf, EEG_RATE, TRIGGER_RATE, gaps)
    return found.select("recording_id", "segment_index", "eeg_start_sample", "eeg_end_sample", "edf_start_sample", "edf_end_sample", "error")


@query("""
SELECT s_suppkey::BIGINT AS recording_id,
  CASE s_suppkey % 5 WHEN 4 THEN 'failed' ELSE 'terminal_anchor_identified' END AS status,
  CASE s_suppkey % 5 WHEN 0 THEN 'partial_cycle_late_start' WHEN 1 THEN 'restart_at_last_validation' WHEN 2 THEN 'normal_validation_start' ELSE 'legacy_startup' END AS startup,
  CASE s_suppkey % 5 WHEN 0 THEN 25 WHEN 4 THEN NULL ELSE 1 END AS eeg_anchor, CASE s_suppkey % 5 WHEN 1 THEN 51 WHEN 4 THEN NULL ELSE 1 END AS edf_anchor,
  CASE s_suppkey % 5 WHEN 4 THEN 'match_triggers:PartialStartRequiresValidationMetadata' END AS error
FROM supplier
""")
def matcher_startup(spark, sf_dir):
    """Where the pairing starts, by what is known of the EDF side's validation sequences: a start within a cycle, a restart, one sequence, and nothing known."""
    rows = recordings(spark, sf_dir)
    edf = side(rows, TRIGGER_RATE, late=100, where="recording_id % 5 not in (0, 4) or e >= 24")
    known = rows.where("recording_id % 5 < 3").select("recording_id").distinct()
    count = lambda *x: F.element_at(F.array(*map(F.lit, x)), (F.col("recording_id") % 5 + 1).cast("int"))
    startup = known.select("recording_id", count(0, 2, 1, 0, 0).alias("validations"), count(0, 50, 0, 0, 0).alias("before_last"))
    found = matcher.match_recordings(side(rows, EEG_RATE), edf, EEG_RATE, TRIGGER_RATE, startup=startup)
    return found.select("recording_id", "status", "startup", "eeg_anchor", "edf_anchor", "error")


@query("""
SELECT s_suppkey::BIGINT AS recording_id, CASE s_suppkey % 3 WHEN 0 THEN 0 ELSE s_suppkey % 3 END::INT AS validations, CASE s_suppkey % 3 WHEN 2 THEN 20 ELSE 0 END AS before_last FROM supplier
""")
def startup_counts(spark, sf_dir):
    """Validation sequences in a recording's triggers, none, one, or two with twenty triggers between, and the kept triggers before the last."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("recording_id"))
    codes = F.array(*map(F.lit, triggers.RAW_VALIDATION))
    plain = F.concat(F.array_repeat(F.lit("64"), 4), F.array_repeat(F.lit("63"), 16))
    none = F.array().cast("array<string>")
    types = F.concat(F.when(F.col("recording_id") % 3 > 0, codes).otherwise(none), plain, F.when(F.col("recording_id") % 3 == 2, codes).otherwise(none), plain)
    events = ids.select("recording_id", F.posexplode(types).alias("i", "type")).select("recording_id", (F.col("i") + 1).cast("long").alias("event_index"), (F.col("i") * 640 + 1).cast("long").alias("latency"), "type")
    return triggers.startup_counts(events, triggers.clean_triggers(events))


@query("""
SELECT s_suppkey::BIGINT AS recording_id, CASE s_suppkey % 3 WHEN 1 THEN 'extract_triggers:InvalidLeadingValidation' ELSE 'extract_triggers:UnexpectedEEGEventType' END AS error
FROM supplier WHERE s_suppkey % 3 > 0
""")
def event_problems(spark, sf_dir):
    """Recordings without the leading validation codes, or with other types after them."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("recording_id"))
    lead = F.transform(F.array(*map(F.lit, triggers.VALIDATION)), lambda x: F.when((F.col("recording_id") % 3 == 1) & (x == "16"), "63").otherwise(x))
    types = F.concat(lead, F.array(F.lit("64"), F.lit("63")), F.when(F.col("recording_id") % 3 == 2, F.array(F.lit("99"))).otherwise(F.array().cast("array<string>")))
    events = ids.select("recording_id", F.posexplode(types).alias("event_index", "type"))
    return triggers.event_problems(events)
