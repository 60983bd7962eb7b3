"""The jobs as queries: each is run twice into one new folder, and what stands there is returned."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lockstep.functions.lineage import shared_folder
from lockstep.operators import deid

from . import deidentify_records, recording_quality


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of this call's own in the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_deidentify_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account of all documents' new patient fields. A second run finds nothing new."""
    folder = new_folder(spark, "deidentify-records")
    for _ in range(2):  # the pattern stands for a file or a folder
        deidentify_records.run(spark, f"{sf_dir}/documents.parque[t]", f"{folder}/records", f"{folder}/checkpoint")
    rows = spark.read.schema(deidentify_records.SCHEMA).parquet(f"{folder}/records")
    return rows.withColumn("stored_sha256", F.sha2("content", 256)).withColumn("new_field", F.decode(F.substring("content", 1, deid.FIELD.stop), "UTF-8")).drop("content")


def job2_recording_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on all recordings."""
    folder = new_folder(spark, "recording-quality")
    for _ in range(2):
        recording_quality.run(spark, f"{sf_dir}/events.parquet", folder)
    return spark.read.schema(recording_quality.SCHEMA).parquet(folder)


def queries() -> dict:
    return {"job1_deidentify_records": job1_deidentify_records, "job2_recording_quality": job2_recording_quality}


_RESERVED = ", ".join(f"'{x}'" for x in deid.RESERVED)

JOB1 = f"""
WITH records AS (SELECT doc_id AS record_id, source, text, 'corpus_' || doc_id AS study_id, strlen(text) AS n_bytes, count(*) OVER (PARTITION BY doc_id) AS n FROM documents),
told AS (
  SELECT *, CASE WHEN strlen('AUTO X 01-JAN-1999 ' || study_id) <= 80 THEN rpad('AUTO X 01-JAN-1999 ' || study_id, 80, ' ') END AS field FROM records),
judged AS (
  SELECT *, CASE WHEN text IS NULL THEN 'NoContent' WHEN n_bytes < 256 THEN 'TooShort' WHEN NOT regexp_full_match(substr(text, 1, 88), '[\\x20-\\x7e]{{88}}') THEN 'NonAsciiField'
    WHEN study_id IS NULL OR NOT regexp_full_match(study_id, '[A-Za-z0-9][A-Za-z0-9_-]{{0,39}}') OR upper(study_id) IN ({_RESERVED}) THEN 'InvalidStudyId'
    WHEN field IS NULL THEN 'PatientFieldTooLong' WHEN n > 1 THEN 'duplicate_target' END AS reason FROM told),
done AS (SELECT *, CASE WHEN reason IS NULL THEN substr(text, 1, 8) || field || substr(text, 89) END AS content FROM judged)
SELECT record_id, source, study_id, n_bytes, reason, sha256(encode(text)[1:8] || encode(text)[89:]) AS unchanged_sha256, sha256(content) AS content_sha256, 0::BIGINT AS batch,
  CASE WHEN reason IS NULL THEN 'completed' ELSE 'rejected' END AS status, sha256(content) AS stored_sha256, substr(content, 1, 88) AS new_field
FROM done
"""

_BANDS = "CASE WHEN v BETWEEN 5 AND 6 OR v BETWEEN 11 AND 12.1 OR v BETWEEN 18 AND 19 OR v BETWEEN 24 AND 25 OR v BETWEEN 30 AND 31 THEN 'validation' WHEN v BETWEEN 36 AND 37 THEN '63' WHEN v BETWEEN 42 AND 43 THEN '64' ELSE 'orphan' END"

JOB2 = f"""
WITH trace AS (SELECT event_id // 1000 AS recording_id, event_id % 1000 + 1 AS sample, value / 10 AS volts, ts FROM events),
whole AS (SELECT recording_id, count(*) AS n_samples, max(sample) - min(sample) + 1 - count(DISTINCT sample) AS missing_samples, min(ts) AS begin FROM trace GROUP BY 1),
high AS (SELECT *, sample - row_number() OVER (PARTITION BY recording_id ORDER BY sample) AS g FROM trace WHERE volts > 1),
pulses AS (SELECT recording_id, g, min(sample) AS a, max(sample) AS z, max(volts) AS v FROM high GROUP BY 1, 2),
placed AS (SELECT *, {_BANDS} AS kind, (a - 1) / 128.0::DOUBLE - (lag(a) OVER (PARTITION BY recording_id ORDER BY a) - 1) / 128.0::DOUBLE AS gap FROM pulses),
found AS (
  SELECT recording_id, count(*) AS n_pulses, count(*) FILTER (kind = 'orphan') AS n_orphans, count(*) FILTER (kind = 'validation') AS n_validation, count(*) FILTER (kind = '63') AS n_63, count(*) FILTER (kind = '64') AS n_64,
    max(z - a + 1) AS longest, min(a) AS first_latency, max(a) AS last_latency, median(gap) AS median_interval_sec, max(gap) AS longest_interval_sec, count(*) FILTER (gap > 0.5) AS n_long_gaps
  FROM placed GROUP BY 1),
bands AS (SELECT recording_id, g, sample, CASE WHEN volts BETWEEN 36 AND 37 THEN '63' WHEN volts BETWEEN 42 AND 43 THEN '64' END AS band FROM high),
parts AS (SELECT recording_id, g, band, min(sample) AS a FROM (SELECT *, sample - row_number() OVER (PARTITION BY recording_id, g, band ORDER BY sample) AS k FROM bands WHERE band IS NOT NULL) GROUP BY recording_id, g, band, k HAVING count(*) >= 3),
cut AS (SELECT p.recording_id, count(DISTINCT p.g) AS n_split FROM parts p JOIN parts q ON q.recording_id = p.recording_id AND q.g = p.g AND p.band = '63' AND q.band = '64' AND p.a < q.a GROUP BY 1),
report AS (
  SELECT w.recording_id, n_samples, missing_samples, coalesce(n_pulses, 0) AS n_pulses, coalesce(n_orphans, 0) AS n_orphans, coalesce(n_validation, 0) AS n_validation, coalesce(n_63, 0) AS n_63, coalesce(n_64, 0) AS n_64, coalesce(n_split, 0) AS n_split,
    longest, first_latency, last_latency, median_interval_sec, longest_interval_sec, coalesce(n_long_gaps, 0) AS n_long_gaps, strftime(begin - INTERVAL 12 HOURS, '%Y-%m-%d') AS night
  FROM whole w LEFT JOIN found f ON f.recording_id = w.recording_id LEFT JOIN cut c ON c.recording_id = w.recording_id)
SELECT *, CASE WHEN missing_samples > 0 THEN 'samples_missing' WHEN n_pulses = 0 THEN 'no_pulses' WHEN 100 * n_orphans > 60 * n_pulses THEN 'many_orphans' WHEN n_long_gaps > 0 THEN 'long_gaps' ELSE 'usable' END AS verdict FROM report
"""


def oracle_sql() -> dict[str, str]:
    return {"job1_deidentify_records": JOB1, "job2_recording_quality": JOB2}
