"""Queries over file headers and de-identification batches."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import deid
from . import views
from .views import SAMPLES, table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_HEAD = "concat(rpad(CASE WHEN c_custkey % 41 = 0 THEN '1' ELSE '0' END, 8, ' '), rpad(concat(c_custkey, ' M X ', c_name), 80, ' '), rpad(concat('Startdate 25-FEB-2026 AUTO', c_custkey, ' X DEVICE'), 80, ' '), '25.02.2622.00.00', rpad(CAST(CASE WHEN c_custkey % 37 = 0 THEN 512 ELSE 256 * (c_custkey % 5 + 1) END AS {s}), 8, ' '), rpad('', 44, ' '), rpad(CAST(CASE WHEN c_custkey % 29 = 0 THEN -1 WHEN c_custkey % 31 = 0 THEN -5 ELSE c_custkey END AS {s}), 8, ' '), rpad(CASE WHEN c_custkey % 23 = 0 THEN 'zero' WHEN c_custkey % 19 = 0 THEN '0' ELSE '1' END, 8, ' '), rpad(CAST(c_custkey % 5 AS {s}), 4, ' '))"


def headers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("name"), F.expr(_HEAD.format(s="STRING")).alias("head"))


_AT = "trim(substr(head, {0}, {1}))"
_INT = "CASE WHEN regexp_full_match({0}, '-?[0-9]+') THEN ({0})::BIGINT END"
_N, _R, _S = (_INT.format(_AT.format(a + 1, n)) for a, n in ((252, 4), (236, 8), (184, 8)))


@query(f"""WITH h AS (SELECT c_custkey AS name, {_HEAD.format(s="VARCHAR")} AS head FROM customer), p AS (SELECT name, {_N} AS n_signals, {_R} AS n_records, {_S} AS size, try_cast({_AT.format(245, 8)} AS DOUBLE) AS record_duration, {_AT.format(9, 80)} AS patient_id, {_AT.format(89, 80)} AS recording_id, {_AT.format(1, 8)} AS version FROM h)
SELECT name, n_signals, n_records, record_duration, patient_id, recording_id, CASE WHEN version <> '0' THEN 'UnsupportedVersion' WHEN n_signals IS NULL OR n_records IS NULL OR size IS NULL OR record_duration IS NULL THEN 'InvalidNumber'
WHEN n_records = -1 THEN 'UnknownRecordCount' WHEN n_records < 0 THEN 'InvalidRecordCount' WHEN NOT record_duration > 0 THEN 'InvalidRecordDuration' WHEN n_signals <= 0 THEN 'NoSignals' WHEN size <> 256 * (n_signals + 1) THEN 'HeaderSizeMismatch' END AS reason FROM p""")
def header_parse(spark, sf_dir):
    return deid.header_reasons(headers(spark, sf_dir))


_ID = "CASE c_custkey % 8 WHEN 0 THEN concat('sas_', c_custkey) WHEN 1 THEN '_lead' WHEN 2 THEN 'con' WHEN 3 THEN concat('a-', c_custkey % 50) WHEN 4 THEN 'has space' WHEN 5 THEN rpad('9', CAST(c_custkey % 60 + 1 AS INT), '9') WHEN 6 THEN 'COM1' ELSE concat('Lpt', c_custkey % 12) END"
_OK = "(regexp_full_match({0}, '[A-Za-z0-9][A-Za-z0-9_-]{{0,39}}') AND upper({0}) NOT IN (" + ", ".join(f"'{x}'" for x in deid.RESERVED) + "))"


@query(f"SELECT c_custkey, id, {_OK.format('id')} AS ok FROM (SELECT c_custkey, {_ID} AS id FROM customer)")
def study_id_validate(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.expr(_ID).alias("id")).select("c_custkey", "id", deid.study_id_ok(F.col("id")).alias("ok"))


_LOCAL = "CASE WHEN c_custkey % 9 = 0 THEN 'Other text here' ELSE concat('Startdate 25-FEB-2026 AUTO', c_custkey, rpad('', CAST(c_custkey % 60 AS INT), 'z'), ' X DEV') END"


@query(f"WITH f AS (SELECT c_custkey, CASE WHEN l LIKE 'Startdate %' THEN split_part(l, ' ', 3) END AS auto_id FROM (SELECT c_custkey, {_LOCAL} AS l FROM customer)), t AS (SELECT *, auto_id || ' X 01-JAN-1999 ' || 'study_' || c_custkey AS field FROM f) SELECT c_custkey, auto_id, CASE WHEN strlen(field) <= 80 THEN rpad(field, 80, ' ') END AS patient_field FROM t")
def patient_field(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", deid.automatic_id(F.expr(_LOCAL)).alias("auto_id"))
    return c.withColumn("patient_field", deid.patient_field(F.col("auto_id"), F.concat(F.lit("study_"), F.col("c_custkey").cast("string"))))


_JOBS = "SELECT o_orderkey AS job_id, concat('folder', o_custkey % 20) AS folder, CASE WHEN o_orderkey % 3 = 0 THEN concat('sT', o_orderkey % 1100, '.edf') ELSE concat('File', o_orderkey % 900, '.EDF') END AS source, CASE WHEN o_orderkey % 47 = 0 THEN 'bad id' ELSE concat('st', o_orderkey % 1100) END AS study_id, concat(CASE WHEN o_orderkey % 2 = 0 THEN 'St' ELSE 'st' END, o_orderkey % 1100, '.edf') AS target, CASE WHEN o_orderkey % 83 = 0 THEN 'x' END AS error FROM orders WHERE o_orderkey % 4 = 0"
_HAVE = "SELECT concat('folder', s_suppkey % 20) AS folder, concat('sT', s_suppkey * 4, '.edf') AS name FROM supplier UNION ALL SELECT concat('folder', s_suppkey % 20), concat('.deid-recovery-', s_suppkey) FROM supplier WHERE s_suppkey % 33 = 0"


@query(f"""WITH jobs AS ({_JOBS}), have AS ({_HAVE})
SELECT job_id, 'duplicate_source' AS issue FROM (SELECT *, count(*) OVER (PARTITION BY folder, lower(source)) AS n FROM jobs) WHERE n > 1
UNION ALL SELECT job_id, 'duplicate_target' FROM (SELECT *, count(*) OVER (PARTITION BY folder, lower(target)) AS n FROM jobs) WHERE n > 1
UNION ALL SELECT DISTINCT job_id, 'target_exists' FROM jobs j JOIN have e ON j.folder = e.folder AND lower(j.target) = lower(e.name) AND j.source <> e.name
UNION ALL SELECT job_id, 'unresolved_recovery' FROM jobs WHERE folder IN (SELECT folder FROM have WHERE name LIKE '.deid-recovery-%')
UNION ALL SELECT job_id, 'invalid_study_id' FROM jobs WHERE NOT {_OK.format('study_id')} UNION ALL SELECT job_id, 'invalid_header' FROM jobs WHERE error IS NOT NULL UNION ALL SELECT job_id, 'several_folders' FROM jobs""")
def preflight_issues(spark, sf_dir):
    for name in ("orders", "supplier"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"lockstep_{name}")
    jobs, have = (spark.sql(x.replace("FROM orders", "FROM lockstep_orders").replace("FROM supplier", "FROM lockstep_supplier")) for x in (_JOBS, _HAVE))
    return deid.preflight(jobs, have)


_BATCHES = """batches AS (SELECT c_custkey AS batch FROM customer), jobs AS (SELECT o_custkey AS batch, 'folder' || CASE WHEN o_orderkey % 97 = 0 THEN o_custkey % 7 ELSE o_custkey % 20 END AS folder, CAST(round(o_totalprice) AS BIGINT) AS size FROM orders),
folders AS (SELECT 'folder' || s_suppkey AS folder, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(round(s_acctbal) AS BIGINT) * 60 END AS free FROM supplier WHERE s_suppkey < 19)"""


@query(f"""WITH {_BATCHES}, told AS (SELECT batch, count(DISTINCT folder) AS n, min(folder) AS folder, max(size) AS need FROM jobs GROUP BY batch)
SELECT batch, 'empty_batch' AS issue FROM batches WHERE batch NOT IN (SELECT batch FROM jobs)
UNION ALL SELECT batch, 'several_folders' FROM told JOIN batches USING (batch) WHERE n > 1
UNION ALL SELECT batch, CASE WHEN free IS NULL THEN 'unknown_space' ELSE 'insufficient_space' END FROM told JOIN batches USING (batch) JOIN folders USING (folder) WHERE n = 1 AND (free IS NULL OR free < need)""")
def batch_issues(spark, sf_dir):
    """Batches that are empty, span folders, or lack room for their largest file."""
    of = {n: table(spark, sf_dir, n) for n in ("customer", "orders", "supplier")}
    batches = of["customer"].select(F.col("c_custkey").alias("batch"))
    jobs = of["orders"].select(F.col("o_custkey").alias("batch"), F.expr("concat('folder', CASE WHEN o_orderkey % 97 = 0 THEN o_custkey % 7 ELSE o_custkey % 20 END)").alias("folder"), F.round("o_totalprice").cast("long").alias("size"))
    folders = of["supplier"].where("s_suppkey < 19").select(F.expr("concat('folder', s_suppkey)").alias("folder"), F.expr("CASE WHEN s_suppkey % 5 <> 0 THEN cast(round(s_acctbal) AS BIGINT) * 60 END").alias("free"))
    return deid.batch_issues(batches, jobs, folders)


_STEPS = f"SELECT event_id // {SAMPLES // 20} AS batch, event_id AS position, CASE WHEN value > 45 THEN 'failed' WHEN event_id % 71 = 0 THEN 'cancelled' ELSE 'completed' END AS result FROM events"


def _steps(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.expr(f"event_id div {SAMPLES // 20}").alias("batch"), F.col("event_id").alias("position"), F.expr("CASE WHEN value > 45 THEN 'failed' WHEN event_id % 71 = 0 THEN 'cancelled' ELSE 'completed' END").alias("result"))


@query(f"WITH s AS ({_STEPS}) SELECT batch, position, result, CASE WHEN position > min(CASE WHEN result <> 'completed' THEN position END) OVER (PARTITION BY batch) THEN 'untouched' ELSE result END AS status FROM s")
def batch_status(spark, sf_dir):
    return deid.batch_status(_steps(spark, sf_dir), ["batch"])


@query(f"WITH s AS ({_STEPS}), t AS (SELECT batch, CASE WHEN position > min(CASE WHEN result <> 'completed' THEN position END) OVER (PARTITION BY batch) THEN 'untouched' ELSE result END AS status FROM s) SELECT batch, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'cancelled') AS cancelled, count(*) FILTER (status = 'untouched') AS untouched FROM t GROUP BY batch")
def batch_counts(spark, sf_dir):
    s = deid.batch_status(_steps(spark, sf_dir), ["batch"])
    return s.groupBy("batch").agg(*(F.count_if(F.col("status") == x).alias(x) for x in ("completed", "failed", "cancelled", "untouched")))


@query("SELECT doc_id, sha256(encode(text)[1:8] || encode(text)[89:]) AS digest, octet_length(encode(text)) AS size FROM documents")
def unchanged_hash(spark, sf_dir):
    """Hash of all bytes but the patient field."""
    return table(spark, sf_dir, "documents").select("doc_id", deid.unchanged_hash(F.encode("text", "UTF-8")).alias("digest"), F.octet_length("text").cast("long").alias("size"))


@query("SELECT lang, source, count(*) AS files, max(strlen(text)) AS required_bytes, min(source || '/' || doc_id) AS first_name FROM documents GROUP BY ALL")
def required_space(spark, sf_dir):
    """Free bytes that a folder's batch needs: its largest file."""
    d = table(spark, sf_dir, "documents")
    return d.groupBy("lang", "source").agg(F.count("*").alias("files"), F.max(F.octet_length("text")).cast("long").alias("required_bytes"), F.min(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))).alias("first_name"))


_LOW = "lower(n_name)"


@query("SELECT s_suppkey, 'subject_alignment_check_step' || (s_suppkey % 10)::VARCHAR || CASE WHEN s_suppkey % 3 = 0 THEN '_' || lower(s_name) ELSE '' END || '.parquet' AS name FROM supplier")
def qa_names(spark, sf_dir):
    """Names of the quality series that each step writes."""
    from ..operators.qa import series_name

    return table(spark, sf_dir, "supplier").select("s_suppkey", series_name(F.lit("subject"), F.expr("s_suppkey % 10"), F.when(F.expr("s_suppkey % 3 = 0"), F.lower("s_name"))).alias("name"))


@query("""WITH p AS (SELECT s_suppkey, s_name AS subject, '/data/' || s_name || '/clinical/' || s_name || '.edf' AS clinical FROM supplier)
SELECT s_suppkey, '/data/' || subject || '/set/' || subject || '_sleep_ds500_Z3.set' AS eeg, clinical, '/data/' || subject || '/clinical/' || subject || '_aligned.edf' AS aligned,
'/data/' || subject || '/clinical/' || subject || '_alignment_' || strftime(TIMESTAMP '2026-08-10 01:02:03' + to_seconds(CAST(s_suppkey AS BIGINT) * 1000), '%Y%m%d_%H%M%S') || '.log' AS log FROM p""")
def recording_paths(spark, sf_dir):
    """Where each subject's recordings, output and log are."""
    from . import steps

    subject, clinical = F.col("s_name"), steps.clinical_path("/data", F.col("s_name"))
    started = F.expr("timestamp_ntz '2026-08-10 01:02:03' + make_interval(0, 0, 0, 0, 0, 0, s_suppkey * 1000)")
    return table(spark, sf_dir, "supplier").select("s_suppkey", steps.eeg_path("/data", subject).alias("eeg"), clinical.alias("clinical"), steps.aligned_path(clinical).alias("aligned"), steps.log_path(clinical, subject, started).alias("log"))


@query(f"""WITH {views.shape_sql('eeg')}, b AS (SELECT recording_id, min(latency) AS lo, max(latency) AS hi FROM eeg GROUP BY 1),
g AS (SELECT recording_id, event_index, latency, lead(latency) OVER (PARTITION BY recording_id ORDER BY event_index) AS nxt FROM eeg)
SELECT recording_id, 'unsafe_interval' AS kind, (latency - 1) / 500.0::DOUBLE / 3600 AS start_hr, (nxt - 1) / 500.0::DOUBLE / 3600 AS end_hr FROM g WHERE nxt - latency > 60 * 500
UNION ALL SELECT recording_id, 'initial_zero_padding', 0.0::DOUBLE, (lo - 1) / 500.0::DOUBLE / 3600 FROM b UNION ALL SELECT recording_id, 'terminal_drop', (hi - 1) / 500.0::DOUBLE / 3600, (hi - 1) / 500.0::DOUBLE / 3600 + 0.01 FROM b""")
def qa_intervals(spark, sf_dir):
    """Intervals of a recording's axis by kind: before the first trigger, suspiciously long gaps, after the last."""
    from ..operators.qa import timeline

    e = views.schedule(spark, sf_dir, "eeg")
    return timeline(e, 500, 60.0, 0.01)
