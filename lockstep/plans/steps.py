"""Where a subject's files are, and the results of an alignment written step by step with a table of what each step gave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .align import RecordingPair

#: Steps of an alignment in their order, by the result that ends each.
STEPS = ("trigger_channel", "eeg_data", "clinical_data", "segments", "truncated", "resampled", "aligned", "output", "checks", "saved")


def eeg_path(root: str, subject: Column) -> Column:
    """<root>/<subject>/set/<subject>_sleep_ds500_Z3.set"""
    return F.concat(F.lit(f"{root}/"), subject, F.lit("/set/"), subject, F.lit("_sleep_ds500_Z3.set"))


def clinical_path(root: str, subject: Column) -> Column:
    """<root>/<subject>/clinical/<subject>.edf"""
    return F.concat(F.lit(f"{root}/"), subject, F.lit("/clinical/"), subject, F.lit(".edf"))


def aligned_path(clinical: Column) -> Column:
    """The output beside its clinical recording: every .edf in the path becomes _aligned.edf."""
    return F.replace(clinical, F.lit(".edf"), F.lit("_aligned.edf"))


def log_path(clinical: Column, subject: Column, started: Column) -> Column:
    """<folder of the clinical recording>/<subject>_alignment_<yyyyMMdd_HHmmss>.log"""
    return F.concat(F.regexp_replace(clinical, "[^/]*$", ""), subject, F.lit("_alignment_"), F.date_format(started, "yyyyMMdd_HHmmss"), F.lit(".log"))


def save(pair: RecordingPair, results: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write what ``align`` gave as Parquet, a folder for each step, and tell of them: step_number, step, rows, recordings, flagged.

    What is told is observed while the rows are written, without a job of its own. recordings is approximate beyond some thousands;
    flagged counts rows with an error, or with a failed check. The last step is what was saved: the output that errors leave.
    """
    errors = results["errors"]
    of = dict(zip(STEPS, (pair.trace, pair.eeg, pair.clinical, results["segments"], results["truncated"], results["resampled"], results["aligned"], results["output"], results.get("bounds", results["coverage"]), errors)))
    rows = []
    for number, (name, df) in enumerate(of.items(), 1):
        seen = Observation(f"{name}-{number}")
        flag = F.col("error").isNotNull() if "error" in df.columns else F.col("fails") | (F.col("n_bad") > 0) if "fails" in df.columns else F.lit(False)
        told = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("recording_id", 0.01).alias("recordings"), F.count_if(flag).alias("flagged"))
        told.write.mode("overwrite").parquet(f"{folder}/{number:02d}_{name}")
        rows.append((number, name, *(seen.get[c] for c in ("rows", "recordings", "flagged"))))
    table = errors.sparkSession.createDataFrame(rows, "step_number int, step string, rows long, recordings long, flagged long")
    table.coalesce(1).write.mode("overwrite").parquet(f"{folder}/steps")
    return errors.sparkSession.read.schema(table.schema).parquet(f"{folder}/steps")
