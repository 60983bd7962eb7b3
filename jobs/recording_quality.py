"""A report on the trigger channel of every recording, by night.

    python -m jobs.recording_quality --input FOLDER --output FOLDER

Before two recordings can be aligned their triggers must be usable. This job reads samples (the configuration says by which
expressions a table gives recording, sample number, volts and time), finds pulses, codes them by their voltage, splits
merged ones, and tells for each recording what is found and whether someone should look at it.

Output: Parquet by night; a recording that starts before noon belongs to the evening before. A run replaces the nights that its input has
and leaves all others, so it can be run again, on all samples or on those of some nights.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lockstep.operators import triggers

from .common import config_of, main

JOB = "recording_quality"
SCHEMA = """recording_id long, n_samples long, missing_samples long, n_pulses long, n_orphans long, n_validation long, n_63 long, n_64 long, n_split long,
  longest long, first_latency long, last_latency long, median_interval_sec double, longest_interval_sec double, n_long_gaps long, verdict string, night string"""
log = logging.getLogger(f"jobs.{JOB}")


def quality(samples: DataFrame, config: dict) -> DataFrame:
    """One row for each recording of samples (recording_id, sample, volts, time)."""
    trace = samples.select("recording_id", "sample", "volts")
    whole = samples.groupBy("recording_id").agg(F.count("*").alias("n_samples"), (F.max("sample") - F.min("sample") + 1 - F.countDistinct("sample")).alias("missing_samples"), F.min("time").alias("begin"))
    pulses = triggers.intervals(triggers.pulses(trace, config["threshold"]), config["rate"], "latency")
    count = lambda condition, name: F.count_if(condition).alias(name)
    found = pulses.groupBy("recording_id").agg(
        F.count("*").alias("n_pulses"), count(F.col("type") == "orphan", "n_orphans"), count(F.col("type").isin(triggers.VALIDATION[:5]), "n_validation"), count(F.col("type") == "63", "n_63"), count(F.col("type") == "64", "n_64"),
        F.max(F.col("end") - F.col("latency") + 1).alias("longest"), F.min("latency").alias("first_latency"), F.max("latency").alias("last_latency"),
        F.percentile("interval_sec", F.lit(0.5)).alias("median_interval_sec"), F.max("interval_sec").alias("longest_interval_sec"), count(F.col("interval_sec") > config["longest_gap_sec"], "n_long_gaps"),
    )
    pieces = triggers.split_pulses(trace, config["threshold"]).groupBy("recording_id").agg(F.count("*").alias("pieces"))
    rows = whole.join(found, "recording_id", "left").join(pieces, "recording_id", "left").fillna(0, ["n_pulses", "n_orphans", "n_validation", "n_63", "n_64", "n_long_gaps", "pieces"])
    verdict = (
        F.when(F.col("missing_samples") > 0, "samples_missing")
        .when(F.col("n_pulses") == 0, "no_pulses")
        .when(100 * F.col("n_orphans") > config["orphan_percent"] * F.col("n_pulses"), "many_orphans")
        .when(F.col("n_long_gaps") > 0, "long_gaps")
        .otherwise("usable")
    )
    night = F.date_format(F.col("begin") - F.expr("INTERVAL 12 HOURS"), "yyyy-MM-dd").alias("night")
    split = (F.col("pieces") - F.col("n_pulses")).alias("n_split")
    return rows.select("recording_id", "n_samples", "missing_samples", "n_pulses", "n_orphans", "n_validation", "n_63", "n_64", split, "longest", "first_latency", "last_latency", "median_interval_sec", "longest_interval_sec", "n_long_gaps", verdict.alias("verdict"), night)


def run(spark: SparkSession, input: str, output: str, config: dict | None = None) -> None:
    """Report on all recordings of the input, Parquet of samples."""
    config = config or config_of(JOB)
    samples = spark.read.parquet(input).select(F.expr(config["recording_id"]).cast("long").alias("recording_id"), F.expr(config["sample"]).cast("long").alias("sample"), F.expr(config["volts"]).cast("double").alias("volts"), F.expr(config["time"]).cast("timestamp").alias("time"))
    rows = quality(samples.where("recording_id is not null and sample is not null"), config)
    rows.repartition("night").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("night").parquet(output)
    written = spark.read.schema(SCHEMA).parquet(output)
    for r in written.groupBy("verdict").agg(F.count("*").alias("n"), F.sum("n_samples").alias("samples"), F.sum("n_pulses").alias("pulses")).orderBy("verdict").collect():
        log.info("%s holds %d recordings %s: %d samples of %s, %d pulses", output, r.n, r.verdict, r.samples, input, r.pulses)


if __name__ == "__main__":
    main(JOB, run, ("input", "output"))
