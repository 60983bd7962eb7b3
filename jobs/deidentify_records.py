"""Replace the patient field of records as they arrive, and keep an account of each.

    python -m jobs.deidentify_records --input FOLDER --output FOLDER --checkpoint FOLDER

A record is a text whose first 256 bytes are its header and whose bytes 8 to 87 are the patient field. A run takes the Parquet
files of the input that no earlier run has taken, by a file stream that ends when there are no more. Each record
gets a new field (automatic id, study id); every other byte stays as it is, which is verified on the new content. Nothing is
replaced where the header is no header, the study id is not allowed, or the study id is that of another record
of the same delivery or of one that is completed already.

Output: Parquet by batch and status (``completed`` with the new content, ``rejected`` with a reason). A batch
that is run again, after a failure, overwrites its own partitions only.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lockstep.operators import deid

from .common import config_of, main

JOB = "deidentify_records"
SCHEMA = "record_id long, source string, study_id string, n_bytes long, reason string, unchanged_sha256 string, content_sha256 string, content binary, batch long, status string"
log = logging.getLogger(f"jobs.{JOB}")


def replaced(records: DataFrame, completed: DataFrame, config: dict) -> DataFrame:
    """Each record (record_id, source, text) with its new content, or the reason why it has none.

    completed: study_id of the records that are completed already.
    """
    study = F.concat(F.lit(f"{config['study']}_"), F.col("record_id").cast("string"))
    old = F.encode(F.col("text"), "UTF-8")
    told = records.withColumn("study_id", study).withColumn("target", F.lower("study_id")).withColumn("field", deid.patient_field(F.lit(config["automatic_id"]), F.col("study_id")))
    several = told.groupBy("target").agg((F.count("*") > 1).alias("several")).where("several")
    taken = completed.select(F.lower("study_id").alias("target"), F.lit(True).alias("taken")).distinct()
    told = told.join(several, "target", "left").join(taken, "target", "left")
    reason = (
        F.when(F.col("text").isNull(), "NoContent")
        .when(F.octet_length("text") < 256, "TooShort")
        .when(~F.rlike(F.substring("text", 1, deid.FIELD.stop), F.lit(f"^[\\x20-\\x7e]{{{deid.FIELD.stop}}}$")), "NonAsciiField")
        .when(~deid.study_id_ok(F.col("study_id")), "InvalidStudyId")
        .when(F.col("field").isNull(), "PatientFieldTooLong")
        .when(F.col("several"), "duplicate_target")
        .when(F.col("taken"), "target_exists")
    )
    new = F.concat(F.substring(old, 1, deid.FIELD.start), F.encode("field", "UTF-8"), F.substring(old, deid.FIELD.stop + 1, 2147483647))
    done = told.withColumn("reason", reason).withColumn("content", F.when(F.col("reason").isNull(), new)).withColumn("unchanged_sha256", deid.unchanged_hash(old))
    kept = (deid.unchanged_hash(F.col("content")) == F.col("unchanged_sha256")) & (F.octet_length("content") == F.octet_length("text"))
    done = done.withColumn("reason", F.when(F.col("content").isNotNull() & ~kept, "VerificationFailed").otherwise(F.col("reason"))).withColumn("content", F.when(F.col("reason").isNull(), F.col("content")))
    status = F.when(F.col("reason").isNull(), "completed").otherwise("rejected")
    return done.select("record_id", "source", "study_id", F.octet_length("text").cast("long").alias("n_bytes"), "reason", "unchanged_sha256", F.sha2("content", 256).alias("content_sha256"), "content", status.alias("status"))


def run(spark: SparkSession, input: str, output: str, checkpoint: str, config: dict | None = None) -> None:
    """Take what is new in the input, a folder or pattern of Parquet files, and return when it is written."""
    config = config or config_of(JOB)
    columns = {"record_id": (config["id"], "long"), "source": (config["source"], "string"), "text": (config["content"], "string")}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns.values())
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", config["files_per_batch"]).parquet(input)
    arrived = files.select(*(F.col(f"`{name}`").alias(c) for c, (name, _) in columns.items()))

    taken = []

    def write(records: DataFrame, batch: int) -> None:
        session = records.sparkSession
        before = session.read.schema(SCHEMA).parquet(output).where((F.col("batch") < batch) & (F.col("status") == "completed")) if batch else session.createDataFrame([], SCHEMA)
        rows = replaced(records, before, config).withColumn("batch", F.lit(batch).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "status").parquet(output)
        written = session.read.schema(SCHEMA).parquet(output).where(F.col("batch") == batch)
        counts = written.groupBy("status", "reason").count().orderBy("status", "reason").collect()
        for r in counts:
            log.info("batch %d: wrote %d records to %s, %s%s", batch, r["count"], output, r.status, f" ({r.reason})" if r.reason else "")
        taken.append(sum(r["count"] for r in counts))

    stream = arrived.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        stream.awaitTermination()
    finally:
        stream.stop()
    log.info("read %d new records of %s", sum(taken), input)


if __name__ == "__main__":
    main(JOB, run, ("input", "output", "checkpoint"))
