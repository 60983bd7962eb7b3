"""Results that several others need, computed once, and the folder for what a cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(session: SparkSession) -> str:
    """The folder that all machines see: that of spark.checkpoint.dir, or one of this machine where all of Spark runs on it and none is named."""
    folder = session.conf.get("spark.checkpoint.dir", None)
    if not folder and not session.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return folder or tempfile.gettempdir()


def computed(df: DataFrame) -> DataFrame:
    """df computed once: checkpointed where the session names a folder for that (spark.checkpoint.dir), which also keeps plans short; persisted elsewhere."""
    if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        return df.checkpoint()
    return df.persist()
