"""Pulses of a stream are those of the whole trace."""

import numpy as np

from lockstep.operators.triggers import pulses
from lockstep.streaming.pulses import stream_pulses

SCHEMA = "recording_id long, sample long, volts double"


def test_batches_give_the_whole_traces_pulses(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(r, s + 1, float(rng.choice([0.0, 0.5, 5.5, 36.5]))) for r in range(2) for s in range(60)] + [(r, 61, 0.0) for r in range(2)]
    for k, (a, b) in enumerate([(1, 20), (21, 43), (44, 61)]):
        spark.createDataFrame([x for x in rows if a <= x[1] <= b], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    q = stream_pulses(stream).writeStream.format("memory").queryName("found_pulses").option("checkpointLocation", f"{tmp_path}/c").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.table("found_pulses").collect()))
    whole = pulses(spark.createDataFrame(rows, SCHEMA)).drop("type").select("recording_id", "latency", "end", "max_value")
    assert got == sorted(map(tuple, whole.collect()))
