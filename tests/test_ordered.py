"""Runs by blocks are those of one window over the recording."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lockstep.operators import ordered


@pytest.mark.parametrize("block", [1, 2, 7, 64, 1 << 16])
def test_block_runs_are_the_runs(spark, block):
    rng = np.random.default_rng(block)
    rows = []
    for r in range(4):
        value = np.repeat(rng.choice(["a", "b", None], 60), rng.integers(1, 30, 60))
        keep = rng.random(len(value)) > 0.02 * r  # gaps end runs as well
        rows += [(r, i + 1, v, float(x)) for i, (v, k, x) in enumerate(zip(value, keep, rng.normal(size=len(value)))) if k]
    df = spark.createDataFrame(rows, "recording_id long, sample long, kind string, x double").repartition(3)
    got = sorted(tuple(r) for r in ordered.block_runs(df, ["recording_id"], "sample", F.col("kind"), block, top=F.col("x")).collect())
    want, last = [], None
    for r, i, v, x in sorted(rows, key=lambda t: t[:2]):
        if v is not None and last == (r, i - 1, v):
            want[-1][3], want[-1][4] = i, max(want[-1][4], x)
        elif v is not None:
            want.append([r, v, i, i, x])
        last = (r, i, v)
    assert got == sorted(map(tuple, want))


def test_block_runs_of_nothing(spark):
    df = spark.createDataFrame([(1, 1, None)], "recording_id long, sample long, kind string")
    assert ordered.block_runs(df, ["recording_id"], "sample", F.col("kind")).count() == 0
