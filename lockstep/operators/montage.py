"""Channels: renaming, montages, splicing of the output, quality checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import computed

# Output labels with the source electrode of each.
ELECTRODES = {"Fp1": "L1", "Fp2": "R1", "F3": "LL2", "F4": "RR2", "C3": "LA2", "C4": "RA2", "O1": "LL11", "O2": "RR11", "M1": "LD6", "M2": "RD6", "VEOGL": "VEOGL"}
REFERENCE = {"Fp1": "M2", "F3": "M2", "C3": "M2", "O1": "M2", "Fp2": "M1", "F4": "M1", "C4": "M1", "O2": "M1"}
OUTPUT = ("Fp1", "Fp2", "F3", "F4", "C3", "C4", "O1", "O2", "M1", "M2", "E1", "E2")
FAULTY = {**{c: c for c in (*REFERENCE, "M1", "M2")}, "E1": "VEOGL", "E2": "Fp2"}
ROWS = 2_000_000  # of long samples in a task, some 50 MB as shuffled
FAULT_UV, FAULT_SHARE, BOUNDS_PERCENT = 1000.0, 0.02, 1.0


def lookup(names: list[tuple], schema: str, spark) -> DataFrame:
    return spark.createDataFrame(names, schema)


def select_channels(samples: DataFrame, electrodes: dict[str, str] = ELECTRODES) -> DataFrame:
    """Samples of the mapped electrodes under their output names, with their order."""
    name = F.create_map(*(F.lit(x) for k, v in electrodes.items() for x in (v, k)))
    order = F.create_map(*(F.lit(x) for i, v in enumerate(electrodes.values()) for x in (v, i + 1)))
    return samples.where(F.col("channel").isin(*electrodes.values())).withColumns({"channel_order": order[F.col("channel")], "channel": name[F.col("channel")]})


def missing(required: list[str], available: DataFrame) -> DataFrame:
    """Required labels that a recording lacks or holds more than once: recording_id, label, problem."""
    spark = available.sparkSession
    want = available.select("recording_id").distinct().withColumn("label", F.explode(F.array(*map(F.lit, required))))
    have = available.groupBy("recording_id", "label").agg(F.count("*").alias("n"))
    found = want.join(have, ["recording_id", "label"], "left")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
    return found.select("recording_id", "label", problem.alias("problem")).where("problem is not null")


def mean_centred(samples: DataFrame, keys: list[str]) -> DataFrame:
    """value less its mean within keys; the mean is joined back, so that no window holds a channel.

    Samples are dealt by keys to as many tasks as their number asks for, ROWS or so in each, where a plain join would deal all of them to a fixed number.
    """
    means = computed(samples.groupBy(*keys).agg(F.avg("value").alias("_mean"), F.count("*").alias("_n")))
    few = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(few, math.ceil((means.agg(F.sum("_n")).first()[0] or 0) / ROWS))
    dealt = samples.repartition(parts, *keys) if parts > few else samples
    return dealt.join(means.drop("_n"), keys).withColumn("value", F.col("value") - F.col("_mean")).drop("_mean")


def pivot(samples: DataFrame, channels) -> DataFrame:
    """One row per sample with a column for each channel."""
    return samples.groupBy("recording_id", "sample").agg(*(F.max(F.when(F.col("channel") == c, F.col("value"))).alias(c) for c in channels))


def bipolar(wide: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Differences of channels under new names."""
    return wide.select("recording_id", "sample", *((F.col(a) - F.col(b)).alias(k) for k, (a, b) in pairs.items()))


def fault(samples: DataFrame) -> DataFrame:
    """Share of matched samples of M1 and M2 at or beyond the fault voltage, and whether their mean exceeds the limit.

    samples: recording_id, channel, value, matched.
    """
    share = F.avg(F.when(F.abs("value") >= FAULT_UV, 1.0).otherwise(0.0))
    each = samples.where(F.col("matched") & F.col("channel").isin("M1", "M2")).groupBy("recording_id", "channel").agg(share.alias("share"))
    return each.groupBy("recording_id").agg(F.max(F.when(F.col("channel") == "M1", 100 * F.col("share"))).alias("m1_percent"), F.max(F.when(F.col("channel") == "M2", 100 * F.col("share"))).alias("m2_percent"), (F.avg("share") > FAULT_SHARE).alias("faulty"))


def splice(aligned: DataFrame, clinical: DataFrame, faulty: DataFrame) -> DataFrame:
    """The twelve output channels.

    Normal: scalp channels are aligned less aligned mastoid plus clinical mastoid; M1, M2, E1, E2 stay clinical.
    Faulty: all come from the aligned recording, E1 from VEOGL and E2 from Fp2.
    """
    return splice_wide(pivot(aligned, ELECTRODES), clinical, faulty).drop("matched")


def splice_wide(aligned: DataFrame, clinical: DataFrame, faulty: DataFrame) -> DataFrame:
    """``splice`` of aligned samples with a column for each electrode, and matched, which is passed on."""
    matched = F.col("matched") if "matched" in aligned.columns else F.lit(True)
    a = aligned.select("recording_id", "sample", matched.alias("matched"), *(F.col(c).alias(f"a_{c}") for c in ELECTRODES))
    c = pivot(clinical, ("M1", "M2", "E1", "E2")).select("recording_id", "sample", *(F.col(x).alias(f"c_{x}") for x in ("M1", "M2", "E1", "E2")))
    j = c.join(a, ["recording_id", "sample"]).join(faulty.select("recording_id", "faulty"), "recording_id")
    rows = []
    for out in OUTPUT:
        normal = F.col(f"a_{out}") - F.col(f"a_{REFERENCE[out]}") + F.col(f"c_{REFERENCE[out]}") if out in REFERENCE else F.col(f"c_{out}")
        label = f"{out} - {REFERENCE[out]} + clinical {REFERENCE[out]}" if out in REFERENCE else f"clinical {out}"
        rows.append(F.struct(F.lit(out).alias("channel"), F.when(F.col("faulty"), F.col(f"a_{FAULTY[out]}")).otherwise(normal).alias("value"), F.when(F.col("faulty"), f"aligned {FAULTY[out]}").otherwise(label).alias("derivation")))
    return j.select("recording_id", "sample", "matched", F.inline(F.array(*rows)))


def bounds(samples: DataFrame, limits: DataFrame) -> DataFrame:
    """Percent of matched samples strictly outside their channel's limits, whether it fails, and how many of all samples are not finite.

    limits: recording_id, channel, physical_min, physical_max. A channel without matched samples has no percentage and does not fail.
    """
    j = samples.join(limits, ["recording_id", "channel"])
    outside = F.when((F.col("value") < F.col("physical_min")) | (F.col("value") > F.col("physical_max")), 1.0).otherwise(0.0)
    got = j.groupBy("recording_id", "channel").agg((100 * F.avg(F.when(F.col("matched"), outside))).alias("p"), F.count_if(~finite(F.col("value"))).alias("n_bad"))
    return got.select("recording_id", "channel", F.round("p", 3).alias("percent_outside"), F.coalesce(F.col("p") > BOUNDS_PERCENT, F.lit(False)).alias("fails"), "n_bad")


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def coverage(mask: DataFrame) -> DataFrame:
    """Matched and all samples of each recording, and the percentage: mask has recording_id, sample, matched."""
    n = F.count_if("matched")
    return mask.groupBy("recording_id").agg(n.alias("matched"), F.count("*").alias("total"), (100 * n / F.count("*")).alias("coverage_percent"))


def fault_inputs(clinical: DataFrame, mask: DataFrame, headers: DataFrame | None = None, per_record: int = 256) -> DataFrame:
    """What keeps the fault rule from being applied: recording_id, error, the first that holds.

    clinical: recording_id, channel, sample, value; mask: recording_id, sample, matched; headers: recording_id, channel, unit, samples_in_record.
    """
    ids = mask.groupBy("recording_id").agg(F.count("*").alias("n"), F.bool_or("matched").alias("any"))
    both = clinical.where(F.col("channel").isin("M1", "M2")).join(mask, ["recording_id", "sample"], "left")
    told = both.groupBy("recording_id", "channel").agg(F.count("*").alias("samples"), F.count_if(F.col("matched") & ~finite(F.col("value"))).alias("bad"))
    told = told.groupBy("recording_id").agg(F.count("*").alias("channels"), F.min("samples").alias("least"), F.max("samples").alias("most"), F.sum("bad").alias("bad"))
    j = ids.join(told, "recording_id", "left")
    rules = [("NoMatchedSamples", ~F.coalesce("any", F.lit(False))), ("MissingEdfChannel", F.coalesce("channels", F.lit(0)) < 2)]
    if headers is not None:
        h = headers.where(F.col("channel").isin("M1", "M2")).groupBy("recording_id").agg(
            F.count_distinct("channel").alias("named"), F.count("*").alias("rows"), F.bool_or(F.col("samples_in_record") != per_record).alias("rate"), F.bool_or(F.trim("unit") != "uV").alias("dimension")
        )
        j = j.join(h, "recording_id", "left")
        rules += [("DuplicateEdfChannel", F.col("rows") > F.col("named")), ("InvalidSamplingRate", F.col("rate")), ("InvalidPhysicalDimension", F.col("dimension"))]
    rules += [("MaskLengthMismatch", (F.col("least") != F.col("n")) | (F.col("most") != F.col("n"))), ("NonfiniteMatchedSamples", F.col("bad") > 0)]
    error = F.coalesce(*(F.when(c, f"faulty_clinical_detection:{name}") for name, c in rules))
    return j.select("recording_id", error.alias("error")).where("error is not null")


def header_problems(headers: DataFrame) -> DataFrame:
    """Identifiers of header checks that a recording's direct channels violate.

    headers: recording_id, unit, samples_in_record, physical_min, physical_max, digital_min, digital_max.
    """
    one = lambda c: F.count_distinct(c) > 1
    lo, hi = F.col("digital_min"), F.col("digital_max")
    bad_digital = (lo != F.floor(lo)) | (hi != F.floor(hi)) | (lo < -32768) | (hi > 32767) | (lo >= hi)
    got = headers.groupBy("recording_id").agg(
        F.bool_or(F.trim("unit") != "uV").alias("InvalidPhysicalDimension"), (one("samples_in_record") | F.bool_or(F.col("samples_in_record") <= 0)).alias("InconsistentSamplingRates"),
        F.bool_or(F.col("physical_min") >= F.col("physical_max")).alias("InvalidPhysicalLimits"), (one("physical_min") | one("physical_max")).alias("InconsistentPhysicalLimits"),
        (one("digital_min") | one("digital_max")).alias("InconsistentDigitalLimits"), F.bool_or(bad_digital).alias("InvalidDigitalLimits"),
    )
    names = [c for c in got.columns if c != "recording_id"]
    return got.select("recording_id", F.explode(F.filter(F.array(*(F.when(F.col(c), F.lit(c)) for c in names)), lambda x: x.isNotNull())).alias("problem"))


def zero_filled(spans: DataFrame, samples: DataFrame, totals: DataFrame) -> DataFrame:
    """Every sample of the timeline: the segment's value, or zero where none lies; matched tells which.

    samples: recording_id, sample, value of the placed segments; totals: recording_id, n_samples.
    """
    grid = totals.select("recording_id", F.explode(F.sequence(F.lit(1), F.col("n_samples"))).alias("sample"))
    return grid.join(samples, ["recording_id", "sample"], "left").select("recording_id", "sample", F.coalesce("value", F.lit(0.0)).alias("value"), F.col("value").isNotNull().alias("matched"))


def overlaps(spans: DataFrame) -> DataFrame:
    """Segments that start at or before the end of the one before."""
    w = Window.partitionBy("recording_id").orderBy("start_sample")
    return spans.withColumn("before", F.lag("end_sample").over(w)).where("start_sample <= before")
