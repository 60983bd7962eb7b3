"""Quality series as data: names, intervals of the time axis, shared limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import require


def series_name(subject: Column, step: Column, suffix: Column) -> Column:
    """<subject>_alignment_check_step<d>[_<suffix>].parquet"""
    return F.concat(subject, F.lit("_alignment_check_step"), step.cast("string"), F.coalesce(F.concat(F.lit("_"), suffix), F.lit("")), F.lit(".parquet"))


def timeline(events: DataFrame, rate: float, longest_sec: float, tail_hr: float) -> DataFrame:
    """recording_id, kind, start_hr, end_hr: before the first trigger, between triggers too far apart, and after the last."""
    hour = lambda c: (c - 1) / rate / 3600
    w = Window.partitionBy("recording_id").orderBy("event_index")
    gaps = events.withColumn("next", F.lead("latency").over(w)).where(F.col("next") - F.col("latency") > longest_sec * rate)
    ends = events.groupBy("recording_id").agg(F.min("latency").alias("lo"), F.max("latency").alias("hi"))
    unsafe = gaps.select("recording_id", F.lit("unsafe_interval").alias("kind"), hour(F.col("latency")).alias("start_hr"), hour(F.col("next")).alias("end_hr"))
    first = ends.select("recording_id", F.lit("initial_zero_padding"), F.lit(0.0), hour(F.col("lo")))
    last = ends.select("recording_id", F.lit("terminal_drop"), hour(F.col("hi")), hour(F.col("hi")) + tail_hr)
    return unsafe.union(first).union(last)


#: Classes of time on the output's axis; where several hold, the first counts.
TRUST = ("excluded", "lost", "dropped", "padded", "trusted", "uncertain")


def sweep(intervals: DataFrame, keys: list[str], classes: tuple[str, ...]) -> DataFrame:
    """Disjoint intervals (keys, kind, start, end): at each time the first of classes that holds, neighbours of one kind joined.

    intervals: keys, kind, start, end. Each opens its class at its start and closes it at its end; one window over these ends counts what is open.
    Empty intervals count for nothing.
    """
    end = lambda c, step: F.struct(F.col(c).cast("double").alias("at"), F.lit(step).alias("step"))
    ends = intervals.where("start < end").select(*keys, "kind", F.inline(F.array(end("start", 1), end("end", -1))))
    changes = ends.groupBy(*keys, "at").agg(*(F.sum(F.when(F.col("kind") == c, F.col("step")).otherwise(0)).alias(f"_{c}") for c in classes))
    w = Window.partitionBy(*keys).orderBy("at")
    kind = F.coalesce(*(F.when(F.sum(f"_{c}").over(w) > 0, c) for c in classes))
    pieces = changes.select(*keys, kind.alias("kind"), F.col("at").alias("start"), F.lead("at").over(w).alias("end"))
    by_start = Window.partitionBy(*keys).orderBy("start")
    new = F.coalesce(~F.col("kind").eqNullSafe(F.lag("kind").over(by_start)), F.lit(True)).cast("int")
    numbered = pieces.where("end is not null").withColumn("_new", new).withColumn("_run", F.sum("_new").over(by_start)).where("kind is not null")
    return numbered.groupBy(*keys, "_run", "kind").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def trust_timeline(extents: DataFrame, segments: DataFrame, lost: DataFrame, excluded: DataFrame) -> DataFrame:
    """What to think of each stretch of a recording, in hours of the output's clock: recording_id, kind, start, end.

    extents: recording_id, shift_hr (where the EEG starts), eeg_hr and output_hr (how long both are). segments, lost, excluded: recording_id,
    start_hr, end_hr on the same clock; an open start or end (null) reaches to that of both recordings together.
    Before the EEG's start and after its end the output is padded, beyond its own end the EEG is dropped, and
    what no segment, loss or interruption tells of is uncertain.
    """
    e = extents.withColumn("end_hr", F.col("shift_hr") + F.col("eeg_hr"))
    low, high = F.least(F.lit(0.0), F.col("shift_hr")), F.greatest("output_hr", "end_hr")
    part = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.cast("double").alias("start"), b.cast("double").alias("end"))
    own = F.array(part("padded", F.lit(0.0), F.least("shift_hr", "output_hr")), part("padded", F.greatest(F.col("end_hr"), F.lit(0.0)), F.col("output_hr")), part("dropped", F.greatest("output_hr", "shift_hr"), F.col("end_hr")), part("dropped", F.col("shift_hr"), F.least(F.lit(0.0), F.col("end_hr"))), part("uncertain", low, high))
    rows = e.select("recording_id", F.inline(own))
    for kind, df in (("trusted", segments), ("lost", lost), ("excluded", excluded)):
        told = df.select("recording_id", F.col("start_hr").alias("a"), F.col("end_hr").alias("b")).join(e.select("recording_id", low.alias("low"), high.alias("high")), "recording_id")
        rows = rows.union(told.select("recording_id", F.lit(kind), F.greatest(F.coalesce("a", "low"), "low").cast("double"), F.least(F.coalesce("b", "high"), "high").cast("double")))
    return sweep(rows, ["recording_id"], TRUST)


#: Clinical channels that are shown with the trigger channel.
NATIVE = ("C3", "M1", "E2")


def native_traces(trace: DataFrame, clinical: DataFrame, trigger_rate: float, clinical_rate: float) -> DataFrame:
    """recording_id, channel, sample, time_sec, value of the trigger channel and of C3, M1 and E2, each on its own grid.

    Recordings that lack a channel are those of ``montage.missing``.
    """
    at = lambda rate: ((F.col("sample") - 1) / rate).alias("time_sec")
    rows = clinical.where(F.col("channel").isin(*NATIVE)).select("recording_id", "channel", "sample", at(clinical_rate), "value")
    return rows.union(trace.select("recording_id", F.lit("trigger"), "sample", at(trigger_rate), F.col("volts")))


def limits(spectra: DataFrame, keys: list[str]) -> DataFrame:
    """Limits that all spectra of a recording share: the least and the largest value."""
    return spectra.groupBy(*keys).agg(F.min("db").alias("low"), F.max("db").alias("high"))


def save(series: dict[str, DataFrame], descriptions: list[str], folder: str) -> list[str]:
    """Write each series as Parquet under its name; one description for each."""
    require(len(series) == len(descriptions), "save_and_track_alignment_figure:DescriptionCountMismatch")
    for name, df in series.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return [f"{folder}/{name}" for name in series]
