"""From two recordings to the aligned, spliced output: all steps for any number of recordings at once.

A recording that violates a contract is named in ``errors`` with the contract's identifier, and its output is left out; the others go on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import require
from ..functions.lineage import computed
from ..operators import montage, resampling, segments, triggers
from ..operators.replay import segment_recordings


@dataclass
class RecordingPair:
    """Inputs, keyed by recording_id.

    eeg_events (event_index, latency, type), trace (sample, volts), eeg (channel, sample, value; electrodes),
    clinical (channel, sample, value), headers of the clinical channels where known (channel, unit, samples_in_record, physical_min,
    physical_max, digital_min, digital_max), and the rates, which are those of the recording systems.
    """

    eeg_events: DataFrame
    trace: DataFrame
    eeg: DataFrame
    clinical: DataFrame
    headers: DataFrame | None = None
    eeg_rate: float = 500.0
    trigger_rate: float = 128.0
    clinical_rate: float = 256.0

    @property
    def ratio(self) -> int:
        r = self.clinical_rate / self.trigger_rate
        require(r == int(r), "resample_eeg_segments:NonintegerEdfRateRatio")
        return int(r)


def candidates(pair: RecordingPair) -> DataFrame:
    """EEG events that may be triggers, by code."""
    return triggers.normalise(pair.eeg_events).where("kind = 'candidate'").select("recording_id", "event_index", "latency", F.col("code").alias("type"))


def eeg_triggers(pair: RecordingPair) -> DataFrame:
    """EEG candidates after the seven of the leading validation sequence."""
    placed = candidates(pair).withColumn("_k", F.row_number().over(Window.partitionBy("recording_id").orderBy("event_index")))
    return placed.where(F.col("_k") > len(triggers.VALIDATION)).select("recording_id", (F.col("_k") - len(triggers.VALIDATION)).cast("long").alias("event_index"), "latency", "type")


def interruptions(pair: RecordingPair, eeg: DataFrame) -> DataFrame:
    """Marked amplifier interruptions, anchored at triggers."""
    markers = triggers.normalise(pair.eeg_events).where("kind = 'marker'").select("recording_id", F.col("event_index").alias("raw_event_index"), "latency", "code")
    return triggers.interruption_anchors(triggers.amplifier_pairs(markers), eeg)


def edf_events(pair: RecordingPair) -> DataFrame:
    """Coded pulses of the trace, split where they merged."""
    pieces = triggers.split_pulses(pair.trace)
    inside = segments.slices(pair.trace, pieces.select("recording_id", F.col("latency").alias("segment_index"), F.col("latency").alias("start_sample"), F.col("end").alias("end_sample")), ["recording_id"])
    coded = inside.groupBy("recording_id", F.col("segment_index").alias("latency")).agg(triggers.band_code(F.max("volts")).alias("type"))
    return coded.withColumn("event_index", F.row_number().over(Window.partitionBy("recording_id").orderBy("latency")).cast("long"))


def edf_triggers(events: DataFrame) -> DataFrame:
    return triggers.clean_triggers(events).select("recording_id", F.col("event_index").cast("long").alias("event_index"), "latency", "type")


def lengths(pair: RecordingPair) -> DataFrame:
    """Recordings whose trace and clinical channels do not have lengths in the ratio of their rates: recording_id, error."""
    trace = pair.trace.groupBy("recording_id").agg(F.count("*").alias("t"))
    c3 = pair.clinical.where("channel = 'M1'").groupBy("recording_id").agg(F.count("*").alias("c"))
    return trace.join(c3, "recording_id", "left").where(F.coalesce(F.col("t") * pair.ratio != F.col("c"), F.lit(True))).select("recording_id", F.lit("align_recordings:LengthRatio").alias("error"))


def align(pair: RecordingPair) -> dict[str, DataFrame]:
    """Every step's result: eeg_events, interruptions, edf_events, startup, segments, truncated, resampled, aligned, coverage, faults, output, and errors; with headers also bounds.

    Events, segments, aligned samples and errors serve several results and are computed here, see ``computed``.
    errors: recording_id, step, error. Each recording's first error of a step is one row; output has no row of a recording that errors names.
    """
    require((pair.eeg_rate, pair.trigger_rate, pair.clinical_rate) == (500.0, 128.0, 256.0), "align_recordings:UnexpectedRate", f"{pair.eeg_rate}, {pair.trigger_rate}, {pair.clinical_rate}")
    step = lambda df, name: df.select("recording_id", F.lit(name).alias("step"), "error")
    wrong = triggers.event_problems(candidates(pair))
    eeg = eeg_triggers(pair).join(wrong, "recording_id", "left_anti")
    gaps = interruptions(pair, eeg).join(wrong, "recording_id", "left_anti")
    coded = computed(edf_events(pair))
    edf = edf_triggers(coded)
    startup = triggers.startup_counts(coded, edf)
    told = computed(segment_recordings(eeg, edf.join(wrong, "recording_id", "left_anti"), pair.eeg_rate, pair.trigger_rate, gaps, startup.join(wrong, "recording_id", "left_anti")))
    seg = told.where("error is null")
    chosen = montage.select_channels(pair.eeg).drop("channel_order")
    cut = segments.slices(chosen, seg.select("recording_id", "segment_index", F.col("eeg_start_sample").alias("start_sample"), F.col("eeg_end_sample").alias("end_sample")), ["recording_id"])
    resampled = resampling.resample_blocks(cut, seg, pair.trigger_rate, pair.ratio)
    start = seg.select("recording_id", "segment_index", ((F.col("edf_start_sample") - 1) * pair.ratio).alias("before"), ((F.col("edf_end_sample") - 1) * pair.ratio + 1).alias("end_sample"))
    placed = resampled.join(start, ["recording_id", "segment_index"]).select("recording_id", "channel", (F.col("sample") + F.col("before")).alias("sample"), "value")
    # One row per sample from here on: the clinical samples are the grid, what no segment covers is zero.
    grid = pair.clinical.select("recording_id", "sample").distinct()
    wide = grid.join(montage.pivot(placed, montage.ELECTRODES), ["recording_id", "sample"], "left").withColumn("matched", F.col("M1").isNotNull())
    wide = computed(wide.select("recording_id", "sample", "matched", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in montage.ELECTRODES)))
    mask = wide.select("recording_id", "sample", "matched")
    unfit = montage.fault_inputs(pair.clinical, mask, pair.headers)
    faults = montage.fault(pair.clinical.join(mask, ["recording_id", "sample"]))
    output = montage.splice_wide(wide, pair.clinical, faults)
    spans = start.select("recording_id", (F.col("before") + 1).alias("start_sample"), "end_sample")
    over = montage.overlaps(spans).select("recording_id").distinct().select("recording_id", F.lit("concatenate_eeg_segments:InvalidSegmentBounds").alias("error"))
    short = resampling.length_problems(cut, seg, len(montage.ELECTRODES)).groupBy("recording_id").agg(F.min_by("error", "segment_index").alias("error"))
    errors = [(lengths(pair), "inputs"), (wrong, "eeg_events"), (told.where("error is not null"), "segments"), (short, "resample"), (over, "concatenate"), (unfit, "faults")]
    out = {"eeg_events": eeg, "interruptions": gaps, "edf_events": edf, "startup": startup, "segments": told, "truncated": cut, "resampled": resampled, "aligned": wide, "coverage": montage.coverage(mask), "faults": faults, "output": output}
    if pair.headers is not None:
        direct = pair.headers.where(F.col("channel").isin(*montage.OUTPUT))
        out["bounds"] = montage.bounds(output, direct.select("recording_id", "channel", "physical_min", "physical_max"))
        failed = out["bounds"].groupBy("recording_id").agg(F.sum("n_bad").alias("n_bad"), F.bool_or("fails").alias("fails"))
        failed = failed.select("recording_id", F.when(F.col("n_bad") > 0, "substitute_eeg_data:NonfiniteSignalData").when(F.col("fails"), "substitute_eeg_data:OutputOutsidePhysicalBounds").alias("error")).where("error is not null")
        header = montage.header_problems(direct).groupBy("recording_id").agg(F.concat(F.lit("substitute_eeg_data:"), F.min("problem")).alias("error"))
        errors += [(header, "headers"), (failed, "bounds")]
    every = None
    for df, name in errors:
        every = step(df, name) if every is None else every.union(step(df, name))
    out["errors"] = every = computed(every)
    out["output"] = output.join(every.select("recording_id").distinct(), "recording_id", "left_anti")
    return out
