"""Interval joins, matched segments and their clock drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tolerance import within


def containing(points: DataFrame, spans: DataFrame, point: str, low: str, high: str, keys: tuple[str, ...] = ("recording_id",)) -> DataFrame:
    """points with the first span of their recording that holds them: low <= point <= high.

    An as-of join on the spans' starts, then a check of the end: linear where spans do not overlap.
    """
    from .ordered import as_of

    found = as_of(points.withColumn("_at", F.col(point).cast("double")), spans.select(*keys, F.col(low).cast("double").alias("_at"), F.struct(*(c for c in spans.columns if c not in keys)).alias("_s")), list(keys), "_at", "_s", "_span")
    ok = F.col(point) <= F.col(f"_span.{high}")
    return found.where(ok).select(*points.columns, "_span.*")


def same_edge(tolerance: float) -> Column:
    """Whether edges aliased a and b have equal types and intervals within the tolerance."""
    return (F.col("a.source_type") == F.col("b.source_type")) & (F.col("a.destination_type") == F.col("b.destination_type")) & within(F.col("a.interval_sec"), F.col("b.interval_sec"), tolerance)


def sequence_starts(target: DataFrame, reference: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Every offset of the reference at which all target edges match, one after another.

    The join is on recording and types, so a target edge meets only reference edges that can match.
    """
    w = Window.partitionBy(*keys).orderBy("interval_number")
    t = target.withColumn("k", F.row_number().over(w) - 1).withColumn("need", F.count("*").over(Window.partitionBy(*keys)))
    hit = t.alias("a").join(reference.alias("b"), (F.col("a.recording_id") == F.col("b.recording_id")) & same_edge(tolerance))
    found = hit.select(*(F.col(f"a.{k}") for k in keys), (F.col("b.interval_number") - F.col("a.k")).alias("offset"), "a.need")
    return found.groupBy(*keys, "offset", "need").count().where("count = need").select(*keys, "offset")


def excluded(pairs: DataFrame, gaps: DataFrame, source: str = "source_event_index") -> DataFrame:
    """pairs that no excluded interruption covers.

    gaps: recording_id, start, end (event indexes). Both open: covers all. Start open: below the end.
    End open: from the start. End after the start: from it to before the end. Otherwise: the start itself.
    """
    return _met(pairs, gaps, source, "left_anti")


def covered(pairs: DataFrame, gaps: DataFrame, source: str = "source_event_index") -> DataFrame:
    """pairs that an excluded interruption covers: those that ``excluded`` leaves out."""
    return _met(pairs, gaps, source, "left_semi")


def _met(pairs: DataFrame, gaps: DataFrame, source: str, how: str) -> DataFrame:
    s, e, x = F.col("g.start"), F.col("g.end"), F.col(f"p.{source}")
    covers = F.when(s.isNull() & e.isNull(), True).when(s.isNull(), x < e).when(e.isNull(), x >= s).when(e > s, (x >= s) & (x < e)).otherwise(x == s)
    return pairs.alias("p").join(gaps.alias("g"), (F.col("p.recording_id") == F.col("g.recording_id")) & covers, how)


def matched_segments(pairs: DataFrame) -> DataFrame:
    """Contiguous runs of matched interval pairs: a break where either system's source is not the destination before it.

    pairs: recording_id, eeg_source, eeg_destination, edf_source, edf_destination, in order of eeg_source.
    """
    w = Window.partitionBy("recording_id").orderBy("eeg_source")
    new = F.coalesce((F.col("eeg_source") != F.lag("eeg_destination").over(w)) | (F.col("edf_source") != F.lag("edf_destination").over(w)), F.lit(True))
    return pairs.withColumn("segment_index", F.sum(new.cast("int")).over(w))


def segment_bounds(segments: DataFrame) -> DataFrame:
    first, last = (lambda c, f=f: f(c, "eeg_source") for f in (F.min_by, F.max_by))
    return segments.groupBy("recording_id", "segment_index").agg(
        first("eeg_source").alias("eeg_start_event"), last("eeg_destination").alias("eeg_end_event"), first("edf_source").alias("edf_start_event"), last("edf_destination").alias("edf_end_event"), F.count("*").alias("interval_count")
    )


def drift(points: DataFrame, keys: list[str]) -> DataFrame:
    """Fit of clock drift against elapsed time: slope, intercept, R squared, and the largest residual.

    points: keys, eeg_sec, edf_sec. Elapsed times count from the segment's first point. R squared is null below three
    points; where the total is within round-off it is 1 or 0 by the residual.
    """
    origin = points.groupBy(*keys).agg(F.min("eeg_sec").alias("eeg0"), F.min("edf_sec").alias("edf0"))
    p = points.join(origin, keys).withColumn("x", F.col("eeg_sec") - F.col("eeg0")).withColumn("y", F.col("edf_sec") - F.col("edf0") - F.col("x"))
    fit = p.groupBy(*keys).agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.avg("y").alias("mean"), F.count("*").alias("n"))
    r = p.join(fit, keys).withColumn("res", F.col("y") - F.col("slope") * F.col("x") - F.col("intercept"))
    s = r.groupBy(*keys).agg(F.max("n").alias("n"), F.max("slope").alias("slope"), F.max("intercept").alias("intercept"), F.sum(F.col("res") * F.col("res")).alias("ss_res"), F.sum((F.col("y") - F.col("mean")) * (F.col("y") - F.col("mean"))).alias("ss_tot"), F.max(F.abs("res")).alias("max_abs_residual"))
    floor = F.col("n") * F.pow(F.lit(10 * 2.0**-52), F.lit(2))
    r2 = F.when(F.col("n") < 3, None).when(F.col("ss_tot") <= floor, F.when(F.col("ss_res") <= floor, 1.0).otherwise(0.0)).otherwise(1 - F.col("ss_res") / F.col("ss_tot"))
    return s.select(*keys, "n", "slope", "intercept", r2.alias("r_squared"), "max_abs_residual")


#: Samples of a recording that are joined with segments together.
BLOCK = 1 << 16


def slices(samples: DataFrame, bounds: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """Samples inside segments (inclusive): bounds has keys, segment_index, start_sample, end_sample.

    An equi-join on keys and the block of samples: a recording is spread over as many tasks as it has blocks.
    """
    of = lambda c: F.floor(F.col(c) / block)
    spans = bounds.select(*keys, "segment_index", "start_sample", "end_sample", F.explode(F.sequence(of("start_sample"), of("end_sample"))).alias("_block"))
    found = samples.withColumn("_block", of("sample")).join(spans, [*keys, "_block"]).where("sample between start_sample and end_sample")
    return found.select(*samples.columns, "segment_index")
