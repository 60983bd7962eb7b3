"""The recurring trigger cycle: chunks, their consensus, and how each chunk compares with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import computed
from ..functions.tolerance import slack, within
from .ordered import runs

KEY = ["recording_id"]


def chunks(events: DataFrame, rate: float) -> DataFrame:
    """events with time_sec, chunk_index, position in the chunk, and the interval to the next trigger.

    A chunk starts at each run of four 64; what comes before the first is a partial one. The last trigger
    of a chunk reaches the next chunk's first.
    """
    w = Window.partitionBy("recording_id").orderBy("event_index")
    bounds = runs(events, KEY, "event_index", F.when(F.col("type") == "64", F.col("type"))).where("length = 4").select("recording_id", F.col("first").alias("event_index"), F.lit(1).alias("bound"))
    timed = events.join(bounds, ["recording_id", "event_index"], "left").withColumn("time_sec", (F.col("latency") - 1) / rate)
    started = timed.withColumn("chunk", F.sum(F.coalesce("bound", F.lit(0))).over(w))
    first = F.min("chunk").over(Window.partitionBy("recording_id"))
    numbered = started.withColumn("chunk_index", (F.col("chunk") - first + 1).cast("int")).withColumn("is_partial_start", F.col("chunk") == 0)
    inner = Window.partitionBy("recording_id", "chunk_index").orderBy("event_index")
    return numbered.withColumn("interval_to_next_sec", F.lead("time_sec").over(w) - F.col("time_sec")).withColumn("position", F.row_number().over(inner).cast("long")).drop("chunk", "bound")


def shapes(events: DataFrame) -> DataFrame:
    """One row per chunk: types and intervals in order, and whether a next boundary bounds it."""
    last = F.max("chunk_index").over(Window.partitionBy("recording_id"))
    each = events.withColumn("has_next_boundary", F.col("chunk_index") < last)
    rows = F.array_sort(F.collect_list(F.struct("position", "type", "interval_to_next_sec")))
    grouped = each.groupBy("recording_id", "chunk_index").agg(
        rows.alias("rows"), F.min("event_index").alias("start_event_index"), F.max("event_index").alias("end_event_index"), F.min("latency").alias("start_latency"),
        F.min("time_sec").alias("start_time_sec"), F.count("*").alias("observed_trigger_count"), F.first("has_next_boundary").alias("has_next_boundary"), F.first("is_partial_start").alias("is_partial_start"),
    )
    return grouped.select("*", F.transform("rows", lambda r: r["type"]).alias("types"), F.filter(F.transform("rows", lambda r: r["interval_to_next_sec"]), lambda x: x.isNotNull()).alias("gaps")).drop("rows")


def complete(chunk_shapes: DataFrame) -> DataFrame:
    """Chunks between two boundaries."""
    return chunk_shapes.where("has_next_boundary and not is_partial_start")


def _largest_error(a: str, b: str):
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def compatible(chunk_shapes: DataFrame, tolerance: float) -> DataFrame:
    """Ordered pairs (chunk_index, other) of complete chunks with equal types and intervals within the tolerance, each with itself too.

    The join is on the number of triggers and their types, so only chunks of one shape meet.
    """
    a = complete(chunk_shapes).withColumn("shape", F.concat_ws(",", "types")).select("recording_id", "shape", "chunk_index", "gaps")
    b = a.select("recording_id", "shape", F.col("chunk_index").alias("other"), F.col("gaps").alias("gaps2"))
    scale = F.greatest(F.array_max("gaps"), F.array_max("gaps2"))
    return a.join(b, ["recording_id", "shape"]).where((F.size("gaps") == F.size("gaps2")) & (_largest_error("gaps", "gaps2") <= tolerance + slack(scale))).select("recording_id", "chunk_index", "other")


def consensus(pairs: DataFrame) -> DataFrame:
    """recording_id, the first chunk with most support, that support, and whether another top chunk disagrees with it."""
    support = pairs.groupBy("recording_id", "chunk_index").agg(F.count("*").alias("support"))
    top = support.withColumn("most", F.max("support").over(Window.partitionBy("recording_id"))).where("support = most")
    chosen = top.groupBy("recording_id").agg(F.min("chunk_index").alias("chosen"), F.first("most").alias("support"))
    own = pairs.withColumnRenamed("chunk_index", "chosen").join(chosen.select("recording_id", "chosen"), ["recording_id", "chosen"]).select("recording_id", F.col("other").alias("chunk_index"))
    apart = top.join(own, ["recording_id", "chunk_index"], "left_anti").groupBy("recording_id").agg(F.count("*").alias("apart"))
    return chosen.join(apart, "recording_id", "left").select("recording_id", "chosen", "support", (F.coalesce("apart", F.lit(0)) > 0).alias("ambiguous"))


def canonical(chunk_shapes: DataFrame, tolerance: float) -> DataFrame:
    """position, type, relative_time_sec, interval_to_next_sec of the cycle: medians over the chunks compatible with the chosen one."""
    pairs = computed(compatible(chunk_shapes, tolerance))
    chosen = consensus(pairs).where("support >= 2 and not ambiguous")
    members = pairs.join(chosen.select("recording_id", F.col("chosen").alias("chunk_index")), ["recording_id", "chunk_index"]).select("recording_id", F.col("other").alias("chunk_index"))
    rows = chunk_shapes.join(members, ["recording_id", "chunk_index"]).select("recording_id", F.posexplode(F.arrays_zip("types", "gaps")).alias("p", "x"))
    rows = rows.select("recording_id", (F.col("p") + 1).cast("long").alias("position"), F.col("x.types").alias("type"), F.col("x.gaps").alias("interval_to_next_sec"))
    middle = rows.groupBy("recording_id", "position").agg(F.first("type").alias("type"), F.median("interval_to_next_sec").alias("interval_to_next_sec"))
    w = Window.partitionBy("recording_id").orderBy("position")
    past = F.coalesce(F.sum("interval_to_next_sec").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    timed = middle.withColumn("past", past)
    zero = F.min(F.when(F.col("type") == "63", F.struct("position", "past"))).over(Window.partitionBy("recording_id"))
    return timed.withColumn("relative_time_sec", F.col("past") - zero["past"]).drop("past")


def report(chunk_shapes: DataFrame, cycle: DataFrame, tolerance: float) -> DataFrame:
    """Each chunk with its duration, estimated cycles, status and reason against the cycle, and its largest interval error."""
    rows = F.array_sort(F.collect_list(F.struct("position", "type", "interval_to_next_sec")))
    c = cycle.groupBy("recording_id").agg(rows.alias("rows"), F.sum("interval_to_next_sec").alias("canon_sec"))
    c = c.select("recording_id", "canon_sec", F.transform("rows", lambda r: r["type"]).alias("canon_types"), F.transform("rows", lambda r: r["interval_to_next_sec"]).alias("canon_gaps"))
    j = chunk_shapes.join(c, "recording_id")
    total = F.when(F.col("has_next_boundary"), F.aggregate("gaps", F.lit(0.0), lambda a, x: a + x))
    j = j.withColumn("chunk_duration_sec", total).withColumn("estimated_cycle_count", F.when(total.isNotNull(), F.greatest(F.lit(1.0), F.round(total / F.col("canon_sec")))))
    same = (F.col("types") == F.col("canon_types")) & (F.size("gaps") == F.size("canon_gaps"))
    j = j.withColumn("max_interval_error_sec", F.when(same, _largest_error("gaps", "canon_gaps")))
    close = F.col("max_interval_error_sec") <= tolerance + slack(F.greatest(F.array_max("gaps"), F.array_max("canon_gaps")))
    n, m = F.size("types"), F.size("canon_types")
    status = F.when(F.col("is_partial_start"), "partial_start").when(~F.col("has_next_boundary"), "partial_end").when(same & close, "match").when(F.col("estimated_cycle_count") > 1, "ambiguous").otherwise("mismatch")
    reason = (
        F.when(F.col("is_partial_start"), "before_first_boundary").when(~F.col("has_next_boundary"), "no_next_boundary").when(same & close, "canonical_match")
        .when(F.col("estimated_cycle_count") > 1, "suspected_missing_boundary").when(n != m, "trigger_count").when(F.col("types") != F.col("canon_types"), "trigger_types").otherwise("interval_timing")
    )
    return j.select("recording_id", "chunk_index", "start_event_index", "end_event_index", "start_latency", "start_time_sec", "observed_trigger_count", "chunk_duration_sec", "has_next_boundary", "estimated_cycle_count", status.alias("status"), reason.alias("reason"), "max_interval_error_sec")


def repeat_counts(chunk_report: DataFrame) -> DataFrame:
    """How often each recording repeats its cycle: recording_id, repeat_count of the chunks that match it."""
    return chunk_report.groupBy("recording_id").agg(F.count_if(F.col("status") == "match").alias("repeat_count"))


def followed(events: DataFrame) -> DataFrame:
    """events with the type and index of the next one."""
    w = Window.partitionBy("recording_id").orderBy("event_index")
    return events.withColumn("destination_type", F.lead("type").over(w)).withColumn("destination_event_index", F.lead("event_index").over(w))


def edges(events: DataFrame) -> DataFrame:
    """source and destination of every interval, with its chunk and position; a chunk's last edge reaches the next chunk. Events that are ``followed`` already need no window."""
    e = events if "destination_event_index" in events.columns else followed(events)
    return e.where("destination_event_index is not null").select("recording_id", "chunk_index", F.col("position").alias("interval_number"), F.col("type").alias("source_type"), "destination_type", F.col("interval_to_next_sec").alias("interval_sec"), F.col("event_index").alias("source_event_index"), "destination_event_index")


def canonical_edges(cycle: DataFrame) -> DataFrame:
    """The cycle's intervals; the last returns to the first."""
    w = Window.partitionBy("recording_id").orderBy("position")
    first = F.first("type").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return cycle.select("recording_id", F.col("position").alias("interval_number"), F.col("type").alias("source_type"), F.coalesce(F.lead("type").over(w), first).alias("destination_type"), F.col("interval_to_next_sec").alias("interval_sec"))


def prefix_suffix(observed: DataFrame, reference: DataFrame, keys: list[str], shared: list[str], tolerance: float, both: bool = True, types: bool = False) -> DataFrame:
    """Leading and trailing edges of observed that equal those of reference; the suffix does not overlap the prefix, in either or (not both) in observed.

    types: with the numbers and types of observed's edges, in order.

    Edges have interval_number from 1, types and interval_sec; observed is by keys, reference by shared (some of keys).
    Lists are compared as arrays, so each side is grouped once and joined once.
    """
    rows = F.array_sort(F.collect_list(F.struct("interval_number", "source_type", "destination_type", "interval_sec")))
    o, r = observed.groupBy(*keys).agg(rows.alias("o")), reference.groupBy(*shared).agg(rows.alias("r"))

    def leading(a, b):
        same = F.zip_with(a, b, lambda x, y: F.coalesce((x["source_type"] == y["source_type"]) & (x["destination_type"] == y["destination_type"]) & within(x["interval_sec"], y["interval_sec"], tolerance), F.lit(False)))
        at = F.array_position(same, False)
        return F.when(at == 0, F.size(same)).otherwise(at - 1)

    j = o.join(r, shared).withColumn("prefix", leading(F.col("o"), F.col("r")).cast("long")).withColumn("_s", leading(F.reverse("o"), F.reverse("r")))
    n, m = F.size("o").cast("long"), F.size("r").cast("long")
    told = [F.transform("o", lambda x: F.struct(x["interval_number"].alias("interval_number"), x["source_type"].alias("source_type"), x["destination_type"].alias("destination_type"))).alias("types")] if types else []
    return j.select(*keys, "prefix", F.greatest(F.lit(0), F.least("_s", (F.least(n, m) if both else n) - F.col("prefix"))).alias("suffix"), n.alias("n_observed"), m.alias("n_reference"), *told)
