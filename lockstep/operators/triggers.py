"""From raw events and trigger traces to typed trigger tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import as_of, block_runs, matches_at, runs, within_match

KEY = ["recording_id"]
# Inclusive voltage bands of the codes.
BANDS = (("1", 5.0, 6.0), ("2", 11.0, 12.1), ("4", 18.0, 19.0), ("8", 24.0, 25.0), ("16", 30.0, 31.0), ("63", 36.0, 37.0), ("64", 42.0, 43.0))
VALIDATION = ["1", "2", "4", "8", "16", "32", "64"]
RAW_VALIDATION = ["1", "2", "4", "8", "16", "63", "64"]
CODES = ("63", "64")


def normalise(events: DataFrame) -> DataFrame:
    """Trimmed text, its code (before the first comma), and its class."""
    text, code = F.trim("type"), F.trim(F.substring_index(F.trim("type"), ",", 1))
    kind = F.when(F.contains(F.lower(text), F.lit("impedance")), "impedance").when(F.lower(text) == "boundary", "boundary").when(code.isin("9001", "9002"), "marker").otherwise("candidate")
    return events.withColumn("text", text).withColumn("code", code).withColumn("kind", kind)


def band_code(value: Column) -> Column:
    """The code of a pulse's largest value; orphan outside of all bands."""
    out = F.lit("orphan")
    for code, low, high in reversed(BANDS):
        out = F.when(value.between(low, high), code).otherwise(out)
    return out


def pulses(trace: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Stretches of samples above the threshold, with their largest value and its code."""
    found = block_runs(trace, KEY, "sample", F.when(F.col("volts") > threshold, True), max_value=F.col("volts"))
    return found.select("recording_id", F.col("first").alias("latency"), F.col("last").alias("end"), "max_value", band_code(F.col("max_value")).alias("type"))


def split_pulses(trace: DataFrame, threshold: float = 1.0, least: int = 3) -> DataFrame:
    """Pulses as [latency, end], where one that holds a 63 stretch before a 64 stretch (least samples each) becomes two."""
    low63, high63 = BANDS[5][1:]
    low64, high64 = BANDS[6][1:]
    above = trace.where(F.col("volts") > threshold)
    whole = block_runs(above, KEY, "sample", F.lit(True))
    band = F.when(F.col("volts").between(low63, high63), "63").when(F.col("volts").between(low64, high64), "64")
    bands = block_runs(above, KEY, "sample", band).where(F.col("last") - F.col("first") + 1 >= least)
    # A run of one band lies within one pulse, the last that starts before it.
    parts = as_of(bands, whole.select("recording_id", "first", F.col("first").alias("_latency")), KEY, "first", "_latency", "latency")
    inner = Window.partitionBy("recording_id", "latency").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    pairs = parts.withColumn("end63", F.last(F.when(F.col("value") == "63", F.col("last")), True).over(inner)).where("value = '64' and end63 is not null")
    cut = pairs.groupBy("recording_id", "latency").agg(F.min_by(F.struct("end63", F.col("first").alias("start64")), "first").alias("cut"))
    told = whole.withColumnRenamed("first", "latency").join(cut, ["recording_id", "latency"], "left")
    pieces = F.when(F.col("cut").isNull(), F.array(F.struct("latency", F.col("last").alias("end")))).otherwise(
        F.array(F.struct("latency", F.col("cut.end63").alias("end")), F.struct(F.col("cut.start64").alias("latency"), F.col("last").alias("end")))
    )
    return told.select("recording_id", F.inline(pieces))


def relabel(events: DataFrame, order: str = "event_index") -> DataFrame:
    """The sixth row of a raw validation sequence becomes 32."""
    started = events.withColumn("_start", matches_at(KEY, order, "type", RAW_VALIDATION))
    return started.withColumn("type", F.when(within_match(KEY, order, "_start", 7, 5), "32").otherwise(F.col("type"))).drop("_start")


def mark_validation(events: DataFrame, order: str = "event_index") -> DataFrame:
    """is_validation for rows of complete validation sequences."""
    started = events.withColumn("_start", matches_at(KEY, order, "type", VALIDATION))
    return started.withColumn("is_validation", within_match(KEY, order, "_start", 7)).withColumn("is_start", F.col("_start")).drop("_start")


def validation_sequences(events: DataFrame, order: str = "event_index") -> DataFrame:
    """Start and end latency of each validation sequence, and whether it is the last."""
    w = Window.partitionBy("recording_id").orderBy(order)
    found = events.withColumn("_start", matches_at(KEY, order, "type", VALIDATION)).withColumn("end_latency", F.lead("latency", 6).over(w)).where("_start")
    last = F.max("latency").over(Window.partitionBy("recording_id"))
    return found.select("recording_id", F.col("latency").alias("start_latency"), "end_latency", (F.col("latency") == last).alias("is_authoritative"))


def drop_malformed(events: DataFrame, order: str = "event_index") -> DataFrame:
    """Without 64-runs whose length is not 4, but for a run of 5 that a validation row leads; orphans still part rows."""
    marked = mark_validation(events, order)
    found = runs(marked, KEY, order, F.when(F.col("type") == "64", F.col("type")), F.min_by("is_validation", order).alias("led"))
    bad = found.where("not (length = 4 or (length = 5 and led))").select("recording_id", F.explode(F.sequence("first", "last")).alias(order))
    return marked.join(bad, ["recording_id", order], "left_anti")


def clean_triggers(events: DataFrame, order: str = "event_index") -> DataFrame:
    """Relabelled, without malformed runs, orphans and validation rows: event_index anew."""
    kept = drop_malformed(relabel(events, order), order).where("type <> 'orphan' and not is_validation")
    return kept.withColumn("event_index", F.row_number().over(Window.partitionBy("recording_id").orderBy(order)))


def startup_counts(events: DataFrame, kept: DataFrame, order: str = "event_index") -> DataFrame:
    """Validation sequences of each recording, and the kept triggers before the last of them.

    events: all triggers as coded, kept: those of ``clean_triggers``.
    """
    found = validation_sequences(relabel(events, order), order)
    last = found.groupBy("recording_id").agg(F.count("*").alias("validations"), F.max("start_latency").alias("_at"))
    told = events.select("recording_id").distinct().join(last, "recording_id", "left")
    before = kept.join(last, "recording_id").where("latency < _at").groupBy("recording_id").agg(F.count("*").alias("before_last"))
    return told.join(before, "recording_id", "left").select("recording_id", F.coalesce("validations", F.lit(0)).cast("int").alias("validations"), F.coalesce("before_last", F.lit(0)).cast("int").alias("before_last"))


def event_problems(events: DataFrame, order: str = "event_index") -> DataFrame:
    """Recordings whose EEG candidates do not start with the seven validation codes, or hold other types than 63 and 64 after them: recording_id, error.

    events: recording_id, event_index, type of all candidates.
    """
    w = Window.partitionBy("recording_id").orderBy(order)
    placed = events.withColumn("_k", F.row_number().over(w))
    lead = F.array_sort(F.collect_list(F.when(F.col("_k") <= 7, F.struct("_k", "type"))))
    told = placed.groupBy("recording_id").agg(F.transform(lead, lambda x: x["type"]).alias("lead"), F.bool_or((F.col("_k") > 7) & ~F.col("type").isin(*CODES)).alias("other"))
    wrong = F.when(F.col("lead") != F.array(*map(F.lit, VALIDATION)), "extract_triggers:InvalidLeadingValidation").when(F.coalesce("other", F.lit(False)), "extract_triggers:UnexpectedEEGEventType")
    return told.select("recording_id", wrong.alias("error")).where("error is not null")


def unexpected_types(events: DataFrame) -> DataFrame:
    """Types other than 63 and 64."""
    return events.select("recording_id", "type").distinct().where(~F.col("type").isin(*CODES))


def amplifier_pairs(markers: DataFrame, order: str = "raw_event_index") -> DataFrame:
    """Disconnects with their reconnects, and a problem where they do not alternate.

    markers: recording_id, raw_event_index, latency, code (9001 or 9002).
    """
    w = Window.partitionBy("recording_id").orderBy(order)
    seen = markers.withColumn("before", F.lag("code").over(w)).withColumn("after", F.lead("code").over(w)).withColumn("next_latency", F.lead("latency").over(w)).withColumn("next_index", F.lead(order).over(w))
    problem = (
        F.when((F.col("code") == "9001") & (F.col("after") == "9001"), "double_disconnect")
        .when((F.col("code") == "9002") & F.coalesce(F.col("before") != "9001", F.lit(True)), "orphan_reconnect")
        .when((F.col("code") == "9001") & (F.col("next_latency") < F.col("latency")), "reconnect_before_disconnect")
    )
    status = F.when(F.col("after").isNull(), "missing_reconnect").otherwise("paired")
    found = seen.withColumn("problem", problem).where("code = '9001' or problem is not null")
    return found.select("recording_id", F.col(order).alias("disconnect_index"), F.col("latency").alias("disconnect_latency"), F.when(F.col("after") == "9002", F.col("next_index")).alias("reconnect_index"), F.when(F.col("after") == "9002", F.col("next_latency")).alias("reconnect_latency"), F.when(F.col("problem").isNull(), status).alias("pairing_status"), "problem")


def interruption_anchors(pairs: DataFrame, triggers: DataFrame) -> DataFrame:
    """Pairs with the last trigger at or before the disconnect, and the first at or after the reconnect."""
    t = triggers.select("recording_id", "latency", F.struct("event_index", "latency").alias("at"))
    back = as_of(pairs.withColumn("latency", F.col("disconnect_latency")), t, KEY, "latency", "at", "start_anchor")
    open_ = back.where("reconnect_latency is null").withColumn("end_anchor", F.lit(None).cast(t.schema["at"].dataType))
    closed = as_of(back.where("reconnect_latency is not null").withColumn("latency", F.col("reconnect_latency")), t, KEY, "latency", "at", "end_anchor", forward=True)
    both = closed.unionByName(open_).drop("latency")
    return both.select("*", *(F.col(f"{a}_anchor.{f}").alias(f"eeg_{a}_anchor_{f}") for a in ("start", "end") for f in ("event_index", "latency"))).drop("start_anchor", "end_anchor")


def intervals(events: DataFrame, rate: float, order: str = "event_index") -> DataFrame:
    """Seconds to the trigger before, and the recording's time of each trigger."""
    time = (F.col("latency") - 1) / rate
    w = Window.partitionBy("recording_id").orderBy(order)
    return events.withColumn("time_sec", time).withColumn("interval_sec", time - F.lag(time).over(w))
