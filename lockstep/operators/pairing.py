"""From a comparison history to pairs of intervals, as joins: no recording is held in one task.

A history row (recording_id, position, outcome, eeg_chunk, edf_chunk, next_eeg_chunk, next_edf_chunk, eeg_first, first_number, common) tells
what a comparison of two chunks came to. eeg_first and first_number are the first paired edge and its interval number of a partial start,
common the number of triggers that terminal chunks share; they are null elsewhere.

Whether the alignment is locked is a flag that each row sets, clears or leaves as it is: a match sets it; chunks that are unusable on both
sides and a loss without a matching end clear it; other rows leave it. So the flag before a row is what the last row that told it said, one window. Rows whose
pairing needs the lock become spans of edges, and spans become pairs by equi-joins on chunk and edge number.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lcs
from ..functions.lineage import computed
from .cycle import prefix_suffix
from .segments import covered, excluded

LOSSES = ("eeg_data_loss", "edf_data_loss")
TERMINAL = ("eeg_shorter", "eeg_longer", "same_last_trigger")
EDGE = ("interval_number", "source_type", "destination_type", "interval_sec")


def canonical_numbers(observed: DataFrame, reference: DataFrame, keys: list[str], shared: list[str], tolerance: float) -> DataFrame:
    """keys, interval_number of each observed edge, and canonical_number: that of the reference's edge in their longest common subsequence, or null.

    Edges have interval_number from 1, types and interval_sec; observed is by keys, reference by shared (some of keys).
    Of several longest ones: equal edges are taken where they meet, else the observed edge is passed over unless that loses length.

    Lists are met by a join; many pairs of them are compared side by side, see ``lcs``.
    """
    rows = F.sort_array(F.collect_list(F.struct(*EDGE)))
    o, r = observed.groupBy(*keys).agg(rows.alias("o")), reference.groupBy(*shared).agg(rows.alias("r"))
    j = o.join(r, shared, "left").withColumn("r", F.coalesce("r", F.array().cast(r.schema["r"].dataType))).select(*keys, "o", "r")

    def run(batches):
        for batch in batches:
            row, own, known = lcs.numbers(batch, tolerance)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(row) for k in keys), own, known], [*keys, "interval_number", "canonical_number"])

    kind = lambda df: df.schema["interval_number"].dataType.simpleString()
    return j.mapInArrow(run, ", ".join(f"{k} {j.schema[k].dataType.simpleString()}" for k in keys) + f", interval_number {kind(observed)}, canonical_number {kind(reference)}")


def with_lock(history: DataFrame, sets: Column) -> DataFrame:
    """history with locked: whether the alignment is trusted before each row. sets: true or false where a row tells the flag, null where it leaves it."""
    before = Window.partitionBy("recording_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return history.withColumn("_sets", sets).withColumn("locked", F.coalesce(F.last("_sets", True).over(before), F.lit(True))).drop("_sets")


def covered_chunks(edges: DataFrame, gaps: DataFrame) -> DataFrame:
    """recording_id, chunk_index of chunks with an edge that an excluded interruption covers."""
    return covered(edges, gaps).select("recording_id", "chunk_index").distinct()


def _own(name: str) -> Column:
    """A count of the side that a loss affects."""
    return F.when(F.col("outcome") == LOSSES[0], F.col(f"eeg_{name}")).otherwise(F.col(f"edf_{name}"))


def judged(history: DataFrame, eeg: DataFrame, edf: DataFrame, eeg_canon: DataFrame, edf_canon: DataFrame, gaps: DataFrame, tolerance: float) -> DataFrame:
    """history with each chunk's edges that equal the cycle's at its ends, suffix (where a loss relocks), handled (a loss that
    an interruption explains, so that all edges pair), and locked before each row."""
    h = history
    for side, edges, canon in (("eeg", eeg, eeg_canon), ("edf", edf, edf_canon)):
        ends = prefix_suffix(edges, canon, ["recording_id", "chunk_index"], ["recording_id"], tolerance, both=False, types=True)
        h = h.join(ends.select("recording_id", F.col("chunk_index").alias(f"{side}_chunk"), *(F.col(c).alias(f"{side}_{c}") for c in ("prefix", "suffix", "n_observed", "n_reference", "types"))), ["recording_id", f"{side}_chunk"])
        size = ends.select("recording_id", (F.col("chunk_index") + 1).alias(f"next_{side}_chunk"), F.col("n_observed").alias(f"{side}_before_next"))
        h = h.join(size, ["recording_id", f"next_{side}_chunk"], "left")
    h = h.join(covered_chunks(eeg, gaps).select("recording_id", F.col("chunk_index").alias("eeg_chunk"), F.lit(True).alias("covered")), ["recording_id", "eeg_chunk"], "left")
    loss = F.col("outcome").isin(*LOSSES)
    relock = F.col("next_eeg_chunk").isNotNull() & F.col("next_edf_chunk").isNotNull()
    suffix = F.when(relock, _own("suffix")).otherwise(0)
    handled = loss & F.coalesce("covered", F.lit(False)) & (F.col("eeg_n_observed") == F.col("edf_n_observed")) & (F.col("eeg_types") == F.col("edf_types"))
    sets = F.when(F.col("outcome").isin("match", "partial_start_match"), True).when(F.col("outcome") == "both_systems_unusable", False).when(loss & ~handled & (suffix == 0), False)
    return with_lock(h.withColumn("suffix", suffix).withColumn("handled", handled), sets)


def spans(history: DataFrame) -> DataFrame:
    """recording_id, position, eeg_chunk, eeg_from, edf_chunk, edf_from, number_from, count, whole: runs of edges that pair one by one, of a judged history.

    number_from is null where the intervals' numbers have to be found; whole tells whether the whole cycle is looked at for these, or all but its
    last interval. A match or glitch of unequal chunks pairs the edges that both have.
    """
    outcome, suffix, whole = F.col("outcome"), F.col("suffix"), F.col("handled")
    loss = outcome.isin(*LOSSES)
    both = F.least("eeg_n_observed", "edf_n_observed")
    one, null = F.lit(1).cast("long"), F.lit(None).cast("long")

    def span(when, count, eeg_from=one, edf_from=one, number=one, eeg_chunk=F.col("eeg_chunk"), edf_chunk=F.col("edf_chunk"), full=True):
        fields = (("eeg_chunk", eeg_chunk, "int"), ("eeg_from", eeg_from, "long"), ("edf_chunk", edf_chunk, "int"), ("edf_from", edf_from, "long"), ("number_from", number, "long"), ("count", count, "long"))
        return F.when(when & (count > 0), F.struct(*(c.cast(kind).alias(name) for name, c, kind in fields), F.lit(full).alias("whole")))

    locked, eeg_loss = F.col("locked"), outcome == LOSSES[0]
    # The clean side of a loss ends with the chunk before the one that relocks.
    clean_chunk = F.when(eeg_loss, F.col("next_edf_chunk")).otherwise(F.col("next_eeg_chunk")) - 1
    clean = F.when(eeg_loss, F.col("edf_before_next")).otherwise(F.col("eeg_before_next"))
    ends = [F.when(eeg_loss, a).otherwise(b) for a, b in ((_own("n_observed"), clean), (clean, _own("n_observed")))]
    found = F.array(
        span(outcome == "match", both),
        span(outcome == "partial_start_match", F.least(F.col("eeg_n_observed") - F.col("eeg_first") + 1, F.col("edf_n_observed")), F.col("eeg_first"), one, F.col("first_number")),
        span((outcome == "shared_trigger_glitch") & locked, both, number=null),
        span(loss & locked & whole, both),
        span(loss & locked & ~whole, F.least(_own("prefix"), both)),
        span(loss & locked & ~whole, F.least(suffix, clean), ends[0] - suffix + 1, ends[1] - suffix + 1, _own("n_reference") - suffix + 1, F.when(eeg_loss, F.col("eeg_chunk")).otherwise(clean_chunk), F.when(eeg_loss, clean_chunk).otherwise(F.col("edf_chunk"))),
        span((outcome == "both_systems_unusable") & locked, F.least("eeg_prefix", "edf_prefix")),
        span(outcome.isin(*TERMINAL) & locked, F.least(F.col("common") - 1, both), number=null, full=False),
    )
    return history.select("recording_id", "position", F.inline(F.filter(found, lambda x: x.isNotNull())))


def interval_pairs(history: DataFrame, eeg: DataFrame, edf: DataFrame, eeg_canon: DataFrame, edf_canon: DataFrame, gaps: DataFrame, tolerance: float) -> DataFrame:
    """recording_id, position, eeg_source, eeg_destination, edf_source, edf_destination, eeg_chunk, edf_chunk, interval_number of all trusted pairs.

    eeg, edf: edges; eeg_canon, edf_canon: the cycles' edges; gaps: recording_id, start, end of excluded interruptions, as event indexes.
    """
    runs = spans(judged(history, eeg, edf, eeg_canon, edf_canon, gaps, tolerance)).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    rows = runs.select("recording_id", "position", "eeg_chunk", "edf_chunk", (F.col("eeg_from") + F.col("k")).alias("eeg_number"), (F.col("edf_from") + F.col("k")).alias("edf_number"), (F.col("number_from") + F.col("k")).alias("known"), "whole")
    side = lambda name, edges: edges.select("recording_id", F.col("chunk_index").cast("int").alias(f"{name}_chunk"), F.col("interval_number").alias(f"{name}_number"), F.col("source_event_index").alias(f"{name}_source"), F.col("destination_event_index").alias(f"{name}_destination"), *(F.col(c).alias(f"{name}_{c}") for c in EDGE[1:]))
    met = computed(rows.join(side("eeg", eeg), ["recording_id", "eeg_chunk", "eeg_number"]).join(side("edf", edf), ["recording_id", "edf_chunk", "edf_number"]))
    last = F.max("interval_number").over(Window.partitionBy("recording_id"))
    open_ = met.where("known is null").select("recording_id", "position", "whole", F.col("eeg_number").alias("interval_number"), *(F.col(f"eeg_{c}").alias(c) for c in EDGE[1:]))
    # The whole cycle, and the cycle without its last interval.
    cycles = eeg_canon.withColumn("_last", last).withColumn("whole", F.explode(F.when(F.col("interval_number") < F.col("_last"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
    numbers = canonical_numbers(open_, cycles, ["recording_id", "position", "whole"], ["recording_id", "whole"], tolerance).drop("whole")
    told = met.join(numbers.withColumnRenamed("interval_number", "eeg_number"), ["recording_id", "position", "eeg_number"], "left")
    pairs = told.select("recording_id", "position", "eeg_source", "eeg_destination", "edf_source", "edf_destination", "eeg_chunk", "edf_chunk", F.coalesce("known", "canonical_number").alias("interval_number"))
    return excluded(pairs, gaps, "eeg_source")
