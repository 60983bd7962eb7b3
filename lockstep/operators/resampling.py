"""Filtering and resampling of segments by blocks of samples, and grids as expressions.

No task holds more than a block and its halo. The recursive high-pass is run over blocks side by side: each tells how it maps the
state before it to the state after it, a fold over these summaries finds all states, and the blocks are run from theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..errors import require
from ..functions import cascade, dsp


def grid(bounds: DataFrame, trigger_rate: float, ratio: int) -> DataFrame:
    """Effective input rate, output step and number of outputs of each segment.

    bounds: recording_id, segment_index, eeg_start_sample, eeg_end_sample, edf_start_sample, edf_end_sample.
    """
    span = F.col("edf_end_sample") - F.col("edf_start_sample")
    eeg = F.col("eeg_end_sample") - F.col("eeg_start_sample")
    return bounds.select("recording_id", "segment_index", (eeg / (span / trigger_rate)).alias("effective_rate"), (eeg / (span * ratio)).alias("step"), (span * ratio + 1).cast("long").alias("output_count"))


def reflected(index: Column, n: Column | int) -> Column:
    """One-based index folded into [1, n]."""
    n = F.lit(n) if isinstance(n, int) else n
    period = 2 * (n - 1)
    folded = F.pmod(index - 1, F.when(n > 1, period).otherwise(1))
    return F.when(folded >= n, period - folded).otherwise(folded) + 1


def sinc(x: Column) -> Column:
    return F.when(x == 0, F.lit(1.0)).otherwise(F.sin(F.lit(np.pi) * x) / (F.lit(np.pi) * x))


#: I0(x) as a sum of squares; 40 terms are exact to double precision for the shapes in use.
I0_TERMS = 40


def kernel_weight(distance: Column, offset: Column, plan: tuple[int, float, float]) -> Column:
    """The kernel's weight, before it is scaled to a sum of one, of a sample offset from the nearest one and distance from the point."""
    order, beta, cutoff = plan
    x = beta * F.sqrt(F.greatest(F.lit(0.0), 1 - F.pow(offset / (order / 2), 2)))
    step = lambda a, k: F.struct((a["term"] * F.pow(x / 2 / k, 2)).alias("term"), (a["sum"] + a["term"] * F.pow(x / 2 / k, 2)).alias("sum"))
    i0 = F.aggregate(F.sequence(F.lit(1), F.lit(I0_TERMS)), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), step, lambda a: a["sum"])
    return cutoff * sinc(cutoff * distance) * i0


def phase_weights(session: SparkSession, up: int, down: int, plan: tuple[int, float, float]) -> DataFrame:
    """(phase, ahead, weights) for outputs at every down / up samples: up rows, whatever is resampled with them.

    Output k has phase k % up; its nearest sample is ahead of the (k div up) * down-th; the weights are those of the samples around that.
    """
    half = plan[0] // 2
    taps = session.range(up * (2 * half + 1)).select(F.expr(f"cast(id div {2 * half + 1} AS INT)").alias("phase"), (F.col("id") % (2 * half + 1) - half).alias("t"))
    at = F.col("phase") * down / up
    taps = taps.withColumn("ahead", F.floor(at + 0.5)).withColumn("w", kernel_weight(at - F.col("ahead") - F.col("t"), F.col("t"), plan))
    rows = taps.groupBy("phase", "ahead").agg(F.sum("w").alias("total"), F.sort_array(F.collect_list(F.struct("t", "w"))).alias("taps"))
    return rows.select("phase", "ahead", F.transform("taps", lambda x: x["w"] / F.col("total")).alias("weights"))


def resample_rational(samples: DataFrame, up: int, down: int, plan: tuple[int, float, float], block: int = 1 << 10) -> DataFrame:
    """All outputs at every down / up samples: recording_id, k (from 0), value. samples: recording_id, source (from 1, without gaps), value.

    Blocks of samples with a halo meet the weights of each phase, which are few rows at any size of the input; taps are never rows.
    """
    half = plan[0] // 2
    require(block > 2 * half, "resample_eeg_segments:InvalidBlockSize", str(block))
    at = samples.withColumn("i", F.col("source") - 1)
    body = F.transform(F.sort_array(F.collect_list(F.struct("i", "value"))), lambda x: x["value"])
    blocks = at.groupBy("recording_id", F.expr(f"i div {block}").alias("block")).agg(body.alias("body"))
    part = lambda to, side, values: F.struct(to.alias("to"), F.lit(side).alias("side"), values.alias("part"))
    size = F.size("body")
    parts = F.array(part(F.col("block"), 0, F.col("body")), part(F.col("block") + 1, -1, F.slice("body", F.greatest(size - half + 1, F.lit(1)), half)), part(F.col("block") - 1, 1, F.slice("body", 1, half)))
    side = lambda k: F.coalesce(F.first(F.when(F.col("side") == k, F.col("part")), True), F.array().cast("array<double>"))
    met = blocks.select("recording_id", F.inline(parts)).groupBy("recording_id", F.col("to").alias("block")).agg(side(-1).alias("left"), side(0).alias("body"), side(1).alias("right")).where(size > 0)
    n = blocks.groupBy("recording_id").agg(F.sum(size).alias("n"))
    low = F.col("block") * block
    known = F.concat("left", "body", "right")
    first = low - F.size("left")
    around = met.join(n, "recording_id").select("recording_id", "n", low.alias("low"), (low + size).alias("past"), known.alias("known"), first.alias("first"))
    folded = F.transform(F.sequence(F.col("low") - half, F.col("past") - 1 + half), lambda i: F.element_at("known", (reflected(i + 1, F.col("n")) - F.col("first")).cast("int")))
    least = F.greatest(F.ceil((F.col("low") - 0.5) * up / down), F.lit(0))
    most = F.least(F.ceil((F.col("past") - 0.5) * up / down) - 1, F.floor((F.col("n") - 1) * up / down))
    ready = around.select("recording_id", "low", folded.alias("x"), least.alias("least"), most.alias("most")).where("least <= most")
    phases = ready.withColumn("phase", F.explode(F.sequence(F.lit(0), F.lit(up - 1)))).withColumn("from", F.col("least") + F.pmod(F.col("phase") - F.col("least"), F.lit(up))).where("from <= most")
    told = phases.join(F.broadcast(phase_weights(samples.sparkSession, up, down, plan)), "phase")
    start = lambda k: ((k - F.col("phase")) / up * down + F.col("ahead") - F.col("low") + 1).cast("int")
    value = lambda k: F.aggregate(F.zip_with(F.slice("x", start(k), 2 * half + 1), "weights", lambda a, w: a * w), F.lit(0.0), lambda a, v: a + v)
    outputs = F.transform(F.sequence("from", "most", F.lit(up).cast("long")), lambda k: F.struct(k.alias("k"), value(k).alias("value")))
    return told.select("recording_id", F.inline(outputs))


#: Samples of a channel's segment that are filtered and resampled together.
BLOCK = 1 << 15
CHANNEL = ["recording_id", "segment_index", "channel"]


def length_problems(samples: DataFrame, segments: DataFrame, channels: int | None = None) -> DataFrame:
    """Segments whose samples do not fit their bounds: recording_id, segment_index, error.

    channels: how many each segment has to have.
    """
    n = samples.groupBy(*CHANNEL).agg(F.count("*").alias("n")).groupBy("recording_id", "segment_index").agg(F.count("*").alias("channels"), F.min("n").alias("least"), F.max("n").alias("most"))
    need, span = F.col("eeg_end_sample") - F.col("eeg_start_sample") + 1, F.col("edf_end_sample") - F.col("edf_start_sample")
    wrong = (
        F.when(F.col("channels").isNull(), "SegmentCountMismatch")
        .when(F.lit(channels is not None) & (F.col("channels") != F.lit(channels)), "ChannelCountMismatch")
        .when((F.col("least") != need) | (F.col("most") != need) | (need < 2), "UnexpectedEegSegmentLength")
        .when(span < 1, "NonintegerTargetSampleSpan")
    )
    told = segments.join(n, ["recording_id", "segment_index"], "left").select("recording_id", "segment_index", F.concat(F.lit("resample_eeg_segments:"), wrong).alias("error"))
    return told.where("error is not null")


def blocked(samples: DataFrame, segments: DataFrame, block: int = BLOCK) -> DataFrame:
    """Channels' segments by blocks: recording_id, segment_index, channel, block, eeg, span, body. eeg and span are the segment's sample spans."""
    told = segments.select("recording_id", "segment_index", F.col("eeg_start_sample").alias("start"), (F.col("eeg_end_sample") - F.col("eeg_start_sample")).alias("eeg"), (F.col("edf_end_sample") - F.col("edf_start_sample")).alias("span"))
    at = samples.join(told, ["recording_id", "segment_index"]).withColumn("i", F.col("sample") - F.col("start")).where("i between 0 and eeg and eeg > 0 and span > 0")
    body = F.transform(F.sort_array(F.collect_list(F.struct("i", F.col("value").cast("double").alias("value")))), lambda x: x["value"])
    return at.groupBy(*CHANNEL, F.floor(F.col("i") / block).cast("long").alias("block")).agg(F.first("eeg").cast("long").alias("eeg"), F.first("span").cast("long").alias("span"), body.alias("body"))


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in CHANNEL) + ", " + more


#: Bytes of blocks that a task turns into a frame at a time.
PART = 4 << 20


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Frames of PART bytes or so, or one row: Spark's batches are counted in rows, and a row may hold a whole block."""
    for batch in batches:
        rows = max(1, PART * batch.num_rows // max(1, batch.nbytes))
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows).to_pandas()


def _mapped(blocks: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """mapInPandas by ``_parts``."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches):
        for pdf in run(_parts(batches)):
            yield pa.RecordBatch.from_pandas(pdf, target, preserve_index=False)

    return blocks.mapInArrow(each, schema)


def _summaries(trigger_rate: float, block: int):
    """A row for each block, and for what the odd extension at the segment's ends mirrors of it. part: its order in the extended segment."""

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                x, n, rate = np.asarray(r.body, float), r.eeg + 1, r.eeg / (r.span / trigger_rate)
                pad, low, count = cascade.padding(n, rate), r.block * block, -(-n // block)
                own = np.arange(low, low + len(x))
                parts = [(r.block, 1.0, x), (-1 - r.block, -1.0, x[(own >= 1) & (own <= pad)][::-1]), (2 * count - 1 - r.block, -1.0, x[(own >= n - 1 - pad) & (own <= n - 2)][::-1])]
                for part, sign, values in parts:
                    if len(values):
                        middle = values.mean()
                        after, back, last = cascade.highpass(rate).summary(values - middle)
                        rows.append((*(getattr(r, c) for c in CHANNEL), part, r.eeg, r.span, sign, middle, len(values), values[0], values[-1], values.sum(), after, back, last))
            yield pd.DataFrame(rows, columns=[*CHANNEL, "part", "eeg", "span", "sign", "middle", "length", "head", "tail", "total", "after", "back", "final"])

    return run


def _states(trigger_rate: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        own = pdf[pdf.sign > 0]
        n = int(own.length.sum())
        first = pdf.iloc[0]
        if n != first.eeg + 1:  # length_problems names the segment
            return pd.DataFrame(columns=[*CHANNEL, "block", "mean", "forward", "backward"])
        mean = own.total.sum() / n
        filter_ = cascade.highpass(first.eeg / (first.span / trigger_rate))
        edge = np.where(pdf.sign > 0, 0.0, np.where(pdf.part < 0, 2 * own["head"].iloc[0], 2 * own["tail"].iloc[-1])) - mean
        level = pdf.sign * pdf.middle + edge  # a part is sign (x - middle) + level
        told = [[s * a + l * filter_.level(k)[j] for s, a, l, k in zip(pdf.sign, pdf[c], level, pdf.length)] for j, c in enumerate(("after", "back", "final"))]
        forward, backward = filter_.states(first.sign * first["head"] + edge[0], pdf.length.tolist(), *told)
        out = pdf[CHANNEL].assign(block=pdf.part, mean=mean, forward=forward, backward=backward)
        return out[pdf.sign > 0]

    return run


def highpassed(blocks: DataFrame, trigger_rate: float, block: int = BLOCK) -> DataFrame:
    """The blocks of segments without their mean, after the zero-phase high-pass; segments that lack samples drop out."""
    summary = "part long, eeg long, span long, sign double, middle double, length long, head double, tail double, total double, after array<double>, back array<double>, final double"
    summaries = _mapped(blocks, _summaries(trigger_rate, block), _schema(blocks, summary))
    states = summaries.groupBy(*CHANNEL).applyInPandas(_states(trigger_rate), _schema(blocks, "block long, mean double, forward array<double>, backward array<double>"))

    def run(batches):
        for pdf in batches:
            y = [cascade.highpass(r.eeg / (r.span / trigger_rate)).both(np.asarray(r.body, float) - r.mean, np.asarray(r.forward), np.asarray(r.backward)) for r in pdf.itertuples(index=False)]
            yield pdf[[*CHANNEL, "block", "eeg", "span"]].assign(body=y)

    return _mapped(blocks.join(states, [*CHANNEL, "block"]), run, _schema(blocks, "block long, eeg long, span long, body array<double>"))


def centred(blocks: DataFrame) -> DataFrame:
    """The blocks of segments without their mean."""
    mean = blocks.groupBy(*CHANNEL).agg((F.sum(F.aggregate("body", F.lit(0.0), lambda a, x: a + x)) / F.sum(F.size("body"))).alias("mean"), F.sum(F.size("body")).alias("n"))
    told = blocks.join(mean, CHANNEL).where("n = eeg + 1")
    return told.select(*CHANNEL, "block", "eeg", "span", F.transform("body", lambda x: x - F.col("mean")).alias("body"))


def with_halo(blocks: DataFrame, halo: int) -> DataFrame:
    """Blocks with the samples of their neighbours next to them: left, body and right."""
    part = lambda to, side, body: F.struct(to.alias("to"), F.lit(side).alias("side"), body.alias("part"))
    tail = F.slice("body", F.greatest(F.size("body") - halo + 1, F.lit(1)), halo)
    parts = F.array(part(F.col("block"), 0, F.col("body")), part(F.col("block") + 1, -1, tail), part(F.col("block") - 1, 1, F.slice("body", 1, halo)))
    sent = blocks.select(*CHANNEL, "eeg", "span", F.inline(parts))
    side = lambda k: F.first(F.when(F.col("side") == k, F.col("part")), True)
    none = F.array().cast("array<double>")
    met = sent.groupBy(*CHANNEL, F.col("to").alias("block")).agg(F.first("eeg").alias("eeg"), F.first("span").alias("span"), F.coalesce(side(-1), none).alias("left"), side(0).alias("body"), F.coalesce(side(1), none).alias("right"))
    return met.where("body is not null")


def _weighted(trigger_rate: float, ratio: int, block: int, native: bool):
    """Outputs whose nearest input lies in a block, on the output grid or on the input's own."""

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                x = np.concatenate([r.left, r.body, r.right])
                n, low, rate = r.eeg + 1, r.block * block, r.eeg / (r.span / trigger_rate)
                order, beta, cutoff = dsp.kaiser_plan(rate)
                taps = np.arange(-(order // 2), order // 2 + 1)
                step, count = (1.0, n) if native else (r.eeg / (r.span * ratio), r.span * ratio + 1)
                k = np.arange(max(0, int((low - 1) / step) - 1), min(count, int((low + len(r.body)) / step) + 2))
                centre = np.minimum(np.floor(k * step + 0.5), n - 1)
                k = k[(centre >= low) & (centre < low + len(r.body))]
                for a in range(0, len(k), dsp.BLOCK):
                    some = k[a : a + dsp.BLOCK]
                    position = some * step
                    centre = np.minimum(np.floor(position + 0.5), n - 1)
                    w = dsp.kernel(taps, order, beta, cutoff, (position - centre)[:, None])
                    at = dsp.reflect((centre[:, None] + taps).astype(np.int64), n) - (low - len(r.left))
                    value = np.einsum("kt,kt->k", x[at], w)
                    yield pd.DataFrame({c: getattr(r, c) for c in CHANNEL} | {"sample": some + 1, "value": value})

    return run


def _halo(trigger_rate: float, block: int) -> int:
    """Samples that the longest kernel in use needs beside a block."""
    halo = 512
    require(block > 2 * halo, "resample_eeg_segments:InvalidBlockSize", str(block))
    return halo


def resample_blocks(samples: DataFrame, segments: DataFrame, trigger_rate: float, ratio: int, filtered: bool = True, block: int = BLOCK) -> DataFrame:
    """Segments on the output grid: recording_id, segment_index, channel, sample (from 1), value.

    samples: recording_id, segment_index, channel, sample, value. Segments that ``length_problems`` names give no rows.
    """
    blocks = blocked(samples, segments, block)
    ready = highpassed(blocks, trigger_rate, block) if filtered else centred(blocks)
    return _mapped(with_halo(ready, _halo(trigger_rate, block)), _weighted(trigger_rate, ratio, block, False), _schema(samples, "sample long, value double"))


def antialiased(samples: DataFrame, segments: DataFrame, trigger_rate: float, filtered: bool = True, block: int = BLOCK) -> DataFrame:
    """Segments after the resampler's kernel on their own grid, to tell what resampling alone changes: recording_id, segment_index, channel, sample (from 1), value."""
    blocks = blocked(samples, segments, block)
    ready = highpassed(blocks, trigger_rate, block) if filtered else centred(blocks)
    return _mapped(with_halo(ready, _halo(trigger_rate, block)), _weighted(trigger_rate, 1, block, True), _schema(samples, "sample long, value double"))


def spectra(samples: DataFrame, rate: float, kind: str = "welch") -> DataFrame:
    """Spectrum of each channel: frequency and dB, with the time of the window for multitaper."""

    def run(keys: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("sample")["value"].to_numpy(float)
        if kind == "welch":
            f, db = dsp.welch(x, rate)
            return pd.DataFrame({"recording_id": keys[0], "channel": keys[1], "time_sec": 0.0, "frequency": f, "db": db})
        t, f, db = dsp.multitaper(x, rate)
        return pd.DataFrame({"recording_id": keys[0], "channel": keys[1], "time_sec": np.repeat(t, len(f)), "frequency": np.tile(f, len(t)), "db": db.ravel()})

    kind_of = samples.schema["recording_id"].dataType.simpleString()
    return samples.groupBy("recording_id", "channel").applyInPandas(run, f"recording_id {kind_of}, channel string, time_sec double, frequency double, db double")
