"""Pulse detection on a trace that still arrives.

State per recording is the pulse that is open: its start, last sample and largest value. A pulse is emitted
when a sample at or below the threshold, or a missing one, ends it. Samples of a recording are expected in order of arrival of their
batches; within a batch they are sorted. With ``timeout_ms``, a recording that stays silent for so long has its open pulse emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "recording_id long, latency long, end long, max_value double"
STATE = "latency long, end long, max_value double"


def advance(rows: pd.DataFrame, open_: tuple | None, threshold: float) -> tuple[list[tuple], tuple | None]:
    """Closed pulses (start, end, largest value), and the pulse that stays open."""
    done = []
    rows = rows.sort_values("sample")
    for sample, volts in zip(rows["sample"].tolist(), rows["volts"].tolist()):
        if open_ is not None and (volts <= threshold or sample != open_[1] + 1):
            done.append(open_)
            open_ = None
        if volts > threshold:
            open_ = (sample, sample, volts) if open_ is None else (open_[0], sample, max(open_[2], volts))
    return done, open_


def stream_pulses(trace: DataFrame, threshold: float = 1.0, timeout_ms: int | None = None) -> DataFrame:
    """recording_id, latency, end, max_value of pulses of a streaming trace (recording_id, sample, volts)."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_ = tuple(state.get) if state.exists else None
        if state.hasTimedOut:
            done, open_ = ([open_] if open_ else []), None
        else:
            done, open_ = advance(pd.concat(list(batches)), open_, threshold)
        if open_ is None:
            if state.exists:
                state.remove()
        else:
            state.update(open_)
            if timeout_ms:
                state.setTimeoutDuration(timeout_ms)
        if done:
            yield pd.DataFrame([(key[0], *d) for d in done], columns=["recording_id", "latency", "end", "max_value"])

    return trace.groupBy("recording_id").applyInPandasWithState(update, OUTPUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout)
