"""From a pairing's history to matched intervals, trusted segments, and their clock drift.

Works on one recording at a time (thousands of intervals); ``segment_recordings`` runs it for all recordings.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..errors import AlignmentError, require
from .matcher import Result, Side, ends, match_group, prefix, same_one, with_marks

COLUMNS = "segment_index int, eeg_duration_sec double, edf_duration_sec double, edf_minus_eeg_sec double, clock_drift_r_squared double, clock_drift_max_abs_residual_sec double, start_eeg_chunk int, start_edf_chunk int, start_interval int, end_eeg_chunk int, end_edf_chunk int, end_interval int, eeg_start_sample long, eeg_end_sample long, edf_start_sample long, edf_end_sample long"


def canonical_numbers(observed, canon, tolerance: float) -> list[int | None]:
    """Interval numbers of observed edges by their longest common subsequence with the cycle; None where unassigned."""
    n, m = len(observed), len(canon)
    best = np.zeros((n + 1, m + 1), int)
    equal = [[same_one(x, y, tolerance) for y in canon] for x in observed]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i, j] = best[i + 1, j + 1] + 1 if equal[i][j] else max(best[i + 1, j], best[i, j + 1])
    out: list[int | None] = [None] * n
    i = j = 0
    while i < n and j < m:
        if equal[i][j]:
            out[i] = j + 1
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def _pair(xs, ys, numbers, i, j):
    return [(x[3], x[4], y[3], y[4], i, j, k) for x, y, k in zip(xs, ys, numbers)]


def pairs(r: Result, eeg: Side, edf: Side, tolerance: float) -> list[tuple]:
    """(EEG source, destination, EDF source, destination, EEG chunk, EDF chunk, interval number), in order of the history.

    An open loss (no later edges of its chunk are known) unlocks; until the next match, other rows are not trusted.
    """
    out, locked = [], True
    canon = eeg.canon_edges()
    gaps = [g for g in r.gaps if g.excluded]
    for h in r.history:
        i, j, what = h["eeg_chunk_index"], h["edf_chunk_index"], h["outcome"]
        a, b = eeg.chunks[i - 1], edf.chunks[j - 1]
        xs, ys = eeg.edges(a), edf.edges(b)
        if what == "match":
            locked = True
            out += _pair(xs, ys, range(1, len(xs) + 1), i, j)
        elif what == "partial_start_match":
            require(a.start <= r.eeg_anchor <= a.end, "extract_segments:InvalidPartialStartAnchor")
            xs = xs[r.eeg_anchor - a.start :]
            require(len(xs) == len(ys), "extract_segments:InvalidPartialStartPairing")
            out += _pair(xs, ys, range(r.partial_interval, r.partial_interval + len(xs)), i, j)
        elif what == "shared_trigger_glitch":
            if locked:
                out += _pair(xs, ys, canonical_numbers(xs, canon, tolerance), i, j)
        elif what in ("eeg_data_loss", "edf_data_loss"):
            if not locked:
                continue
            n = min(len(xs), len(ys))
            if [x[:2] for x in xs] == [y[:2] for y in ys] and any(covered(x[3], gaps) for x in xs):
                out += _pair(xs, ys, range(1, n + 1), i, j)
                continue
            own, clean = (xs, ys) if what == "eeg_data_loss" else (ys, xs)
            side, other = (eeg, edf) if what == "eeg_data_loss" else (edf, eeg)
            after = h["next_edf_chunk_index"] if side is eeg else h["next_eeg_chunk_index"]
            p = prefix(own, clean, tolerance)
            k = (j if side is eeg else i) if after is None else after - 1
            tail = clean if k == (j if side is eeg else i) else other.edges(other.chunks[k - 1]) if k <= len(other.chunks) else []
            s = ends(own, tail, tolerance)[1] if tail is clean else min(prefix(own[::-1], tail[::-1], tolerance), len(own) - p)
            if after is None:
                s = 0
            lead = (own[:p], clean[:p])
            out += _pair(*(lead if side is eeg else lead[::-1]), range(1, p + 1), i, j)
            if s:
                rest = (own[len(own) - s :], tail[len(tail) - s :])
                numbers = range(len(tail) - s + 1, len(tail) + 1)
                out += _pair(*(rest if side is eeg else rest[::-1]), numbers, *((i, k) if side is eeg else (k, j)))
            else:
                locked = False
        elif what == "both_systems_unusable":
            if locked:
                p = min(prefix(xs, ys, tolerance), prefix(xs, canon, tolerance))
                out += _pair(xs[:p], ys[:p], range(1, p + 1), i, j)
        elif what in ("eeg_shorter", "eeg_longer", "same_last_trigger"):
            if locked:
                n = r.terminal_common - 1
                xs = [(eeg.types[e - 1], eeg.types[e], eeg.time(e + 1) - eeg.time(e), e, e + 1) for e in range(a.start, a.start + n)]
                ys = [(edf.types[e - 1], edf.types[e], edf.time(e + 1) - edf.time(e), e, e + 1) for e in range(b.start, b.start + n)]
                out += _pair(xs, ys, canonical_numbers(xs, canon[:-1], tolerance), i, j)
        else:
            raise AlignmentError("extract_segments:UnknownOutcome", what)
    return out


def covered(source: int, gaps) -> bool:
    for g in gaps:
        if g.start is None and g.end is None:
            return True
        if g.start is None:
            hit = source < g.end
        elif g.end is None:
            hit = source >= g.start
        elif g.end > g.start:
            hit = g.start <= source < g.end
        else:
            hit = source == g.start
        if hit:
            return True
    return False


def drift_fit(x: np.ndarray, y: np.ndarray) -> tuple[float | None, float]:
    """R squared (None below three points) and largest residual of a line through drift y over elapsed x."""
    if len(x) < 2:
        return None, 0.0
    slope, intercept = np.polyfit(x, y, 1)
    res = y - slope * x - intercept
    worst = float(np.abs(res).max())
    if len(x) < 3:
        return None, worst
    total, left, floor = float(((y - y.mean()) ** 2).sum()), float((res**2).sum()), len(x) * (10 * 2.0**-52) ** 2
    return (float(left <= floor) if total <= floor else 1 - left / total), worst


def extract(r: Result, eeg: Side, edf: Side) -> list[dict]:
    """Trusted segments: contiguous runs of matched intervals that no excluded interruption covers."""
    tolerance = 2 / min(eeg.rate, edf.rate)
    kept = [p for p in pairs(r, eeg, edf, tolerance) if not covered(p[0], [g for g in r.gaps if g.excluded])]
    require(bool(kept), "extract_segments:NoMatchedIntervals")
    runs: list[list[tuple]] = []
    for p in kept:
        if runs and runs[-1][-1][1] == p[0] and runs[-1][-1][3] == p[2]:
            runs[-1].append(p)
        else:
            runs.append([p])
    out = []
    for k, run in enumerate(runs):
        a, z = run[0], run[-1]
        e = np.array([eeg.time(p[0]) for p in run] + [eeg.time(z[1])])
        f = np.array([edf.time(p[2]) for p in run] + [edf.time(z[3])])
        x = e - e[0]
        r2, worst = drift_fit(x, f - f[0] - x)
        require(worst <= tolerance, "extract_segments:NonlinearClockDrift", f"segment {k + 1}: {worst:.6f} s")
        at = lambda side, event: int(side.latency[event - 1])
        out.append({
            "segment_index": k + 1, "eeg_duration_sec": float(x[-1]), "edf_duration_sec": float(f[-1] - f[0]), "edf_minus_eeg_sec": float(f[-1] - f[0] - x[-1]),
            "clock_drift_r_squared": r2, "clock_drift_max_abs_residual_sec": worst, "start_eeg_chunk": a[4], "start_edf_chunk": a[5], "start_interval": a[6],
            "end_eeg_chunk": z[4], "end_edf_chunk": z[5], "end_interval": z[6], "eeg_start_sample": at(eeg, a[0]), "eeg_end_sample": at(eeg, z[1]), "edf_start_sample": at(edf, a[2]), "edf_end_sample": at(edf, z[3]),
        })
    return out


def segment_recordings(eeg: DataFrame, edf: DataFrame, eeg_rate: float, edf_rate: float, interruptions: DataFrame | None = None, startup: DataFrame | None = None) -> DataFrame:
    """Trusted segments of every recording; a recording that violates a contract gives one row with its identifier as error.

    interruptions and startup are those of ``matcher.with_marks``.
    """
    names = [x.split()[0] for x in COLUMNS.split(", ")]

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        try:
            rows = extract(*match_group(a, b, eeg_rate, edf_rate))
        except AlignmentError as x:
            rows = [{"error": x.identifier}]
        whole = [x.split()[0] for x in COLUMNS.split(", ") if not x.endswith("double")]
        out = pd.DataFrame([{"recording_id": key[0], "error": None, **r} for r in rows], columns=["recording_id", *names, "error"])
        return out.astype({**{n: "float64" for n in names if n not in whole}, **{n: "Int64" for n in whole}, "error": "object"})

    return with_marks(eeg, interruptions, startup).groupBy("recording_id").cogroup(edf.groupBy("recording_id")).applyInPandas(run, f"recording_id long, {COLUMNS}, error string")
