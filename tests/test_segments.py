"""Segments of paired schedules, with their known bounds."""

import numpy as np
import pytest

from lockstep.errors import AlignmentError
from lockstep.operators.matcher import Gap, match
from lockstep.operators.replay import canonical_numbers, extract
from test_matcher import FULL, LOSS, build, keep, without


def bounds(eeg, edf, change=None, gaps=None, **options):
    a, b = build("eeg", eeg, 500, 0), build("edf", edf, 128, 100)
    if change:
        change(a, b)
    rows = extract(match(a, b, gaps, **options), a, b)
    return [tuple(r[k] for k in ("start_eeg_chunk", "start_edf_chunk", "start_interval", "end_eeg_chunk", "end_edf_chunk", "end_interval")) for r in rows], rows


def test_whole():
    assert bounds(keep(5), keep(5))[0] == [(1, 1, 1, 5, 5, 49)]


def test_partial_start():
    assert bounds(keep(6), keep(6, c1=FULL[24:]), validations=0)[0] == [(1, 1, 25, 6, 6, 49)]


def test_short_losses():
    want = [(1, 1, 1, 2, 2, 10), (2, 2, 14, 5, 5, 49)]
    for a, b in ((LOSS, keep(5)), (keep(5), LOSS)):
        got = bounds(a, b)[0]
        assert [got[0], got[1]] == [(1, 1, 1, 2, 2, 10), got[1]] and got[1][3:] == want[1][3:] and len(got) == 2


def test_missing_boundary():
    got = bounds(keep(5, c3=FULL[6:]), keep(5))[0]
    assert got == [(1, 1, 1, 2, 2, 49), (2, 3, 7, 4, 5, 49)]


def test_terminal():
    got = bounds(keep(5, c4=without(12, 13), c5=FULL[:30]), keep(5, c5=FULL[:30]))[0]
    assert got[0] == (1, 1, 1, 4, 4, 10) and got[1][3:] == (5, 5, 29)


def test_excluded_interruption():
    def change(a, b):
        a.latency[70:] -= 500

    got, rows = bounds(keep(5), keep(5), change, [Gap(70, 71)])
    assert len(got) == 2 and got[0][3:] == (2, 2, 19) and got[1][:3] == (2, 2, 21)


def test_drift():
    def change(a, b):
        b.latency = np.round((b.latency - 1) * (1 + 50e-6)) + 1

    _, rows = bounds(LOSS, keep(5), change)
    assert len(rows) == 2 and all(r["clock_drift_r_squared"] > 0.98 and r["clock_drift_max_abs_residual_sec"] <= 2 / 128 for r in rows)


def test_step_is_not_linear():
    # Steps below the matching tolerance add up to more than a line can follow.
    def change(a, b):
        b.latency[150:] += 2
        b.latency[170:] += 2
        b.latency[190:] += 2
        b.latency[200:] += 2
        b.latency[210:] += 2

    with pytest.raises(AlignmentError, match="NonlinearClockDrift"):
        bounds(keep(5), keep(5), change)


def test_numbers_by_common_subsequence():
    e = lambda *s: [("63", "63", float(x), i, i + 1) for i, x in enumerate(s)]
    assert canonical_numbers(e(1, 3, 9, 5), e(1, 2, 3, 4, 5), 0.1) == [1, 3, None, 5]


def test_numbers_side_by_side():
    import numpy as np

    from lockstep.functions import lcs

    rng = np.random.default_rng(5)
    n, m = rng.integers(0, 12, 60), rng.integers(0, 12, 60)
    equal = rng.random((60, 12, 12)) < 0.3
    equal &= (np.arange(12) < n[:, None])[:, :, None] & (np.arange(12) < m[:, None])[:, None, :]
    got = lcs.walked(equal, n, m)
    for b in range(60):
        t = np.zeros((14, 14), int)
        for i in range(n[b] - 1, -1, -1):
            for j in range(m[b] - 1, -1, -1):
                t[i, j] = max(t[i, j + 1], t[i + 1, j + 1] + 1 if equal[b, i, j] else t[i + 1, j])
        want, i, j = [-1] * 12, 0, 0
        while i < n[b] and j < m[b]:
            if equal[b, i, j]:
                want[i] = j
                i, j = i + 1, j + 1
            elif t[i + 1, j] >= t[i, j + 1]:
                i += 1
            else:
                j += 1
        assert got[b].tolist() == want


def test_long_chunks_are_numbered_soon(spark):
    import time

    from lockstep.operators import pairing

    edge = ("id + 1 AS interval_number", "cast(id % 7 AS string) AS source_type", "'63' AS destination_type", "cast(1 AS double) AS interval_sec")
    observed = spark.range(2000).selectExpr("1L AS recording_id", "1 AS chunk_index", *edge)
    began = time.monotonic()
    rows = pairing.canonical_numbers(observed, observed.drop("chunk_index"), ["recording_id", "chunk_index"], ["recording_id"], 0.1).collect()
    assert sorted((r.interval_number, r.canonical_number) for r in rows) == [(k, k) for k in range(1, 2001)]
    assert time.monotonic() - began < 20


def test_covered_and_excluded_part_the_edges(spark):
    from lockstep.operators import pairing, segments

    edges = spark.range(40).selectExpr("id div 10 AS recording_id", "cast(id % 10 div 5 AS int) AS chunk_index", "id % 10 AS source_event_index")
    gaps = spark.createDataFrame([(0, None, None), (1, None, 3), (2, 7, None), (2, 8, 9)], "recording_id long, start long, end long")
    out = segments.covered(edges, gaps)
    assert out.count() == 10 + 3 + 3 and segments.excluded(edges, gaps).count() == 24
    assert sorted(map(tuple, pairing.covered_chunks(edges, gaps).collect())) == [(0, 0), (0, 1), (1, 0), (2, 1)]
