"""Pairing of two recordings' trigger chunks: a two-cursor scan over chunk reports, one recording at a time.

The inputs (tens of chunks per recording) come from the cycle operators; the scan itself is sequential and runs as
a cogrouped function, one group per recording. ``match`` is the function over plain arrays.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import AlignmentError, require
from ..functions.tolerance import near, near_each

CYCLE = 50


@dataclass
class Chunk:
    start: int  # one-based event index
    end: int
    status: str
    reason: str
    bounded: bool
    cycles: float  # estimated, nan if unbounded


@dataclass
class Side:
    """One system: triggers in order, rate, chunks and canonical cycle, filled by ``prepare``."""

    name: str
    latency: np.ndarray
    types: list[str]
    rate: float
    chunks: list[Chunk] = field(default_factory=list)
    canon_types: list[str] = field(default_factory=list)
    canon_gaps: list[float] = field(default_factory=list)
    first: int = 1

    def time(self, event: int) -> float:
        return (self.latency[event - 1] - 1) / self.rate

    def edges(self, chunk: Chunk, closed: bool = True) -> list[tuple[str, str, float, int, int]]:
        """(source type, destination type, seconds, source, destination); closed adds the edge to the next chunk."""
        last = chunk.end if closed and chunk.bounded else chunk.end - 1
        return [(self.types[i - 1], self.types[i], self.time(i + 1) - self.time(i), i, i + 1) for i in range(chunk.start, last + 1)]

    def canon_edges(self) -> list[tuple[str, str, float, int, int]]:
        n = len(self.canon_types)
        return [(self.canon_types[i], self.canon_types[(i + 1) % n], self.canon_gaps[i], i + 1, (i + 1) % n + 1) for i in range(n)]


def boundaries(types: list[str]) -> list[int]:
    """Zero-based starts of runs of exactly four 64."""
    out, i = [], 0
    while i < len(types):
        j = i
        while j < len(types) and types[j] == "64":
            j += 1
        if j - i == 4:
            out.append(i)
        i = max(j, i + 1)
    return out


def prepare(side: Side, tolerance: float, start: int = 1) -> None:
    """Consensus cycle and chunk report of the events from start (one-based) on."""
    types, times = side.types[start - 1 :], (side.latency[start - 1 :] - 1) / side.rate
    marks = boundaries(types)
    require(bool(marks), "extract_canonical_cycle:NoBoundary", side.name)
    spans = ([(0, marks[0])] if marks[0] else []) + list(zip(marks, [*marks[1:], len(types)]))
    partial = bool(marks[0])
    shapes = {}
    for k, (a, b) in enumerate(spans):
        if (k or not partial) and b < len(types):
            shapes[k] = (tuple(types[a:b]), [float(x) for x in np.diff(times[a : b + 1])])
    agree = {k: [m for m in shapes if shapes[m][0] == shapes[k][0] and near(shapes[k][1], shapes[m][1], tolerance)] for k in shapes}
    most = max((len(v) for v in agree.values()), default=0)
    require(most >= 2, "extract_canonical_cycle:NoConsensus", side.name)
    top = [k for k in agree if len(agree[k]) == most]
    require(all(k in agree[top[0]] for k in top), "extract_canonical_cycle:AmbiguousCanonicalCycle", side.name)
    gaps = [float(np.median(x)) for x in zip(*(shapes[k][1] for k in agree[top[0]]))]
    side.canon_types, side.canon_gaps = list(shapes[top[0]][0]), gaps
    side.chunks, total = [], sum(gaps)
    for k, (a, b) in enumerate(spans):
        bounded = b < len(types)
        cycles = max(1, int((times[b] - times[a]) / total + 0.5)) if bounded else float("nan")
        own = [float(x) for x in np.diff(times[a : b + 1])]
        same = types[a:b] == side.canon_types
        if k == 0 and partial:
            status, reason = "partial_start", "before_first_boundary"
        elif not bounded:
            status, reason = "partial_end", "no_next_boundary"
        elif same and near(own, gaps, tolerance):
            status, reason = "match", "canonical_match"
        elif cycles > 1:
            status, reason = "ambiguous", "suspected_missing_boundary"
        else:
            status, reason = "mismatch", "interval_timing" if same else "trigger_count" if b - a != len(gaps) else "trigger_types"
        side.chunks.append(Chunk(a + start, b + start - 1, status, reason, bounded, cycles))
    side.first = start


def same(a, b, tolerance: float) -> bool:
    """Whether two edge lists have equal types and intervals."""
    return len(a) == len(b) and all(x[:2] == y[:2] for x, y in zip(a, b)) and near([x[2] for x in a], [y[2] for y in b], tolerance)


def same_one(a, b, tolerance: float) -> bool:
    return a[:2] == b[:2] and near_each(a[2], b[2], tolerance)


def prefix(a, b, tolerance: float) -> int:
    n = 0
    while n < min(len(a), len(b)) and same_one(a[n], b[n], tolerance):
        n += 1
    return n


def ends(observed, clean, tolerance: float) -> tuple[int, int]:
    """Matching leading and trailing edges; the trailing ones do not reach into the leading ones."""
    p = prefix(observed, clean, tolerance)
    s = prefix(observed[::-1], clean[::-1], tolerance)
    return p, max(0, min(s, len(observed) - p, len(clean) - p))


@dataclass
class Gap:
    """A marked interruption of the EEG: anchors as event indexes, None where open."""

    start: int | None
    end: int | None
    group: int = 0
    status: str = "unresolved"
    excluded: bool = False
    edf_start: int | None = None
    edf_end: int | None = None


@dataclass
class Result:
    status: str = "running"
    outcome: str = ""
    startup: str = "legacy_startup"
    initial_reason: str = ""
    eeg_anchor: int | None = None
    edf_anchor: int | None = None
    partial_interval: int | None = None
    partial_intervals: int = 0
    startup_prefix: int = 0
    startup_suffix: int = 0
    matched: int = 0
    initial_matched: int = 0
    problem: str | None = None
    requires_relock: bool = False
    terminal_relation: str | None = None
    terminal_eeg: int | None = None
    terminal_edf: int | None = None
    terminal_common: int | None = None
    zero_padding: bool | None = None
    history: list[dict] = field(default_factory=list)
    missing: list[dict] = field(default_factory=list)
    gaps: list[Gap] = field(default_factory=list)


class Scan:
    """The state of one pairing."""

    def __init__(self, eeg: Side, edf: Side, tolerance: float, gaps: list[Gap]):
        self.eeg, self.edf, self.tol = eeg, edf, tolerance
        self.r = Result(gaps=gaps)
        self._group(gaps)

    @staticmethod
    def _group(gaps: list[Gap]) -> None:
        inf = float("inf")
        latest, group = -inf, 0
        for g in sorted(gaps, key=lambda g: -inf if g.start is None else g.start):
            low = -inf if g.start is None else g.start
            high = inf if g.end is None else max(g.end, low + 1)
            if group == 0 or low > latest:
                group += 1
            latest = max(latest, high)
            g.group = group

    # Builders

    def log(self, i, j, outcome, resolution, after=(None, None)):
        name = lambda side, k: side.chunks[k].status if k is not None else None
        self.r.history.append({"eeg_chunk_index": None if i is None else i + 1, "edf_chunk_index": None if j is None else j + 1, "eeg_status": name(self.eeg, i), "edf_status": name(self.edf, j), "outcome": outcome, "resolution_status": resolution, "next_eeg_chunk_index": None if after[0] is None else after[0] + 1, "next_edf_chunk_index": None if after[1] is None else after[1] + 1})

    def lose(self, side: Side, i, j, start, end, reason):
        at = lambda e, f: None if e is None else f(e)
        self.r.missing.append({"system": side.name, "eeg_chunk_index": None if i is None else i + 1, "edf_chunk_index": None if j is None else j + 1, "start_event_index": start, "start_latency": at(start, lambda e: int(side.latency[e - 1])), "start_time_sec": at(start, side.time), "end_event_index": end, "end_latency": at(end, lambda e: int(side.latency[e - 1])), "end_time_sec": at(end, side.time), "reason": reason})

    def trouble(self, what: str):
        self.r.problem = self.r.problem or what

    def close_open(self, i, j):
        for m in self.r.missing:
            if m["end_event_index"] is None:
                side, k = (self.eeg, i) if m["system"] == "eeg" else (self.edf, j)
                e = side.chunks[k].start
                m.update(end_event_index=e, end_latency=int(side.latency[e - 1]), end_time_sec=side.time(e))

    def stop(self, status, outcome):
        self.r.status, self.r.outcome = status, outcome

    # Starting points

    def validate_cycles(self):
        a, b = self.eeg, self.edf
        for s in (a, b):
            require(len(s.canon_types) == CYCLE, "validate_canonical_cycles:UnexpectedTriggerCount", f"{s.name}: {len(s.canon_types)}")
        require(a.canon_types == b.canon_types, "validate_canonical_cycles:TriggerTypeMismatch")
        require(near(a.canon_gaps, b.canon_gaps, self.tol), "validate_canonical_cycles:IntervalMismatch")

    def partial_start(self) -> tuple[int, int]:
        """EDF begins inside a cycle: its leading 63 edges must fit one place of the cycle, and the EEG's first cycle there."""
        r, c = self.r, self.edf.chunks[0]
        require(c.status == "partial_start", "match_triggers:InvalidPartialStart")
        lead = self.edf.edges(c)
        require(all(t == "63" for t in self.edf.types[c.start - 1 : c.end]), "match_triggers:LateStartPrefixNotPure63")
        require(len(lead) >= 2, "match_triggers:LateStartInsufficientEvidence")
        canon = self.edf.canon_edges()
        at = [o for o in range(len(canon) - len(lead) + 1) if all(same_one(x, y, self.tol) for x, y in zip(lead, canon[o:]))]
        require(bool(at), "match_triggers:LateStartCanonicalMismatch")
        require(len(at) == 1, "match_triggers:LateStartAmbiguous")
        require(at[0] + len(lead) == len(canon), "match_triggers:LateStartNotCanonicalSuffix")
        first = self.eeg.chunks[0]
        require(first.status == "match", "match_triggers:LateStartEegFirstCycleMismatch")
        own = self.eeg.edges(first)
        there = [o for o in range(len(own) - len(lead) + 1) if all(same_one(x, y, self.tol) for x, y in zip(lead, own[o:]))]
        require(bool(there), "match_triggers:LateStartEegFirstCycleMismatch")
        require(len(there) == 1, "match_triggers:LateStartAmbiguous")
        require(there[0] == at[0], "match_triggers:LateStartPhaseDisagreement")
        r.startup, r.partial_interval, r.partial_intervals = "partial_cycle_late_start", at[0] + 1, len(lead)
        r.eeg_anchor, r.edf_anchor = first.start + at[0], c.start
        self.log(0, 0, "partial_start_match", "initial_canonical_suffix_match", (1, 1))
        return 1, 1

    def initial(self, i: int, j: int) -> tuple[int, int]:
        """Stay on the first EDF chunk, or go to the first later one that the EEG's first chunk fits."""
        r, a, b = self.r, self.eeg.chunks[i], self.edf.chunks[j]
        r.initial_reason = "first_chunks"
        if a.bounded and b.bounded and not same(self.eeg.edges(a), self.edf.edges(b), self.tol) and a.status == "match" and b.status != "match":
            own, canon = self.edf.edges(b), self.edf.canon_edges()
            if len(own) > len(canon) and b.reason == "suspected_missing_boundary" and b.cycles == 2:
                r.initial_reason = "edf_first_chunk_missing_boundary"
            elif len(own) < len(canon):
                p, s = ends(own, canon, self.tol)
                r.startup_prefix, r.startup_suffix = p, s
                if p and s:
                    r.initial_reason = "edf_first_chunk_bracketed_loss"
                else:
                    target = self.eeg.edges(a)
                    for k in range(j + 1, len(self.edf.chunks)):
                        c = self.edf.chunks[k]
                        if c.bounded and c.status == "match" and same(target, self.edf.edges(c), self.tol):
                            r.initial_reason, j = "edf_restart_at_t1_boundary", k
                            break
        r.eeg_anchor, r.edf_anchor = self.eeg.chunks[i].start, self.edf.chunks[j].start
        return i, j

    # Interruptions

    def groups(self, want) -> list[list[Gap]]:
        out: dict[int, list[Gap]] = {}
        for g in self.r.gaps:
            out.setdefault(g.group, []).append(g)
        return [v for v in out.values() if want(v)]

    @staticmethod
    def span(group: list[Gap]) -> tuple[int | None, int | None]:
        start = None if any(g.start is None for g in group) else min(g.start for g in group)
        end = None if any(g.end is None for g in group) else max(g.end for g in group)
        return start, end

    def settle(self, group, status, excluded=False, edf=(None, None)):
        for g in group:
            g.status, g.excluded, (g.edf_start, g.edf_end) = status, excluded, edf

    def leading(self):
        """An interruption open at the start: alignment begins after its reconnect."""
        found = self.groups(lambda g: any(x.start is None for x in g))
        require(len(found) <= 1, "match_triggers:MultipleLeadingAmplifierInterruptions")
        for group in found:
            end = max((g.end for g in group if g.end is not None), default=None)
            require(end is not None and end < len(self.eeg.types), "match_triggers:UnanchoredLeadingAmplifierInterruption")
            if end <= self.r.eeg_anchor:
                self.settle(group, "before_initial_alignment", True)
                continue
            c = next(c for c in self.eeg.chunks if c.start <= self.r.eeg_anchor <= c.end)
            d = next(d for d in self.edf.chunks if d.start <= self.r.edf_anchor <= d.end)
            require(end <= c.end, "match_triggers:AmplifierCycleCountAmbiguity")
            shift = self.r.edf_anchor - self.r.eeg_anchor
            there = end + shift
            # The first full interval after the reconnect decides, and no later one.
            mine, other = ({e[3]: e for e in side.edges(k)}.get(at) for side, k, at in ((self.eeg, c, end), (self.edf, d, there)))
            require(mine is not None and other is not None and same_one(mine, other, self.tol), "match_triggers:LeadingAmplifierRelockFailed")
            for g in group:
                g.status, g.excluded = "leading_relocked", True
                if g.end is not None and g.end > self.r.eeg_anchor:
                    g.edf_end = g.end + shift
            self.r.eeg_anchor, self.r.edf_anchor, self.r.initial_reason = end, there, "amplifier_reconnect"

    def skipped(self):
        """After a late start, interruptions before the anchor do not matter; one across it cannot be resolved."""
        for group in self.groups(lambda g: g[0].status == "unresolved"):
            start, end = self.span(group)
            if end is not None and end <= self.r.eeg_anchor:
                self.settle(group, "before_initial_alignment", True)
            elif start is None or start < self.r.eeg_anchor:
                raise AlignmentError("match_triggers:PartialStartAmplifierInterruption")

    def translate(self, event: int, i: int, j: int) -> int | None:
        """The EDF event at an EEG event's place, counted from the two chunks' starts, chunk by chunk."""
        for di in range(len(self.eeg.chunks) - i):
            c = self.eeg.chunks[i + di]
            if c.start <= event <= c.end:
                if j + di >= len(self.edf.chunks):
                    return None
                d = self.edf.chunks[j + di]
                there = d.start + event - c.start
                return there if there <= d.end and self.edf.types[there - 1] == self.eeg.types[event - 1] else None
        return None

    def terminal_loss(self, i: int, j: int) -> bool:
        """A disconnect without reconnect in this chunk ends the alignment at the last trigger before it."""
        c = self.eeg.chunks[i]
        found = self.groups(lambda g: g[0].status == "unresolved" and self.span(g)[1] is None)
        found = [g for g in found if self.span(g)[0] is not None and c.start <= self.span(g)[0] <= c.end]
        if not found:
            return False
        start = min(self.span(g)[0] for g in found)
        there = self.edf.chunks[j].start + start - c.start
        ok = there <= self.edf.chunks[j].end and self.edf.types[there - 1] == self.eeg.types[start - 1]
        require(ok, "match_triggers:TerminalAmplifierAnchorMismatch")
        whole = [s.edges(k) for s, k in ((self.eeg, c), (self.edf, self.edf.chunks[j]))]
        a, b = ([e for e in edges if e[3] < t] for edges, t in zip(whole, (start, there)))
        has = any(e[3] == start for e in whole[0])
        require(has and len(whole[0]) == len(whole[1]) and all(same_one(x, y, self.tol) for x, y in zip(a, b)), "match_triggers:TerminalAmplifierAnchorMismatch")
        for g in (x for group in found for x in group):
            g.status, g.excluded, g.edf_start = "terminal_eeg_loss", True, g.start + there - start
        r = self.r
        r.terminal_relation, r.zero_padding, r.terminal_eeg, r.terminal_edf, r.terminal_common = "eeg_shorter", True, start, there, start - c.start + 1
        self.lose(self.eeg, i, j, start, None, "amplifier_disconnect")
        self.trouble("eeg_data_loss")
        self.log(i, j, "eeg_data_loss", "terminal_eeg_loss")
        self.stop("terminal_anchor_identified", "terminal_eeg_loss")
        return True

    def interruptions(self, i: int, j: int) -> str:
        """none, advance or stop: what the marked interruptions of this EEG chunk mean."""
        c, d = self.eeg.chunks[i], self.edf.chunks[j]

        def here(group):
            start, end = self.span(group)
            s = group[0].status
            if s == "leading_relocked":
                return i == 0
            if start is None:
                return False
            if s == "unresolved":
                return c.start <= start <= c.end
            return s == "excluded_and_relocked" and start < c.start and end is not None and end >= c.start

        found = self.groups(here)
        if not found:
            return "none"
        review = lambda: [self.settle(g, "manual_review") for g in found if g[0].status == "unresolved"]
        if any(self.span(g)[1] is None for g in found) or d.status not in ("match", "partial_end"):
            review()
            return "none"
        for g in found:
            start, end = self.span(g)
            if start is not None and end - start >= len(self.edf.edges(d)):
                review()
                self.trouble("manual_cycle_count_review")
                self.r.requires_relock = True
                self.lose(self.eeg, i, j, start, end, "manual_cycle_count_review")
                self.log(i, j, "eeg_data_loss", "manual_cycle_count_review")
                self.stop("stopped", "manual_cycle_count_review")
                return "stop"
        a, b = self.eeg.edges(c), self.edf.edges(d)
        if d.status == "partial_end":
            n = min(len(a), len(b))
            a, b = a[:n], b[:n]
        if len(a) != len(b) or any(x[:2] != y[:2] for x, y in zip(a, b)):
            return "none"
        mapped = []
        for g in found:
            start, end = self.span(g)
            at = [None if e is None else self.translate(e, i, j) for e in (start, end)]
            if (start is not None and at[0] is None) or at[1] is None:
                if g[0].status != "unresolved":
                    at = [g[0].edf_start, g[0].edf_end]
                else:
                    review()
                    self.trouble("unmapped_amplifier_anchor")
                    self.r.requires_relock = True
                    self.lose(self.eeg, i, j, start, end, "manual_review")
                    self.log(i, j, "eeg_data_loss", "manual_review")
                    self.stop("stopped", "manual_review")
                    return "stop"
            mapped.append(at)
        marked = lambda e: any((s is None or e >= s) and e < t or e == s for s, t in map(self.span, found))
        bad = [x[3] for x, y in zip(a, b) if not same_one(x, y, self.tol)]
        outside = [e for e in bad if not marked(e)]
        longer = any(marked(x[3]) and x[2] - y[2] > self.tol and not same_one(x, y, self.tol) for x, y in zip(a, b))
        if outside or longer:
            review()
            return "none"
        dropped = False
        for g, at in zip(found, mapped):
            start, end = self.span(g)
            s = g[0].status
            clean = not any((start is None or e >= start) and e < end or e == start for e in bad)
            if s == "unresolved" and clean and end - start == 1:
                self.settle(g, "retained_within_tolerance", False, tuple(at))
                continue
            dropped = True
            if s == "unresolved":
                self.settle(g, "excluded_and_relocked", True, tuple(at))
                self.lose(self.eeg, i, j, start, end, "amplifier_disconnect")
        if not dropped:
            return "none"
        self.trouble("eeg_data_loss")
        self.log(i, j, "eeg_data_loss", "resumed_same_offset", (i + 1, j + 1))
        return "advance"

    # The scan

    def locked(self, i: int, j: int) -> bool:
        if not self.r.history:
            return True
        h = self.r.history[-1]
        if h["outcome"] in ("match", "shared_trigger_glitch", "partial_start_match"):
            return True
        resumed = h["resolution_status"] == "resumed_same_offset" and h["next_eeg_chunk_index"] == i + 1 and h["next_edf_chunk_index"] == j + 1
        return resumed and not self.r.requires_relock and all(m["end_event_index"] is not None for m in self.r.missing)

    def terminal(self, i: int, j: int):
        """The last region: the common prefix must cover the shorter side."""
        r = self.r
        a, b = (range(s.chunks[k].start, len(s.types) + 1) for s, k in ((self.eeg, i), (self.edf, j)))
        n = 0
        while n < min(len(a), len(b)):
            x, y = a[n], b[n]
            if self.eeg.types[x - 1] != self.edf.types[y - 1] or (n and not near_each(self.eeg.time(x) - self.eeg.time(x - 1), self.edf.time(y) - self.edf.time(y - 1), self.tol)):
                break
            n += 1
        require(n == min(len(a), len(b)) and n > 0, "match_triggers:TerminalCorrespondenceMismatch")
        r.terminal_eeg, r.terminal_edf, r.terminal_common = a[n - 1], b[n - 1], n
        r.terminal_relation = "same_last_trigger" if len(a) == len(b) else "eeg_shorter" if len(a) < len(b) else "eeg_longer"
        r.zero_padding = r.terminal_relation == "eeg_shorter"
        self.log(i, j, r.terminal_relation, "terminal_anchor_identified")

    def generic_loss(self, i: int, j: int, p: int, s: int, next_j: int | None, ambiguous: bool):
        """A marked interruption that explains a loss found from the edges."""
        c = self.eeg.chunks[i]
        found = self.groups(lambda g: g[0].status == "unresolved" and self.span(g)[0] is not None and c.start <= self.span(g)[0] <= c.end)
        if not found:
            return False
        start, end = self.span(found[0])
        own = self.eeg.edges(c)
        inferred = (c.start + p, own[len(own) - s][3] if s else None)
        if len(found) != 1 or ambiguous or next_j is None or not s or (start, end) != inferred:
            for g in found:
                self.settle(g, "manual_review")
            return False
        clean = self.edf.edges(self.edf.chunks[next_j - 1])
        self.settle(found[0], "excluded_and_relocked", True, (self.edf.chunks[j].start + p, clean[len(clean) - s][3]))
        return True

    def run(self, i: int, j: int):
        r, n, m = self.r, len(self.eeg.chunks), len(self.edf.chunks)
        ended = False
        while i < n and j < m:
            a, b = self.eeg.chunks[i], self.edf.chunks[j]
            if r.gaps and self.terminal_loss(i, j):
                return
            if not (a.bounded and b.bounded):
                if r.gaps:
                    got = self.interruptions(i, j)
                    if got == "stop":
                        return
                    if got == "advance":
                        left = len(self.eeg.types) - a.start, len(self.edf.types) - b.start
                        require(left[0] == left[1], "match_triggers:TerminalAmplifierRelockMismatch")
                        r.terminal_relation, r.zero_padding = "same_last_trigger", False
                        r.terminal_eeg, r.terminal_edf, r.terminal_common = len(self.eeg.types), len(self.edf.types), left[0] + 1
                        self.stop("terminal_anchor_identified", "all_nonterminal_chunks_match")
                        return
                require(self.locked(i, j), "match_triggers:TerminalAlignmentNotLocked")
                self.terminal(i, j)
                ended = True
                break
            got = self.interruptions(i, j) if r.gaps else "none"
            if got == "stop":
                return
            if got == "advance":
                i, j = i + 1, j + 1
                continue
            x, y = self.eeg.edges(a), self.edf.edges(b)
            equal = same(x, y, self.tol)
            good = (a.status == "match", b.status == "match")
            if all(good):
                require(equal, "match_triggers:MatchedChunkDisagreement")
                self.close_open(i, j)
                self.log(i, j, "match", "canonical_match", (i + 1, j + 1))
                r.matched += 1
                r.initial_matched += r.problem is None
                i, j = i + 1, j + 1
            elif any(good):
                require(not equal, "match_triggers:StatusContradiction")
                i2, j2 = self.one_sided(i, j, x, y, good[0])
                if i2 is None:
                    return
                i, j = i2, j2
            elif equal:
                self.log(i, j, "shared_trigger_glitch", "matched_noncanonical", (i + 1, j + 1))
                i, j = i + 1, j + 1
            else:
                p = min(prefix(x, self.eeg.canon_edges(), self.tol), prefix(y, self.edf.canon_edges(), self.tol), prefix(x, y, self.tol))
                self.trouble("both_systems_unusable")
                r.requires_relock = True
                self.lose(self.eeg, i, j, a.start + p, None, "both_systems_unusable")
                self.lose(self.edf, i, j, b.start + p, None, "both_systems_unusable")
                self.log(i, j, "both_systems_unusable", "requires_relock")
                self.stop("stopped", "both_systems_unusable")
                return
        require(ended, "match_triggers:TerminalRegionSkipped")
        self.stop("terminal_anchor_identified", "all_nonterminal_chunks_match" if r.problem is None else r.problem)

    def one_sided(self, i, j, x, y, eeg_good: bool):
        """One side has lost triggers: bracket the loss and go on, over one more clean chunk where a boundary is missing."""
        r = self.r
        side, k, own, clean = (self.edf, j, y, x) if eeg_good else (self.eeg, i, x, y)
        chunk = side.chunks[k]
        self.trouble(f"{side.name}_data_loss")
        skip = 0
        if len(own) >= len(side.canon_types):
            if not (len(own) > len(side.canon_types) and chunk.reason == "suspected_missing_boundary" and chunk.cycles == 2):
                r.requires_relock = True
                p = prefix(own, clean, self.tol)
                self.lose(side, i, j, chunk.start + p, None, "unsupported_cycle_count_ambiguity")
                self.log(i, j, f"{side.name}_data_loss", "unsupported_cycle_count_ambiguity")
                self.stop("stopped", "unsupported_cycle_count_ambiguity")
                return None, None
            skip = 1
        i2, j2 = (i + 1 + skip, j + 1) if eeg_good else (i + 1, j + 1 + skip)
        last_clean = clean
        if skip:
            other, k2 = (self.eeg, i + 1) if eeg_good else (self.edf, j + 1)
            if k2 >= len(other.chunks) or not other.chunks[k2].bounded:
                # The clean side ends here: only the leading edges are known.
                last_clean = []
            else:
                last_clean = other.edges(other.chunks[k2])
        p = prefix(own, clean, self.tol)
        s = prefix(own[::-1], last_clean[::-1], self.tol)
        s = max(0, min(s, len(own) - p, len(last_clean) - (0 if skip else p)))
        start, end = chunk.start + p, own[len(own) - s][3] if s else None
        require(end is None or end >= start, "match_triggers:OverlappingAnchors")
        marked = side is self.eeg and r.gaps and self.generic_loss(i, j, p, s, j2 if j2 <= len(self.edf.chunks) else None, False)
        self.lose(side, i, j, start, end, "amplifier_disconnect" if marked else "within_cycle_loss" if not skip else "missing_boundary_loss")
        self.log(i, j, f"{side.name}_data_loss", "resumed_after_boundary_skip" if skip else "resumed_same_offset", (i2, j2))
        return i2, j2


def match(eeg: Side, edf: Side, gaps: list[Gap] | None = None, validations: int | None = None, before_last: int = 0) -> Result:
    """Pair two systems. validations: number of EDF validation sequences (None: unknown); before_last: kept EDF triggers before the last."""
    tolerance = 2 / min(eeg.rate, edf.rate)
    prepare(eeg, tolerance)
    require(eeg.chunks[0].status != "partial_start", "match_triggers:UnexpectedEegPartialStart")
    restart = bool(validations) and before_last > 0
    if validations is not None:
        require(validations >= 0 and 0 <= before_last < len(edf.types) and not (validations == 0 and before_last), "match_triggers:InvalidStartupMetadata")
    prepare(edf, tolerance)
    scan = Scan(eeg, edf, tolerance, gaps or [])
    scan.validate_cycles()
    r = scan.r
    i = j = 0
    if restart:
        prepare(edf, tolerance, before_last + 1)
        require(edf.chunks[0].status != "partial_start", "match_triggers:UnexpectedPostValidationPartialStart")
        scan.validate_cycles()
        a, b = eeg.chunks[0], edf.chunks[0]
        require(a.status == b.status == "match" and same(eeg.edges(a), edf.edges(b), tolerance), "match_triggers:PostValidationCycleMismatch")
        r.startup, r.initial_reason = "restart_at_last_validation", "restart_at_last_validation"
        r.eeg_anchor, r.edf_anchor = a.start, b.start
    elif edf.chunks[0].status == "partial_start":
        require(validations is not None, "match_triggers:PartialStartRequiresValidationMetadata")
        require(validations == 0, "match_triggers:UnexpectedPostValidationPartialStart")
        i, j = scan.partial_start()
    else:
        if validations is not None:
            r.startup = "normal_validation_start" if validations else "no_validation"
        i, j = scan.initial(i, j)
        if validations == 0:
            require(same(eeg.edges(eeg.chunks[0]), edf.edges(edf.chunks[0]), tolerance), "match_triggers:UnsupportedNoValidationStart")
    if r.gaps:
        if r.startup == "partial_cycle_late_start":
            scan.skipped()
        else:
            scan.leading()
    scan.run(i, j)
    return r


HISTORY = "recording_id long, history_index int, eeg_chunk_index int, edf_chunk_index int, eeg_status string, edf_status string, outcome string, resolution_status string, next_eeg_chunk_index int, next_edf_chunk_index int"
SUMMARY = "recording_id long, status string, outcome string, startup string, initial_reason string, eeg_anchor int, edf_anchor int, matched int, initial_matched int, requires_relock boolean, terminal_relation string, terminal_eeg int, terminal_edf int, terminal_common int, n_missing int, error string"


GAPS = "recording_id long, interruption_index int, group int, status string, excluded boolean, eeg_start int, eeg_end int, edf_start int, edf_end int"
MISSING = "recording_id long, missing_index int, system string, eeg_chunk_index int, edf_chunk_index int, start_event_index int, start_latency long, start_time_sec double, end_event_index int, end_latency long, end_time_sec double, reason string"


def with_marks(eeg: DataFrame, interruptions: DataFrame | None, startup: DataFrame | None) -> DataFrame:
    """EEG triggers with a recording's marked interruptions and start-up counts as rows of other kinds, so that all meet in one group.

    interruptions: recording_id, eeg_start_anchor_event_index, eeg_end_anchor_event_index (null where open), as ``interruption_anchors`` gives them, and
    problem where a pair is invalid. startup: recording_id, validations, before_last, as ``startup_counts`` gives them.
    """
    none = F.lit(None).cast("int")
    out = eeg.select("recording_id", F.lit("event").alias("row"), F.col("event_index").cast("long"), F.col("latency").cast("double").alias("latency"), F.col("type").cast("string").alias("type"), none.alias("a"), none.alias("b"))
    if interruptions is not None:
        problem = F.col("problem") if "problem" in interruptions.columns else F.lit(None).cast("string")
        out = out.unionByName(interruptions.select("recording_id", F.lit("gap").alias("row"), F.lit(0).cast("long").alias("event_index"), F.lit(0.0).alias("latency"), problem.alias("type"), F.col("eeg_start_anchor_event_index").cast("int").alias("a"), F.col("eeg_end_anchor_event_index").cast("int").alias("b")))
    if startup is not None:
        out = out.unionByName(startup.select("recording_id", F.lit("startup").alias("row"), F.lit(0).cast("long").alias("event_index"), F.lit(0.0).alias("latency"), F.lit("").alias("type"), F.col("validations").cast("int").alias("a"), F.col("before_last").cast("int").alias("b")))
    return out


def sides(eeg: pd.DataFrame, edf: pd.DataFrame, eeg_rate: float, edf_rate: float) -> tuple[Side, Side]:
    make = lambda name, p, rate: Side(name, p.sort_values("event_index")["latency"].to_numpy(float), list(p.sort_values("event_index")["type"]), rate)
    return make("eeg", eeg, eeg_rate), make("edf", edf, edf_rate)


def match_group(a: pd.DataFrame, b: pd.DataFrame, eeg_rate: float, edf_rate: float) -> tuple[Result, Side, Side]:
    """The pairing of one recording: a as ``with_marks`` gives it, b the EDF triggers."""
    events, marks, counts = (a[a["row"] == k] for k in ("event", "gap", "startup"))
    require(len(events) > 0 and len(b) > 0, "match_triggers:MissingRecording")
    bad = sorted(marks["type"].dropna())
    require(not bad, "extract_triggers:MalformedAmplifierSequence", ", ".join(bad))
    whole = lambda x: None if pd.isna(x) else int(x)
    gaps = sorted((Gap(whole(x), whole(y)) for x, y in zip(marks["a"], marks["b"])), key=lambda g: (g.start is not None, g.start or 0, g.end is None, g.end or 0))
    require(len(counts) <= 1, "match_triggers:InvalidStartupMetadata")
    options = {"validations": whole(counts["a"].iloc[0]), "before_last": whole(counts["b"].iloc[0]) or 0} if len(counts) else {}
    x, y = sides(events, b, eeg_rate, edf_rate)
    return match(x, y, gaps, **options), x, y


def match_recordings(eeg: DataFrame, edf: DataFrame, eeg_rate: float, edf_rate: float, what: str = "summary", interruptions: DataFrame | None = None, startup: DataFrame | None = None) -> DataFrame:
    """The summary, history, missing spans, or interruptions of every recording; a recording that violates a contract has its identifier as error of the summary.

    interruptions and startup are those of ``with_marks``; without startup a recording's validation counts are unknown.
    """
    schema = {"summary": SUMMARY, "history": HISTORY, "missing": MISSING, "interruptions": GAPS}[what]

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        error, r = None, Result(status="failed")
        try:
            r = match_group(a, b, eeg_rate, edf_rate)[0]
        except AlignmentError as x:
            error = x.identifier
        if what == "history":
            rows = [{"recording_id": key[0], "history_index": k + 1, **h} for k, h in enumerate(r.history)]
        elif what == "missing":
            rows = [{"recording_id": key[0], "missing_index": k + 1, **m} for k, m in enumerate(r.missing)]
        elif what == "interruptions":
            rows = [{"recording_id": key[0], "interruption_index": k + 1, "group": g.group, "status": g.status, "excluded": g.excluded, "eeg_start": g.start, "eeg_end": g.end, "edf_start": g.edf_start, "edf_end": g.edf_end} for k, g in enumerate(r.gaps)]
        else:
            rows = [{"recording_id": key[0], **{f: getattr(r, f) for f in ("status", "outcome", "startup", "initial_reason", "eeg_anchor", "edf_anchor", "matched", "initial_matched", "requires_relock", "terminal_relation", "terminal_eeg", "terminal_edf", "terminal_common")}, "n_missing": len(r.missing), "error": error}]
        out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
        return out.astype({c: "Int64" for c, kind in (x.split() for x in schema.split(", ")) if kind in ("int", "long")})

    return with_marks(eeg, interruptions, startup).groupBy("recording_id").cogroup(edf.groupBy("recording_id")).applyInPandas(run, schema)
