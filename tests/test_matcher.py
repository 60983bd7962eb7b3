"""The pairing scan on schedules with known losses."""

import numpy as np
import pytest

from lockstep.errors import AlignmentError
from lockstep.operators.matcher import Gap, Side, match

TYPES = ["64"] * 4 + ["63"] * 46
TIMES = np.concatenate([[0], np.cumsum(np.arange(10, 59))])
FULL = list(range(1, 51))


def keep(n, **changed):
    out = [FULL] * n
    for k, v in changed.items():
        out[int(k[1:]) - 1] = v
    return out


def without(*gone):
    return [k for k in FULL if k not in gone]


def build(name, cycles, rate, start):
    times = [start + 1725 * c + TIMES[k - 1] for c, ks in enumerate(cycles) for k in ks]
    return Side(name, np.round(np.array(times) * rate) + 1, [TYPES[k - 1] for ks in cycles for k in ks], rate)


def run(eeg, edf, gaps=None, change=None, **options):
    a, b = build("eeg", eeg, 500, 0), build("edf", edf, 128, 100)
    if change:
        change(a, b)
    return match(a, b, gaps, **options)


def pairs(r):
    return [(h["eeg_chunk_index"], h["edf_chunk_index"]) for h in r.history]


LOSS = keep(5, c2=without(12, 13))


def test_clean():
    r = run(keep(5), keep(5))
    assert (r.outcome, r.matched, r.terminal_relation) == ("all_nonterminal_chunks_match", 4, "same_last_trigger")


def test_short_loss_in_eeg():
    r = run(LOSS, keep(5))
    assert (r.matched, r.initial_matched) == (3, 1)
    assert pairs(r) == [(i, i) for i in range(1, 6)]
    h = r.history[1]
    assert (h["outcome"], h["resolution_status"]) == ("eeg_data_loss", "resumed_same_offset")
    m = r.missing[0]
    assert (m["start_latency"], m["end_latency"]) == (935001, 966501)


def test_short_loss_in_edf():
    m = run(keep(5), LOSS).missing[0]
    assert (m["system"], m["start_latency"], m["end_latency"]) == ("edf", 252161, 260225)


def test_missing_boundary_in_eeg():
    r = run(keep(5, c3=FULL[6:]), keep(5))
    assert pairs(r) == [(1, 1), (2, 2), (3, 4), (4, 5)]
    assert r.history[1]["resolution_status"] == "resumed_after_boundary_skip"
    assert (r.missing[0]["start_latency"], r.missing[0]["end_latency"]) == (1695501, 1762501)


def test_missing_boundary_in_edf():
    r = run(keep(5), keep(5, c3=FULL[6:]))
    assert pairs(r) == [(1, 1), (2, 2), (4, 3), (5, 4)]
    assert (r.missing[0]["start_latency"], r.missing[0]["end_latency"]) == (446849, 464001)


def test_shared_glitch_and_its_tolerance():
    r = run(LOSS, LOSS)
    assert r.history[1]["outcome"] == "shared_trigger_glitch" and r.matched == 3 and not r.missing

    def move(by):
        def change(a, b):
            b.latency[50 + 20] += by

        return change

    assert run(LOSS, LOSS, change=move(2)).history[1]["outcome"] == "shared_trigger_glitch"
    assert run(LOSS, LOSS, change=move(3)).outcome == "both_systems_unusable"


def test_both_unusable():
    r = run(LOSS, keep(5, c2=without(20)))
    assert r.outcome == "both_systems_unusable" and r.requires_relock
    assert [(m["system"], m["start_latency"], m["end_latency"]) for m in r.missing] == [("eeg", 935001, None), ("edf", 252161, None)]


def test_losses_on_either_side():
    r = run(keep(6, c2=without(12, 13)), keep(6, c4=without(12, 13)))
    assert [h["outcome"] for h in r.history] == ["match", "eeg_data_loss", "match", "edf_data_loss", "match", r.terminal_relation]
    assert r.terminal_relation == "same_last_trigger"


@pytest.mark.parametrize(
    "eeg, edf, error",
    [
        ([without(25)] * 5, keep(5), "validate_canonical_cycles:UnexpectedTriggerCount"),
        (keep(4, c4=FULL), keep(5, c4=FULL[6:]), "match_triggers:TerminalRegionSkipped"),
        (keep(5, c4=FULL[:48]), keep(5), "match_triggers:TerminalAlignmentNotLocked"),
    ],
)
def test_contract_violations(eeg, edf, error):
    if error.endswith("Skipped"):
        eeg, edf = keep(5, c4=FULL[6:]), keep(4)
    with pytest.raises(AlignmentError) as e:
        run(eeg, edf)
    assert e.value.identifier in (error, "match_triggers:TerminalCorrespondenceMismatch") if error.endswith("NotLocked") else e.value.identifier == error


def test_interval_mismatch():
    def change(a, b):
        b.latency[25::50] += 3

    with pytest.raises(AlignmentError, match="IntervalMismatch"):
        run(keep(5), keep(5), change=change)


def test_late_start():
    r = run(keep(6), keep(6, c1=FULL[24:]), validations=0)
    assert (r.startup, r.partial_interval, r.partial_intervals, r.eeg_anchor, r.edf_anchor) == ("partial_cycle_late_start", 25, 26, 25, 1)
    with pytest.raises(AlignmentError, match="LateStartInsufficientEvidence"):
        run(keep(6), keep(6, c1=[50]), validations=0)
    with pytest.raises(AlignmentError, match="PartialStartRequiresValidationMetadata"):
        run(keep(6), keep(6, c1=FULL[24:]))


def test_aborted_startup():
    r = run(keep(5), keep(6, c1=FULL[:10]), change=lambda a, b: None)
    assert (r.initial_reason, r.startup_prefix, r.startup_suffix, r.eeg_anchor, r.edf_anchor) == ("edf_restart_at_t1_boundary", 9, 0, 1, 11)
    assert pairs(r) == [(i, i + 1) for i in range(1, 6)]


def test_first_chunk_losses():
    r = run(keep(6), keep(6, c1=without(12, 13)))
    assert (r.initial_reason, r.startup_prefix, r.startup_suffix) == ("edf_first_chunk_bracketed_loss", 10, 37)
    assert (r.missing[0]["start_event_index"], r.missing[0]["end_event_index"]) == (11, 12)
    r = run(keep(6), keep(6, c2=FULL[6:]))
    assert pairs(r) == [(1, 1), (3, 2), (4, 3), (5, 4), (6, 5)]
    assert (r.missing[0]["start_event_index"], r.missing[0]["end_event_index"]) == (50, 51)


@pytest.mark.parametrize("a, b, relation, common", [(30, 45, "eeg_shorter", 30), (45, 30, "eeg_longer", 30), (30, 30, "same_last_trigger", 30)])
def test_terminal(a, b, relation, common):
    r = run(keep(5, c5=FULL[:a]), keep(5, c5=FULL[:b]))
    assert (r.terminal_relation, r.terminal_common, r.terminal_eeg, r.terminal_edf) == (relation, common, 230, 230)


def test_continued_after_boundary():
    r = run(keep(5), keep(6, c6=FULL[:10]))
    assert (r.terminal_relation, r.terminal_eeg, r.terminal_common) == ("eeg_shorter", 250, 50)


def test_terminal_tolerance():
    def move(by):
        def change(a, b):
            b.latency[219] += by

        return change

    part = keep(5, c5=FULL[:30])
    assert run(part, part, change=move(2)).terminal_relation == "same_last_trigger"
    with pytest.raises(AlignmentError, match="TerminalCorrespondenceMismatch"):
        run(part, part, change=move(3))


def after(event, by):
    def change(a, b):
        a.latency[event:] -= by

    return change


def test_marked_interruptions():
    start = 51 + 19
    r = run(keep(5), keep(5), [Gap(start, start + 1)], after(start, 500))
    assert r.gaps[0].status == "excluded_and_relocked" and r.missing[0]["reason"] == "amplifier_disconnect"
    r = run(keep(5), keep(5), [Gap(start, start + 1)], after(start, 7))
    assert r.gaps[0].status == "retained_within_tolerance" and not r.missing
    r = run(keep(5), keep(5), [Gap(start, start + 3)])
    assert r.gaps[0].status == "excluded_and_relocked"
    r = run(keep(5), keep(5), [Gap(start, start + 50)])
    assert r.gaps[0].status == "manual_review" and r.status == "stopped"
    r = run(keep(5, c5=FULL[:30]), keep(5, c5=FULL[:30]), [Gap(211, None)])
    assert r.gaps[0].status == "terminal_eeg_loss" and r.terminal_relation == "eeg_shorter" and r.missing[-1]["end_event_index"] is None
    r = run(keep(5), keep(5), [Gap(None, 3)])
    assert r.gaps[0].status == "leading_relocked" and (r.eeg_anchor, r.edf_anchor) == (3, 3)


def test_the_first_interval_after_a_reconnect_decides():
    r = run(keep(5), keep(5), [Gap(None, 3)])
    assert r.initial_reason == "amplifier_reconnect" and r.gaps[0].edf_end == 3
    with pytest.raises(AlignmentError, match="LeadingAmplifierRelockFailed"):
        run(keep(5), keep(5), [Gap(None, 3)], after(3, 500))
    with pytest.raises(AlignmentError, match="UnanchoredLeadingAmplifierInterruption"):
        run(keep(5), keep(5), [Gap(None, 250)])


def test_a_terminal_loss_needs_equal_chunks():
    r = run(keep(5, c5=FULL[:30]), keep(5, c5=FULL[:30]), [Gap(211, None)])
    assert (r.history[-1]["outcome"], r.history[-1]["resolution_status"], r.missing[-1]["reason"], r.problem) == ("eeg_data_loss", "terminal_eeg_loss", "amplifier_disconnect", "eeg_data_loss")
    with pytest.raises(AlignmentError, match="TerminalAmplifierAnchorMismatch"):
        run(keep(5, c5=FULL[:30]), keep(5, c5=FULL[:25]), [Gap(211, None)])


def test_restart_after_validation():
    r = run(keep(6), keep(6), validations=2, before_last=50, change=lambda a, b: None)
    assert (r.startup, r.eeg_anchor, r.edf_anchor) == ("restart_at_last_validation", 1, 51)
