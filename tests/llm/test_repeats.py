"""Removal of repeated strings against brute force over all windows."""

import hashlib

import numpy as np
import pytest

from lockstep.llm import repeats

DOCS = "doc_id long, text string"


def brute(rows, least=50):
    seen = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - least + 1):
            if i is not None:
                w = b[k : k + least]
                seen[w] = min(seen.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - least + 1):
            if i is not None and seen[b[k : k + least]] < i:
                gone[k : k + least] = True
        starts = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), len(b) - len(kept), starts, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows():
    rng = np.random.default_rng(0)
    word = lambda n: " ".join(rng.choice(["the", "of", "réé", "and", "tion", "er", "ing"], n))
    common, passage = word(40), word(30)
    out = [(i, word(20) + common + word(int(rng.integers(1, 60)))) for i in range(40)]
    out += [(100 + i, passage + str(i) + word(30)) for i in range(20)]
    out += [(50, out[3][1]), (51, out[3][1]), (2, out[5][1]), (60, "a" * 300), (61, "a" * 120 + "b" * 80), (62, "ab" * 200), (63, None), (64, ""), (65, "short"), (None, common), (66, common[:50]), (67, common[:49]), (40, out[7][1]), (40, out[7][1]), (68, word(9000))]
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 3, "share": 0.0}, {"pool": 500, "bucket_entries": 20}])
def test_against_brute_force(spark, options):
    r = rows()
    got = repeats.removals(spark.createDataFrame(r, DOCS).repartition(5), **options).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(r)


def test_empty(spark):
    assert repeats.removals(spark.createDataFrame([], DOCS)).count() == 0


def test_intervals_are_common_prefixes():
    rng = np.random.default_rng(2)
    data = np.frombuffer(bytes(rng.choice(list(b"ab"), 400)) + b"\xff", np.uint8)
    order, number = repeats.intervals(data, 9)
    raw = data.tobytes()
    for j in range(1, len(order)):
        a, b = raw[order[j - 1] :][:9], raw[order[j] :][:9]
        if len(a) == len(b) == 9 and b"\xff" not in a + b:
            assert (a == b) == (number[j - 1] == number[j])


def test_transform_takes_few_bytes_for_each():
    import tracemalloc

    rng = np.random.default_rng(3)
    pieces = rng.integers(97, 123, (3000, 81), dtype=np.uint8)
    pieces[::3, 20:80] = pieces[0, 20:80]
    pieces[:, 80] = 255
    place = np.arange(pieces.size, dtype=np.int32)
    tracemalloc.start()
    covered = repeats.covered_windows(pieces.reshape(-1), place // 81, place % 81 <= 30, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert covered.reshape(3000, 81)[3::3, 20:31].all() and not covered[:81].any()
    assert peak < 45 * pieces.size
