"""Fingerprints by consistent weighted sampling: order, edits and likeness against plain counterparts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lockstep.llm import weighted


def jaccard(a, b):
    a, b = Counter(a), Counter(b)
    return sum(min(a[k], b[k]) for k in a | b) / max(1, sum((a | b).values()))


def texts(seed, n, most=400):
    rng = random.Random(seed)
    return [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.randrange(most))) for _ in range(n)]


def test_likeness_is_the_generalised_jaccard_index():
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        a = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(20, 300))]
        b = a[: rng.randrange(len(a))] + [f"w{rng.randrange(60)}" for _ in range(rng.randrange(200))]
        pairs.append((a, b))
    one, two = (weighted.fingerprints([" ".join(p[k]).encode() for p in pairs]) for k in (0, 1))
    error = np.array([weighted.likeness(x, y) - jaccard(a, b) for x, y, (a, b) in zip(one, two, pairs)])
    assert abs(error.mean()) < 0.015 and np.sqrt((error**2).mean()) < 1.2 * 0.5 / np.sqrt(weighted.SIZE)


def test_draws_keep_the_law_of_minima():
    """The least cost's share among terms follows their weights, and a larger weight never costs more."""
    x = np.arange(1, 4001, dtype=weighted.U) * weighted.ODD
    light, heavy = (weighted.draws(x, np.full(4000, n)) for n in (1, 3))
    assert (heavy[:2000] >> weighted.U(32) <= light[:2000] >> weighted.U(32)).all()
    share = (heavy[:2000] < light[2000:]).mean()
    assert abs(share - 0.75) < 0.01


def test_gamma_quantiles():
    x = weighted.gamma_quantiles(1000)
    assert np.allclose(1 - (1 + x) * np.exp(-x), (np.arange(1000) + 0.5) / 1000, atol=1e-12) and (np.diff(x) > 0).all()


def test_parts_and_blocks_change_nothing(monkeypatch):
    some = [x.encode() for x in [*texts(1, 30), "", " ", "é" * 50, "x" * 500, "A b a B " * 3000]]
    want = weighted.fingerprints(some)
    monkeypatch.setattr(weighted, "PART", 700)
    monkeypatch.setattr(weighted, "BLOCK", 7)
    assert (weighted.fingerprints(some) == want).all()
    assert (np.vstack([weighted.fingerprints([x]) for x in some]) == want).all()
    assert not want[30:32].any() and weighted.fingerprints([]).shape == (0, weighted.SIZE)
    assert (weighted.fingerprints([b"One two\tTWO\nx"]) == weighted.fingerprints([b"x two one two"])).all()


def test_words_without_spaces_are_told_apart():
    a = "".join(random.Random(1).choices("日月火水木金土", k=300))
    x, y, z = weighted.fingerprints([a.encode(), (a[:225] + "山川" * 38).encode(), ("山川" * 150).encode()])
    assert weighted.likeness(x, y) > 0.4 > 0.1 > weighted.likeness(x, z)


def plain(rows):
    """rows: (id, text) in order."""
    out = []
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1]):
        n = len(a) // 4
        new = a[: len(a) - n] + b[:n]
        x, y, z = (weighted.fingerprints([t.encode()])[0] for t in (a, new, b))
        out.append((i, len(a), hashlib.sha256(new.encode()).hexdigest(), weighted.written(x), weighted.written(y), weighted.likeness(x, y), weighted.likeness(x, z)))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 57])
def test_query_against_each_document_alone(spark, n):
    rng = random.Random(n)
    rows = sorted(zip(rng.sample(range(-1000, 1000), n), [*texts(n, n // 2), *texts(n, n - n // 2, 3)]))
    if n > 50:
        rows[3:6] = [(rows[3][0], "é日𝄞" * 9), (rows[4][0], ""), (rows[5][0], "É " * 20)]
    docs = spark.createDataFrame([(i, t or None, "x", "y") for i, t in rng.sample(rows, n)], "doc_id long, text string, fingerprint string, block string")
    got = sorted(tuple(r) for r in weighted.fingerprinted(docs.repartition(3)).collect())
    assert got == plain(rows)


def test_ids_that_repeat_or_are_null(spark):
    rows = [(None, "a b c d"), (None, "e f g h"), (None, "a b c d"), *((7, f"t{k} u v w") for k in range(40)), (9, "end of all")]
    got = weighted.fingerprinted(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert sum(r.fingerprint == weighted.written(weighted.fingerprints([b"a b c d"])[0]) for r in got) == 2
    last = next(r for r in got if r.doc_id == 9)
    assert last.edited_sha256 in {hashlib.sha256(("end of a" + t[:2]).encode()).hexdigest() for t in ("a b c d", "e f g h")}
