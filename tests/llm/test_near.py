"""Fingerprints, the Gray index, components, and the pipeline's near-duplicates."""

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lockstep.llm import simhash
from lockstep.llm.components import components

DOCS = "doc_id long, text string"


def words(text):
    out = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w]


def fingerprint(text, width=3):
    w = words(text)
    shingles = [" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute(rows, radius=2):
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    out = {}
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out[i] = (f"{fps[i]:016x}", min(ids, default=None))
    return sorted(((rows[i][0], *out[i]) for i in range(len(rows))), key=str)


@given(st.lists(st.text(alphabet="abAB \n\té", max_size=30), max_size=8))
@settings(max_examples=60, deadline=None)
def test_fingerprints(texts):
    got = np.asarray(simhash.fingerprints(pa.array(texts, pa.string()))).view(np.uint64)
    assert got.tolist() == [fingerprint(t) for t in texts]


@given(st.integers(0, 2**32), st.integers(1, 6), st.sampled_from([64, 1 << 18]))
@settings(max_examples=20, deadline=None)
def test_search_finds_all_pairs(seed, radius, most):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2**64, 12, dtype=np.uint64).repeat(12)
    for _ in range(radius):
        x ^= np.where(rng.random(len(x)) < 0.7, np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64), np.uint64(0))
    group = np.sort(rng.integers(0, 3, len(x)))
    order = np.lexsort((simhash.gray_rank(x), group))
    x, group = x[order], group[order]
    got = {(int(i), int(j)) for a, b in simhash.search(group, x, radius, most) for i, j in zip(a, b)}
    want = {(i, j) for j in range(len(x)) for i in range(j) if group[i] == group[j] and int(x[i] ^ x[j]).bit_count() <= radius}
    assert got == want


def edge_rows():
    base = "one two three four five six seven eight nine ten eleven twelve"
    return [(5, base), (3, base), (9, base.upper()), (None, base), (7, None), (8, ""), (11, " \n "), (None, "lonely words here"), (20, "word"), (21, "word word"), (22, "x" * 50000), (20, "word"), (30, base + " thirteen")]


def test_edges_against_brute_force(spark):
    rows = edge_rows()
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOCS).withColumnRenamed("doc_id", "doc_id")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_large_groups_are_dealt_again(spark):
    rng = np.random.default_rng(1)
    x = np.unique(np.concatenate([rng.integers(0, 2**63, 20) ^ (1 << int(b)) for b in rng.integers(0, 62, 12)]))
    df = spark.createDataFrame([(int(v), int(v)) for v in x], "node long, fp long")

    def groups(large):
        found = {r.node: r.root for r in components(simhash.links(df, 2, large)).collect()}
        return {int(v): found.get(int(v), int(v)) for v in x}

    assert groups(3) == groups(1 << 17)


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}


def test_one_of_each_keeps_the_first(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" for i in range(400)]
    text = [" ".join(rng.choice(vocabulary, 300)) for _ in range(3)]
    near = text[0].split()
    near[100] = "changed"
    rows = [(2, text[0], "a"), (1, text[1], "b"), (4, " ".join(near), "c"), (5, text[0], "d"), (6, text[2], "e"), (6, text[2], "e")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 6] and kept.columns == ["doc_id", "text", "source"]


def jaccard(a, b):
    x, y = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (words(a), words(b)))
    return len(x & y) / len(x | y)


def test_one_of_each_links_at_exactly_the_similarity(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"word{i}" for i in range(3000)]
    make = lambda n: rng.choice(vocabulary, n).tolist()
    rows = []
    for k in range(60):
        text = make(300)
        edit = int(rng.integers(16, 72))
        if k % 3 == 0:  # a replaced block
            other = text[:100] + make(edit // 2) + text[100 + edit // 2 :]
        elif k % 3 == 1:  # a tail
            other = text + make(edit)
        else:  # scattered words
            other = [make(1)[0] if i % (1500 // edit) == 7 else w for i, w in enumerate(text)]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
    similarity = [jaccard(rows[k][1], rows[k + 1][1]) for k in range(0, len(rows), 2)]
    assert sum(x < 0.8 for x in similarity) > 10 and sum(0.8 <= x < 0.85 for x in similarity) > 10
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == set(range(0, 120, 2)) | {2 * k + 1 for k, x in enumerate(similarity) if x < 0.8}


def test_one_of_each_keeps_every_text_of_null_and_repeated_ids(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"word{i}" for i in range(400)]
    a, b, c, d, e, f = (" ".join(rng.choice(vocabulary, 100)) for _ in range(6))
    rows = [(None, a), (None, b), (None, b), (5, c), (None, c), (None, d), (8, e), (8, f), (8, f), (9, e)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((tuple(r) for r in kept), key=str) == sorted([(None, a), (None, b), (5, c), (None, d), (8, e), (8, f)], key=str)


def test_one_of_each_takes_maps_and_tells_texts_of_one_hash_apart(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vocabulary = [f"word{i}" for i in range(400)]
    a, b = (" ".join(rng.choice(vocabulary, 60)) for _ in range(2))
    rows = [(1, a, {"k": [{"x": 1}]}), (2, a, {"k": [{"x": 2}]}), (3, b, None), (None, b, {}), (1, a, {"k": [{"x": 3}]})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more map<string,array<map<string,int>>>")
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [1, 3]
    one = simhash.same_words
    monkeypatch.setattr(simhash, "same_words", lambda texts, seed=simhash.SEED: one(texts, seed) if seed != simhash.SEED else pa.array([5] * len(texts), pa.int64()))
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [1, 3]
