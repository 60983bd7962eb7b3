"""The pipeline's stages on a small corpus, each against what it must keep and drop."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lockstep.llm import mixing


def corpus(spark, folder):
    rng = np.random.default_rng(0)
    words = {"aa": [f"{a}{b}ing" for a in "bcdfg" for b in "aeiou"], "bb": [f"{a}{b}keit" for a in "bcdfg" for b in "aeiou"]}
    make = lambda k, n: " ".join(rng.choice(words[k], n))
    docs = [(i, make("aa" if i % 2 else "bb", 80), "aa" if i % 2 else "bb", f"s{i % 4}", 0) for i in range(80)]
    bench = [(1, make("aa", 25))]
    docs += [(90, docs[3][1], "aa", "s0", 0), (91, make("aa", 60) + " " + bench[0][1] + " " + make("aa", 60), "aa", "s1", 0), (92, "12345 !!!", "aa", "s2", 0), (93, make("bb", 50) + " me@here.org " + make("bb", 20), "bb", "s3", 0), (94, None, None, None, None)]
    near = docs[4][1].split()
    near[40] = "altered"
    docs.append((95, " ".join(near), "bb", "s0", 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_stages(spark, tmp_path):
    docs = corpus(spark, tmp_path)
    df, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = df.columns
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, str(tmp_path))
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        assert df.columns[: len(columns)] == columns
        seen.append({r.doc_id for r in df.select("doc_id").collect()})
    every = {d[0] for d in docs}
    assert seen[0] == every - {92, 94}
    assert seen[1] == seen[0] - {90, 95}
    assert seen[2] == seen[1] - {91}
    assert seen[3] == seen[2]
    assert "me@here.org" not in " ".join(r.text for r in df.collect())
    assert sum(r.taken for r in df.collect()) > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == df.count()


#: Names that the operators use within, or give to their results.
CLASHES = (
    "score", "lang_pred", "told", "row", "size", "source_size", "target", "taken", "draws", "shards", "block", "src", "hash", "__told", "__new", "__key", "__id", "__none", "__hash",
    "key", "kind", "value", "surrogate", "spans", "new", "n", "some", "node", "fp0", "none", "id", "all", "at", "known", "root", "part", "sketch",
)


def test_odd_rows_and_clashing_names(spark, tmp_path):
    """Null and repeated ids with different texts, null and empty texts, a very long one, repeated rows, and columns with the operators' names."""
    corpus(spark, tmp_path)
    rng = np.random.default_rng(5)
    words = [f"{a}{b}ing" for a in "bcdfg" for b in "aeiou"]
    make = lambda n: " ".join(rng.choice(words, n))
    texts = {k: make(60) for k in ("null 1", "null 2", "same 1", "same 2", "twice")} | {"long": make(200_000)}
    rows = [(None, texts["null 1"]), (None, texts["null 2"]), (7, texts["same 1"]), (7, texts["same 2"]), (8, texts["twice"]), (8, texts["twice"]), (9, None), (10, ""), (11, texts["long"]), (None, None)]
    rows += [(20 + i, make(60)) for i in range(20)]
    df = spark.createDataFrame([(i, t, "aa", "s0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHES:
        df = df.withColumn(name, F.lit(name))
    before = df.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == before, name
        got = df.collect()
        assert all(r[c] == c for r in got for c in CLASHES), name
        held = [r.text for r in got]
        # no text goes for another's sake
        assert sorted({t for t in held if t}) == sorted({t for _, t in rows if t}), name
        if name == "near_duplicates":
            assert len(held) == len(set(held))
        df.write.parquet(f"{tmp_path}/odd-{name}")
        df = spark.read.parquet(f"{tmp_path}/odd-{name}")
    name, stage = corpus_pipeline.STAGES[-1]
    last = stage(spark, df, str(tmp_path))
    got = last.collect()
    assert all(r[f"{c}_kept" if c in mixing.RESULTS else c] == c for r in got for c in CLASHES)
    assert {r.text for r in got} == set(texts.values()) | {t for i, t in rows if i and i >= 20}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    from lockstep.llm import queries

    for name, query in queries.queries().items():
        assert query(spark, str(tmp_path)).count() == (1 if name == "op3_chat" else 0)
