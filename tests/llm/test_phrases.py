"""Phrases against a plain count of every contiguous run of words."""

import random
import re
from collections import Counter, defaultdict

import pytest

from lockstep.llm import phrases


def plain(rows, least=10, longest=3, cover=50, top=2000, salts=None):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        told = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in told.items():
            inside = any(len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in told.items())
            score, _, l, r = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), a, l, r, score))
        out += [(lang, i + 1, x[2].decode(), *x[3:6], n[lang], x[6]) for i, x in enumerate(sorted(kept)[:top])]
    return sorted(out)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, lang, text, "x") for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, score string")
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.collocations(docs, **options).collect())


def corpus(seed, words=12, texts=60):
    rng = random.Random(seed)
    told = [f"w{i}" for i in range(words)] + ["É", "the", "The", "the", "und"]
    ends = [" "] * 8 + [", ", "\n", "\t", "  ", "\x0b", "-"]
    return [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(told) + rng.choice(ends) for _ in range(rng.randrange(80)))) for _ in range(texts)]


@pytest.mark.parametrize("options", [{}, {"least": 3, "longest": 4}, {"least": 2, "top": 7, "salts": 3}, {"least": 2, "longest": 2, "cover": 101}])
def test_against_plain_counts(spark, options):
    rows = corpus(1) + [("en", None), (None, ""), ("fr", " \t.,"), ("en", "the the the the the the the the the the the the")]
    assert found(spark, rows, **options) == plain(rows, **options)


def test_hot_words_are_split_and_counted_whole(spark):
    rows = corpus(2, words=4, texts=120) + [("en", "the end " * 400)] * 3
    assert found(spark, rows, shard_places=200) == plain(rows)


def test_windows_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(phrases, "WINDOW", 50)
    rows = corpus(3, texts=20)
    for longest in (2, 3, 5):
        places = []
        for _, text in rows:
            for found, numbers in phrases.windows([phrases.pa.array([text])], longest):
                named = [None, *(x.decode() for x in found.to_pylist())]
                places += [tuple(named[k] for k in place) for place in numbers.T.tolist()]
        want = []
        for _, text in rows:
            for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text)):
                w = re.findall("[^ \t]+", piece)
                want += [tuple((w[i : i + longest] + [None] * longest)[:longest]) for i in range(len(w))]
        assert places == want


def test_no_words(spark):
    assert found(spark, []) == []
    assert found(spark, [("en", None), (None, "...")]) == []
