"""The other operators: round trips, brute force, and odd rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lockstep.llm import chat, decontaminate, langid, mixing, pii, quality, secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=""):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    for name in ("fp", "key", "told", "kind", "block", "src", "__told_", "value", "spans"):
        df = df.withColumn(name, F.lit(name))
    return df


ODD = [(1, None), (2, ""), (3, " \n\t"), (None, "words of a text without an id"), (4, "same text here"), (5, "same text here"), (5, "same text here"), (6, "x " * 60000), (7, "ß é 日本語"), (8, "1234 !!")]


# Chat


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a>b", "", "x\ny", "<turn "]), st.text(alphabet="ab\\<>ln\n#/ ", max_size=12)), min_size=1, max_size=5))
@settings(max_examples=100, deadline=None)
def test_escapes_are_reversible(turns):
    assert all(chat.unescape(chat.escape(t)) == t for _, t in turns)
    rows = [("0" * chat.DIGEST * len(turns), "p", [{"role": r, "text": t} for r, t in turns])]
    (pack,) = chat.packs_of(iter(rows), 1 << 16, "assistant")
    text = pack["tokens"].tobytes().decode("utf-32-le")
    if len(set(rows[0][0])) == 1 and len(turns) == 1:
        assert [(chat.unescape(r), chat.unescape(t)) for r, t in chat.TURN.findall(text)] == turns


def test_conversations(spark):
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", "hi <there>"), (2, 0, "user", "hello"), (2, 1, "assistant", "hi <there>"), (3, 0, "user", "hello"), (3, 1, "assistant", "other"), (3, 2, "user", None), (4, 5, None, "late"), (4, 1, "assistant", "\\n</turn>\n"), (None, 0, "user", "no id"), (5, None, "assistant", ""), (6, 0, "user", "x"), (6, 0, "user", "x")]
    got = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        learned = "".join(x for _, r, x in turns if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_shared_turns_once_and_intervals(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}" if t < 2 else f"{c} {t}") for c in range(6) for t in range(4)]
    convs = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).coalesce(1)
    packs = chat.format_trees(convs.repartition(1)).collect()
    spark_parts = [p for p in packs]
    text = "".join(np.array(p.tokens, np.int32).tobytes().decode("utf-32-le") for p in spark_parts)
    assert text.count("turn 0") == len(spark_parts)  # once in each pack
    for p in spark_parts:
        for n in p.nodes:
            assert p.position_ids[n.start] == sum(a.end - a.start for a in n.ancestors) == n.position
            if n.parent >= 0:
                assert (n.ancestors[-1].start, n.ancestors[-1].end) == (p.nodes[n.parent].start, p.nodes[n.parent].end)
    small = chat.read_back(chat.format_trees(convs, pack=10))
    assert {tuple(r) for r in small.collect()} == {tuple(r) for r in chat.read_back(chat.format_trees(convs)).collect()}


# Secrets


def brute_secrets(text):
    out = []
    for k, r in enumerate(secrets.BASE):
        for m in re.finditer({"assign": secrets.ASSIGN, "access": secrets.ACCESS, "hex": r"[0-9a-f]+"}[r.name], text):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), k, m.end(), r.name))
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(out))


def test_secrets_against_brute_force(spark):
    texts = [(i, t) for i, t in enumerate([None, "", "é password = 'abcdef' secret=token:abcdef Token:abc API_KEY=\"zzzzzz==\"", "AKIA" + "A" * 16 + "AKIAB AKIA" + "9" * 20, "x" + "0a" * 12 + "g" + "f" * 23, "日本 passwd:  abc/def+ " * 40, "password==abcdef", "token='abcde' token=abcdef"])]
    texts.append((2, texts[2][1]))
    df = documents(spark, texts)
    got = secrets.report(df, secrets.scan(df)).collect()
    assert sorted((r.doc_id, r.base_sha256) for r in got) == sorted((i, hashlib.sha256(brute_secrets(t or "").encode()).hexdigest()) for i, t in texts)


def test_ledger_table(spark, tmp_path):
    path = str(tmp_path / "ledger")
    docs = spark.createDataFrame([(1, "token=abcdef"), (2, "token=abcdef"), (3, None), (4, "gh" + "p_" + "z" * 36)], "doc_id long, text string")
    pairs = len(secrets.RULES)
    assert secrets.update(docs.where("doc_id < 3"), path).count() == pairs
    ledger = secrets.update(docs, path)
    assert ledger.count() == 3 * pairs  # one blob was there
    assert secrets.update(docs, path).count() == 3 * pairs  # nothing new
    assert {r.doc_id: r.spans for r in secrets.report(docs, ledger).collect()} == {1: "assign:0:12", 2: "assign:0:12", 3: "", 4: "github:0:40"}
    assert secrets.update(docs.where("false"), str(tmp_path / "none")).count() == 0


def test_ledger_is_incremental(spark):
    old, new = documents(spark, [(1, "token=abcdef"), (2, "plain")]), documents(spark, [(3, "token=abcdef"), (4, "ghp_" + "z" * 36)])
    ledger = secrets.scan(old)
    more = secrets.scan(new, ledger)
    assert more.select("blob").distinct().count() == 1 and ledger.count() == 2 * len(secrets.RULES)
    assert {r.doc_id: r.spans for r in secrets.report(new, ledger.union(more)).collect()} == {3: "assign:0:12", 4: "github:0:40"}
    newer = (*secrets.RULES[:-1], secrets.Rule("slack", secrets.SLACK, version=2))
    assert secrets.scan(old, ledger, newer).groupBy("rule", "version").count().collect() == [("slack", 2, 2)]


# Personal data


def test_replacement(spark):
    texts = ODD + [(10, "Mail anna.smith@mail.org or +1 (415) 555-2671, again (415) 555-2671; card 4111 1111 1111 1111 and 4111111111111111."), (11, "Ask Anna Schmidt or Mr. Schmidt at 10.20.30.40; ssn 123-45-6789, iban GB82 WEST 1234 5698 7654 32"), (12, "ANNA.SMITH@MAIL.ORG")]
    df = documents(spark, texts)
    rows = pii.replace(df, "k", counts=True).collect()
    assert len(rows) == len(texts)
    got = {r.doc_id: r for r in rows if r.doc_id and r.doc_id >= 10}
    for i, t in texts:
        if i and i < 10:
            assert [r.text for r in rows if r.doc_id == i][0] == t
    a, b = got[10].text, got[11].text
    assert "555-2671" not in a and "4111" not in a and "anna.smith" not in a and "Anna" not in b and "10.20.30.40" not in b and "6789" not in b
    assert len(set(re.findall(r"\(\d{3}\) \d{3}-\d{4}", a))) == 1 and a.startswith("Mail ") and "+1 (" in a
    cards = [re.sub(r"\D", "", x) for x in re.findall(r"4\d{3} ?\d{4} ?\d{4} ?\d{4}", a)]
    assert len(cards) == 2 and len(set(cards)) == 1 and not pii.luhn(cards[0])
    names = re.match(r"Ask (\w+) (\w+) or Mr\. (\w+) at", b)
    assert names[2] == names[3] and pii.KIND[names[1].casefold()] == "given_f_latin"
    assert pii.mod97(re.search(r"iban (.*)$", b)[1].replace(" ", "")) == 1
    assert got[12].text == re.search(r"Mail (\S+)", a)[1].upper() and got[10].n_entities == 5 and got[10].n_chars == len(a)
    assert pii.replace(df, "k").columns == df.columns


def test_collisions_are_drawn_again(spark, monkeypatch):
    first = pii.draw
    monkeypatch.setattr(pii, "draw", lambda kind, value, key, attempt=0: "taken" if attempt == 0 else first(kind, value, key, attempt))
    df = spark.createDataFrame([("surname", "meier"), ("surname", "schulz"), ("surname", "taken")], "kind string, value string")
    got = {r.value: r.surrogate for r in pii.surrogates(df, b"k").collect()}
    assert set(got) == {"meier", "schulz", "taken"} and len(set(got.values())) == 3 and not set(got) & set(got.values())


def test_names_after_punctuation_and_again(spark):
    for text in ("(Anna Schmidt)", '"Anna Schmidt"', "[Anna Schmidt]", "by/Anna Schmidt", "\u2014Anna Schmidt", "name:Anna Schmidt"):
        assert [x[2:] for x in pii.detect(text)] == [("given_f_latin", "anna"), ("surname", "schmidt")]
    text = "Anna Schmidt came. Schmidt said so; SCHMIDT's car, not the Schmidts or a schmidt."
    assert [text[a:b] for a, b, *_ in pii.detect(text)] == ["Anna", "Schmidt", "Schmidt", "SCHMIDT"]
    (row,) = pii.replace(documents(spark, [(1, text)]), "k").collect()
    name = re.match(r"\w+ (\w+) came", row.text)[1]
    assert row.text.endswith(f"{name} said so; {name.upper()}'s car, not the Schmidts or a schmidt.") and name != "Schmidt"
    assert not pii.detect("XAnna Schmidt")


#: Names outside of every list, by script and form.
UNLISTED = [
    "Priya Raghunathan", "Wei Zhang", "Olumide Adeyemi", "Siobhan O'Connor", "Bjørn Ångström", "Jean-Luc Moreau", "Aiko Tanaka", "Fatima Zahra", "Ronaldo McDonald", "Zoë Vandenberg", "Łukasz Żak",
    "Kwame Nkrumah", "Thandiwe Mbeki", "Yiannis Papadopoulos", "Νίκος Παππάς", "Тимур Ахметов", "Гульнара Сафина", "Dmitro Kovalenko", "Chidi Okafor", "Ingeborg Lindqvist",
]
#: Sentences, and whether names are found in all of them.
CONTEXTS = [
    "yesterday we met {} at the station.", "{} said that it was late.", "the report was written by {} in spring.", "ask {} for help, please.", "My name is {}.", "Dear {},\nthank you for all.", "it was ({}) who came.", "they thanked {}, who left early.",
    "we saw Mr. {} there.", "author: {}\nno more.",
]


def test_names_outside_of_the_lists():
    found = total = 0
    for name in UNLISTED:
        for context in CONTEXTS:
            text = context.format(name)
            spans = pii.detect(text)
            total += 1
            covered = " ".join(text[a:b] for a, b, _, _ in spans)
            found += covered == name
    assert found / total >= 0.9, found / total
    for text in ("The House of Lords met in New York on Monday.", "Licensed under the Apache License, Version 2.0.", "We read the General Public License.", "no names here at all", "Big News From The Big City Today", "Er sah den Alten Mann im Haus am See und die Frau im Garten mit dem Hund an der Mauer."):
        assert not [x for x in pii.detect(text) if x[2] not in ("email",)], text


def test_coreference_case_and_distinctness(spark):
    """Generated texts with unseen names: equal names get equal surrogates in all texts, different ones different, none is real; format stays."""
    rng = np.random.default_rng(4)
    syllables = ["ka", "ro", "mi", "ze", "tu", "lo", "ne", "vi", "sha", "bro"]
    word = lambda: "".join(rng.choice(syllables, 3)).capitalize()
    people = sorted({(word(), word()) for _ in range(60)})
    texts = [(i, f"we met {a} {b} today. {b} left; {a.upper()} {b.upper()} came back, writes {a}.{b}@Example.COM") for i, (a, b) in enumerate(people)]
    texts += [(100 + i, f"they saw {a} {b} again.") for i, (a, b) in enumerate(people)]
    got = {r.doc_id: r.text for r in pii.replace(documents(spark, texts), "k").collect()}
    real = {x.casefold() for p in people for x in p}
    names = {}
    for i, (a, b) in enumerate(people):
        m = re.fullmatch(r"we met (\w+) (\w+) today\. (\w+) left; (\w+) (\w+) came back, writes (\S+)", got[i])
        assert m[3] == m[2] and m[4] == m[1].upper() and m[5] == m[2].upper() and got[100 + i] == f"they saw {m[1]} {m[2]} again."
        assert [c.isupper() for c in m[6]] == [c.isupper() for c in f"{a}.{b}@Example.COM"] and m[6] != f"{a}.{b}@Example.COM"
        assert names.setdefault(("g", a), m[1]) == m[1] and names.setdefault(("s", b), m[2]) == m[2]
    for kind in "gs":
        own = [v for (k, _), v in names.items() if k == kind]
        assert len(set(own)) == len(own) and not {x.casefold() for x in own} & real
    other = {r.doc_id: r.text for r in pii.replace(documents(spark, texts), "another key").collect()}
    assert sum(other[i] != got[i] for i in got) > 0.9 * len(got)


def test_small_formats_end(spark):
    """Twenty Cyrillic surnames of two letters, all listed given names, and all addresses of one-digit parts in a block: longer surrogates where the format is full."""
    rows = [("surname", a + b) for a in "абвг" for b in "аеиоу"] + [(f"given_{k}", n.casefold()) for k, v in pii.GIVEN.items() for n in v] + [("ip", f"1.1.{a}.{b}") for a in range(10) for b in range(10)] + [("surname", "αβ"), ("surname", "王")]
    got = pii.surrogates(spark.createDataFrame(rows, "kind string, value string"), b"k").collect()
    assert len(got) == len(set(rows))
    kind = lambda k: "given" if k.startswith("given") else k
    assert len({(kind(r.kind), r.surrogate) for r in got}) == len({(r.kind, r.value) for r in got})
    assert not {(kind(r.kind), r.surrogate) for r in got} & {(kind(k), v) for k, v in rows}


def test_replace_passes_all_columns(spark):
    df = documents(spark, [(1, "a@b.org"), (2, None), (2, None), (1, "a@b.org")])
    from pyspark.sql import functions as F

    for name in ("__told", "__new", "__key", "new", "n", "row", "some", "hash", "start", "n_entities"):
        df = df.withColumn(name, F.lit(name))
    got = pii.replace(df, "k").collect()
    assert len(got) == 4 and all(r[name] == name for r in got for name in ("__told", "__new", "__key", "key", "new", "n", "row", "some", "hash", "n_entities", "spans"))
    assert pii.replace(df, "k", counts=True).columns == [*(c if c != "n_entities" else "n_entities_kept" for c in df.columns), "n_entities"]
    assert pii.replace(df.where("false"), "k").count() == 0


def test_cards_in_any_grouping():
    numbers = {"378282246310005": (4, 6, 5), "30569309025904": (4, 6, 4), "4111111111111111": (4, 4, 4, 4), "6304000000000000000": (6, 13), "4222222222222": (4, 3, 3, 3)}
    for number, groups in numbers.items():
        number = number[:-1] + str(-pii.luhn(number[:-1] + "0") % 10)
        for sep in ("", " ", "-"):
            at = np.cumsum([0, *groups])
            card = sep.join(number[a:b] for a, b in zip(at, at[1:]))
            text = f"7 {card} 2024, {card}."
            assert [(text[a:b], k, v) for a, b, k, v in pii.detect(text) if k == "card"] == [(card, "card", number)] * 2
            assert not [x for x in pii.detect(f"x {card[:-1]}{(int(card[-1]) + 1) % 10} y") if x[2] == "card"]


@given(st.text(alphabet="a1@.- +()4", max_size=40))
@settings(max_examples=100, deadline=None)
def test_detection_is_ordered(text):
    found = pii.detect(text)
    assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))


# Language


def brute_marginals(s, trans):
    a, b = np.zeros_like(s), np.ones_like(s)
    e, t = np.exp(s), np.exp(trans)
    for i in range(len(s)):
        a[i] = e[i] * (a[i - 1] @ t if i else 1)
        a[i] /= a[i].sum()
    for i in range(len(s) - 2, -1, -1):
        b[i] = t @ (e[i + 1] * b[i + 1])
        b[i] /= b[i].sum()
    g = a * b
    return g / g.sum(axis=1, keepdims=True)


def test_marginals():
    rng = np.random.default_rng(0)
    first = np.array([0, 0, 1, 64, 65, 300, 300])
    s, t = rng.normal(size=(300, 3)) * 3, rng.normal(size=(3, 3))
    want = np.concatenate([brute_marginals(s[a:b], t) for a, b in zip(first, first[1:]) if b > a])
    assert np.abs(langid.marginals(s, first, t) - want).max() < 1e-9


def test_languages(spark):
    rng = np.random.default_rng(1)
    words = {"aa": "the and of with this from that".split(), "bb": "der die und nicht mit von das".split()}
    make = lambda k, n: " ".join(rng.choice(words[k], n))
    rows = [(i, make("aa" if i % 2 else "bb", 40), "aa" if i % 2 else "bb", "s", 0) for i in range(60)]
    train = spark.createDataFrame(rows + [(99, None, "aa", "s", 0), (98, "text", None, "s", 0)], DOCS)
    f = langid.fit(train)
    assert f.labels == ["aa", "bb"]
    odd = documents(spark, ODD + [(50, make("aa", 100)), (51, make("bb", 3000)), (52, make("aa", 20) + " " + make("bb", 60))])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, f).collect()}
    assert got[1] == got[2] == got[3] == got[8] == ("und", 0.0)
    assert got[50][0] == "aa" and got[51][0] == "bb" and got[52][0] == "bb" and got[50][1] > 0.9 and 0.5 < got[52][1] < 0.95
    names, _ = f.predict(pa.array([r[1] for r in rows]))
    assert names == [r[2] for r in rows]
    nothing = langid.fit(train.where("false"))
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    assert langid.predict(odd.where("false"), f).count() == 0


# Quality


def symbols(text):
    return [quality.START] * (quality.ORDER - 1) + [48 if chr(b) in "0123456789" else 32 if chr(b) in "\t\n\v\f\r" else b for b in (text or "").encode()] + [quality.END]


def brute_model(texts):
    """Interpolated modified Kneser-Ney in dictionaries."""
    o = quality.ORDER
    counts = [None] * (o + 1)
    top = {}
    for t in texts:
        c = symbols(t)
        for i in range(len(c) - o + 1):
            g = tuple(c[i : i + o])
            top[g] = top.get(g, 0) + 1
    counts[o] = top
    for k in range(o - 1, 0, -1):
        counts[k] = {}
        for g in counts[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1
    cost, total, free = {}, {}, {}
    for k in range(1, o + 1):
        n = [sum(v == i for v in counts[k].values()) for i in range(5)]
        if all(n[1:]):
            y = n[1] / (n[1] + 2 * n[2])
            d = [min(max(i + 1 - (i + 2) * y * n[i + 2] / n[i + 1], 0.05), i + 0.95) for i in range(3)]
        else:
            d = [0.5, 1.0, 1.5]
        for g, v in counts[k].items():
            cost[k, g] = min(d[min(v, 3) - 1], v)
            total[k, g[:-1]] = total.get((k, g[:-1]), 0) + v
            free[k, g[:-1]] = free.get((k, g[:-1]), 0) + cost[k, g]

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 256
        if (k, g[:-1]) not in total:
            return p(g[1:])
        v = counts[k].get(g, 0)
        return ((v - cost[k, g]) if v else 0) / total[k, g[:-1]] + free[k, g[:-1]] / total[k, g[:-1]] * p(g[1:])

    return p


def test_scores_against_brute_force(spark, monkeypatch):
    texts = ["the cat sat on the mat", "the dog sat on the log.", "a cat, a dog; 12 of them", "THE END", "über"] * 3 + ["one more line of words"]
    abuse = ["the cat is an idiot", "a dog sat on the idiot", "idiot"]
    others = [None, "", "a new text, with words that were not there", "日本語 \t\n 99", "the idiot sat", "x" * 300, "the cat sat on the mat"]
    rows = list(enumerate(texts + abuse + others))
    df = documents(spark, rows)
    ids = spark.createDataFrame([(i,) for i in range(len(rows))], "doc_id long")
    n, m = len(texts), len(texts) + len(abuse)
    monkeypatch.setattr(quality, "BLOCK", 100)  # many blocks
    model = quality.train(df, ids.where(f"doc_id < {n}"), ids.where(f"doc_id >= {n} and doc_id < {m}"))
    assert model.shards == 64
    monkeypatch.setattr(quality, "SENT", 0)  # labelled texts by a shuffle
    monkeypatch.setattr(quality, "ASKED", 0.1)  # three parts for each shard
    again = quality.train(df, ids.where(f"doc_id < {n}"), ids.where(f"doc_id >= {n} and doc_id < {m}"))
    for got in (quality.score(df, model).collect(), quality.score(df.repartition(5), again, ("doc_id", "lang", "fp")).collect()):
        assert len(got) == len(rows)
        clean, toxic = brute_model(texts), brute_model(abuse)
        for r in got:
            c = symbols(dict(rows)[r.doc_id])
            logs = [[np.log(p(tuple(c[i : i + quality.ORDER]))) for i in range(len(c) - quality.ORDER + 1)] for p in (clean, toxic)]
            assert r.perplexity == pytest.approx(np.exp(-np.mean(logs[0])), rel=2e-3)
            more = np.subtract(logs[1], logs[0])
            assert r.contrast == pytest.approx(max(more[max(0, i + 1 - quality.RUN) : i + 1].sum() for i in range(len(more))), abs=0.05)
    only = quality.train(df, ids.where(f"doc_id < {n}"), ids.where("false"))
    assert {r.contrast for r in quality.score(df, only).collect()} == {None}


def test_probabilities_sum_to_one(spark):
    df = documents(spark, [(1, "the cat sat on the mat and the dog sat on the log"), (2, "a cat and a dog")])
    ids = spark.createDataFrame([(1,), (2,)], "doc_id long")
    model = quality.train(df, ids, ids.where("false"))
    rows = model.counts.collect()
    for context in (b"the c", b" on t", b"zzzzz", b"a dog"):
        g = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256)], np.uint64)
        own = {r.model: (np.cumsum(quality.unpacked(r.grams, "<u8"), dtype=np.uint64), quality.unpacked(r.counts, "<i8")) for r in rows if r.shard == quality.shard_of(g, model.shards)[0]}
        assert np.exp(quality.Shard(own, model.discounts).logs(g, model.low).astype(float)).sum() == pytest.approx(1, abs=0.01)


def test_changed_sources_are_told():
    batch = pa.table({"doc_id": [1], "text": ["abc"]})
    g = np.unique(quality.grams(np.frombuffer(b"abc", np.uint8), np.array([0, 3]))[0])
    assert quality.unpacked(quality.packed(g), "<u8").tolist() == g.tolist()
    assert quality.from_ipc(quality.ipc(batch.to_batches()[0])).equals(batch)


def test_classifier(spark):
    good = [(i, "plain words in a row and more of them " * (1 + i % 3)) for i in range(20, 80)]
    bad = [(i, "plain words in a row and more of them, you idiot " + "plain words in a row " * 9) for i in range(100, 110)]
    df = documents(spark, ODD + good + bad + [(90, "Z#9*" * 60)])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 1, 1) for i, _ in bad[:6]] + [(90, 0, 0), (None, 1, 0), (20, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    assert len(got) == len({i for i, _ in ODD + good + bad}) + 1
    assert all(got[i].keep for i, _ in good) and not got[90].keep and not any(got[i].keep for i, _ in bad)
    assert all(r.keep for r in quality.classify(df, labels.where("false")).collect())
    assert quality.classify(df.where("false"), labels).count() == 0


# Decontamination


def brute_containment(text, item, width=5):
    w, q = ([x.decode() for x in decontaminate.tokens(t or "")] for t in (text, item))
    n = min(width, len(q))
    if not n:
        return 0.0
    grams = lambda x: {tuple(x[i : i + n]) for i in range(len(x) - n + 1)}
    return len(grams(q) & grams(w)) / len(grams(q))


def test_containment_against_brute_force(spark):
    rng = np.random.default_rng(0)
    word = lambda n: " ".join(rng.choice([f"w{i}" for i in range(60)], n))
    items = [(i, word(n)) for i, n in enumerate([1, 3, 5, 6, 9, 12, 30, 70, 200])] + [(20, None), (21, "..."), (22, "Dup, item! of many words here"), (22, "Dup, item! of many words here"), (None, "an item without any id at all")]
    texts = list(ODD)
    for k, (i, t) in enumerate(items):
        if t:
            w = t.split()
            texts.append((100 + k, word(200) + " " + t.upper() + ". " + word(50)))
            w[len(w) // 2] = "changed"
            texts.append((200 + k, word(40) + " " + " ".join(w)))
            texts.append((300 + k, " ".join(t.split()[: max(1, len(w) - 2)])))
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((d, i, round(c, 9)) for d, t in texts for i, q in items if (c := brute_containment(t, q)) >= 0.8), key=str)
    for block in (16 << 20, 200):
        got = sorted(((r.doc_id, r.item_id, round(r.containment, 9)) for r in decontaminate.matches(docs, bench, block_bytes=block).collect()), key=str)
        assert got == want
    bad = {d for d, _, _ in want}
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, _ in texts if d not in bad), key=str)
    assert decontaminate.matches(docs, bench.where("false")).count() == 0 and decontaminate.matches(docs.where("false"), bench).count() == 0


# Mixing


def brute_targets(sizes, weights, total, most):
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        level = total / sum(weights[i] for i in free)
        over = [i for i in free if level * weights[i] > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = level * weights[i]
            break
        for i in over:
            out[i] = most * sizes[i]
            total -= out[i]
            free.remove(i)
    return out


def test_targets(spark):
    for sizes in ([10, 100, 100], [1, 1, 1000, 5, 5, 5, 70, 2], [0, 0], [4]):
        names = [None if i == len(sizes) - 1 else f"é{i}" if i % 2 else f"a{i}" for i in range(len(sizes))]
        df = spark.createDataFrame(list(zip(names, sizes)), "src string, source_size long").repartition(3)
        got = sorted(mixing.with_targets(mixing.numbered(df), (3, 1, 2), 1.5, 2.0).collect(), key=lambda r: r.number)
        order = sorted(range(len(sizes)), key=lambda i: (names[i] is None, names[i]))
        assert [r.src for r in got] == [names[i] for i in order] and [r.number for r in got] == list(range(len(sizes)))
        want = brute_targets([sizes[i] for i in order], [(3, 1, 2)[k % 3] for k in range(len(sizes))], 1.5 * sum(sizes), 2.0)
        assert [r.target for r in got] == pytest.approx(want)


def test_splitting_tree():
    room = np.array([140 * (s + 1) // 16 - 140 * s // 16 for s in range(16)])
    got = list(mixing.split_tree(np.array([100, 7, 0, 33]), room, [3]))
    assert got == list(mixing.split_tree(np.array([100, 7, 0, 33]), room, [3]))
    assert [sum(n for i, _, n in got if i == k) for k in range(4)] == [100, 7, 0, 33]
    assert [sum(n for _, s, n in got if s == k) for k in range(16)] == room.tolist()


def test_draws_are_hypergeometric_at_any_number():
    rng = np.random.default_rng(11)
    counts, take = np.array([3, 1, 4]), 4
    ways = {(i, j, take - i - j): math.comb(3, i) * math.comb(1, j) * math.comb(4, take - i - j) for i in range(4) for j in range(2) if 0 <= take - i - j <= 4}
    seen = Counter(tuple(mixing.draw_part(rng, counts, take).tolist()) for _ in range(20000))
    assert set(seen) == set(ways)
    expected = {k: 20000 * n / math.comb(8, 4) for k, n in ways.items()}
    assert sum((seen[k] - e) ** 2 / e for k, e in expected.items()) < 30  # 6 degrees of freedom
    large, n = np.array([3 * 10**12, 10**12, 5, 0]), 10**12 + 7
    got = np.array([mixing.draw_part(rng, large, n) for _ in range(500)])
    assert (got.sum(axis=1) == n).all() and (got >= 0).all() and (got <= large).all()
    all_, share = int(large.sum()), 0.75
    spread = math.sqrt(n * share * (1 - share) * (all_ - n) / (all_ - 1))
    assert abs(got[:, 0].mean() - n * share) < 5 * spread / math.sqrt(500) and 0.85 < got[:, 0].std() / spread < 1.15


def test_the_tree_by_groups_of_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 4)
    quotas = [(i, 1 + 5 * i % 17) for i in range(23)]
    got = mixing.drawn(spark.createDataFrame(quotas, "number long, quota long"), 5, 1).collect()
    total = sum(q for _, q in quotas)
    assert {i: sum(r.copies for r in got if r.number == i) for i, _ in quotas} == dict(quotas)
    assert [sum(r.copies for r in got if r.shard == s) for s in range(5)] == [total * (s + 1) // 5 - total * s // 5 for s in range(5)]


def test_mix(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "w " * int(rng.integers(0, 60)), "en", [None, "a", "b", "c"][min(3, i % 7)], 0) for i in range(400)] + [(400, None, "en", "d", 0), (401, "", "en", None, 0), (5, "w " * 30, "en", "a", 0), (5, "w " * 30, "en", "a", 0), (None, "w w", "en", "a", 0)]
    df = spark.createDataFrame(rows, DOCS)
    for blocks in (1024, 4):
        got = mixing.assign(df, ("doc_id", "source"), blocks=blocks, shards=6).collect()
        assert len(got) == len(rows) and sum(r.taken for r in got) == pytest.approx(1.5 * sum(r.size for r in got), abs=3)
        for s in (None, "a", "b", "c", "d"):
            own = [r for r in got if r.source == s]
            assert sum(r.taken for r in own) == int(own[0].target + 0.5) and own[0].source_size == sum(r.size for r in own)
            assert own[0].target <= 2 * own[0].source_size + 1e-9
        # What is taken is what was drawn: whole documents, but for the cut block's last.
        assert all(0 <= r.taken <= 2 * r.size and r.taken == sum(d.words for d in r.draws) and all(0 <= d.shard < 6 for d in r.draws) for r in got)
        assert sum(0 < d.words < r.size for r in got for d in r.draws) <= 5
        again = mixing.assign(df.repartition(7), ("doc_id", "source"), blocks=blocks, shards=6).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mixture(df, ("doc_id", "text"), blocks=4, shards=6)
    assert sorted((r.doc_id or -1, r.shard, r.words) for r in mixed.collect()) == sorted((r.doc_id or -1, d.shard, d.words) for r in got for d in r.draws)
    assert mixing.assign(df.where("false")).count() == 0


def test_a_mix_keeps_columns_named_like_results(spark):
    df = spark.createDataFrame([(1, "a b", "x", 7, "t", 8), (2, "c", "x", 9, "u", 10)], "doc_id long, text string, source string, size long, taken string, size_kept long")
    got = sorted(mixing.assign(df, tuple(df.columns)).collect(), key=lambda r: r.doc_id)
    assert [(r.size, r.size_kept_kept, r.size_kept, r.taken_kept) for r in got] == [(2, 7, 8, "t"), (1, 9, 10, "u")]


def test_all_languages_are_learned(spark):
    rows = [(10 * k + i, f"w{k}x v{k}y u{k}z " * 4, f"l{k:02}") for k in range(70) for i in range(2)]
    f = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert f.labels == [f"l{k:02}" for k in range(70)]
    names, _ = f.predict(pa.array([rows[2 * k][1] for k in range(70)]))
    assert names == f.labels


def test_every_language_has_rows_to_learn_from_at_any_count(spark):
    counts = {"en": 10**10, "de": 3 * 10**8, "fr": 262_144_000, "es": 1000, "xx": 1}
    each, below = langid.thresholds(counts, 250, 64)
    expected = {k: n * (below[k] + 1) / 2**63 for k, n in counts.items()}
    assert each == 250 and all(expected[k] == pytest.approx(min(n, 2 * each + 100), rel=1e-6) for k, n in counts.items())
    many = {str(k): 10**9 for k in range(100_000)}
    each, below = langid.thresholds(many, 250, 64)
    assert each == 1 and all(10**9 * b / 2**63 > 100 for b in below.values())
    rows = [(7, f"aa bb cc {k} words of one repeated id", "en") for k in range(900)]
    assert langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string")).labels == ["en"]


def test_texts_without_spaces_are_learned_beyond_their_start(spark):
    rng = np.random.default_rng(2)
    make = lambda letters, n: "".join(rng.choice(list(letters), n))
    letters = {"aa": "\u4e00\u4e8c\u4e09\u56db", "bb": "\u0e01\u0e02\u0e04\u0e07"}
    rows = [(i, "z" * 64 + make(letters[lang], 1000), lang) for i, lang in enumerate(["aa", "bb"] * 20)]
    f = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    names, _ = f.predict(pa.array([make(letters[lang], 300) for lang in ("aa", "bb") * 5]))
    assert names == ["aa", "bb"] * 5
