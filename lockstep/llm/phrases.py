"""Phrases whose words occur together more often than apart, by contiguous pattern growth.

A text is cut into pieces at punctuation and line ends and pieces into words. Every word of a
piece is a pointer: the place where it and the words after it stand. A first pass counts words. A second sends
the pointers to shards by their first word, those of one window of text with equal words
summed beforehand. In a shard each frequent word's pointers are its projection: the growth counts the words
that follow, keeps frequent ones, projects the pointers on each and goes on to the right, depth first.

No word's projection has to fit in one shard. A word with more than a quarter of a shard's
places (or a millionth of all) is hot: its pointers are dealt by their second word too, and where that is hot as
well, by the third. Pairs of two hot words so have counts in several shards, which are summed afterwards; all
other counts are whole. What the driver and the workers hold are the hot words, 2^20 at most.

Nulls: a null text is empty, a null language is ``und``. Texts without words give nothing;
an empty table gives no rows. Repeated rows count as often as they occur. Other columns are ignored.
Of very long texts the words are taken in windows of ``WINDOW``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, U, kept_as_table, prefix_sums, range_hash, slices, stir, words

#: Bytes that end a piece, and those that end a word.
BREAKS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
INSIDE = ~BREAKS & ~np.isin(np.arange(256), list(b" \t"))
#: Words of one window: their numbers, and three of them side by side, fit into 63 bits.
WINDOW = 1 << 20
BITS = 21
ODD = U(0x9E3779B97F4A7C15)


def binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of these lengths that lie one after the other in data."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def hashes(values: pa.Array) -> np.ndarray:
    """64 bits of each string."""
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    data = np.frombuffer(values.buffers()[2], np.uint8)[: offsets[-1]] if len(values) else np.empty(0, np.uint8)
    return range_hash(prefix_sums(data), offsets[:-1], offsets[1:])


def windows(texts: Iterable[pa.Array], longest: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(the words of a window, numbers from 1 of each place's word and of those after it). Number 0: the piece has ended."""
    for text in texts:
        for _, _, data, offs in slices(text, 8 << 20):
            low = LOWER[data]
            starts, ends, first = words(low, offs, INSIDE)
            piece = np.cumsum(BREAKS[low], dtype=np.int64)[starts] + np.repeat(np.arange(len(offs) - 1), np.diff(first))
            for a in range(0, len(starts), WINDOW):
                b = min(len(starts), a + WINDOW)
                c = min(len(starts), b + longest - 1)
                part = low[starts[a] : ends[c - 1]]
                coded = binary(part[INSIDE[part]], ends[a:c] - starts[a:c]).dictionary_encode()
                number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
                places = np.zeros((longest, b - a), np.int64)
                places[0] = number[: b - a]
                for k in range(1, longest):
                    n = max(0, min(b - a, c - a - k))
                    same = piece[a : a + n] == piece[a + k : a + k + n]
                    places[k, :n] = np.where(same, number[k : k + n], 0)
                yield coded.dictionary, places


def by_language(batches: Iterable[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[tuple[str, list[pa.Array]]]:
    """Texts of each language, of about limit bytes together."""
    held: dict[str, list[pa.Array]] = {}
    size = 0
    for b in batches:
        langs = b.column("lang").dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            held.setdefault(lang, []).append(b.column("text").filter(pc.equal(langs.indices, k)))
        size += b.column("text").nbytes
        if size >= limit:
            yield from held.items()
            held, size = {}, 0
    yield from held.items()


def joined(arrays: list[pa.Array]) -> list[pa.Array]:
    return [pa.concat_arrays([x.cast(pa.large_string()) for x in arrays])]


def word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in by_language(batches):
        for found, places in windows(joined(texts), 1):
            n = np.bincount(places[0], minlength=len(found) + 1)[1:]
            yield pa.record_batch([pa.array([lang] * len(n), pa.string()), found.cast(pa.string()), pa.array(n, pa.int64())], ["lang", "phrase", "f"])


class Hot:
    """By language, words with many places and the number of groups that the words after them are dealt in."""

    def __init__(self, rows: Iterable[tuple[str, str, int]], unit: int):
        self.words: dict[str, pa.Array] = {}
        self.groups: dict[str, np.ndarray] = {}
        by: dict[str, list] = {}
        for lang, word, f in rows:
            by.setdefault(lang, []).append((word.encode(), -(-f // unit)))
        for lang, x in by.items():
            self.words[lang] = pa.array([w for w, _ in x], pa.large_binary())
            self.groups[lang] = np.array([g for _, g in x], np.int64)

    def of(self, lang: str, found: pa.Array) -> np.ndarray:
        """The groups of each word; 1 for all that are not hot."""
        if lang not in self.words or not len(found):
            return np.ones(len(found), np.int64)
        at = pc.index_in(found, self.words[lang])
        return np.where(at.is_valid().to_numpy(zero_copy_only=False), self.groups[lang][at.fill_null(0).to_numpy(zero_copy_only=False)], 1)


def shard_of(lang: str, places: np.ndarray, h: np.ndarray, groups: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each pointer. h, groups: of the window's words, by number."""
    mixed = stir(h[places[0]] + hashes(pa.array([lang.encode()], pa.large_binary()))[0])
    many = groups[places[0]]
    mixed = np.where(many > 1, stir(mixed + ODD * (U(1) + stir(h[places[1]]) % many.astype(U))), mixed)
    if len(places) > 2:
        both = np.where(groups[places[1]] > 1, np.minimum(many, groups[places[1]]), 1)
        mixed = np.where(both > 1, stir(mixed + ODD * (U(1) + stir(h[places[2]]) % both.astype(U))), mixed)
    return (mixed % U(shards)).astype(np.int64)


def distinct(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of all pointers with equal words, and their number."""
    code, used = places[0], 1
    for row in places[1:]:
        if used == 63 // BITS:
            code, used = np.unique(code, return_inverse=True)[1], 1
        code, used = code << BITS | row, used + 1
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return first, n


def pointers(batches: Iterable[pa.RecordBatch], hot: Hot, shards: int, longest: int) -> Iterator[pa.RecordBatch]:
    """(shard, lang, the words of each place in the pointers' order, counts): one row for a window's pointers to a shard."""
    for lang, texts in by_language(batches):
        for found, places in windows(joined(texts), longest):
            places = places[:, places[1] > 0]
            if not places.shape[1]:
                continue
            first, n = distinct(places)
            places = places[:, first]
            h, groups = np.append(U(0), hashes(found)), np.append(1, hot.of(lang, found))
            shard = shard_of(lang, places, h, groups, shards)
            order = np.argsort(shard, kind="stable")
            shard, places, n = shard[order], places[:, order], n[order].astype(np.int32)
            at = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
            named = pa.concat_arrays([pa.array([b""], pa.large_binary()), found])
            lists = [pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), named.take(pa.array(row)).cast(pa.binary())), b"\n") for row in places]
            bodies = pa.array(list(zip(*(x.to_pylist() for x in lists))), pa.list_(pa.binary()))
            counts = [n[a:b].tobytes() for a, b in zip(at, at[1:])]
            yield pa.record_batch([pa.array(shard[at[:-1]]), pa.array([lang] * len(counts), pa.string()), bodies, pa.array(counts, pa.binary())], ["shard", "lang", "words", "counts"])


def read_words(bodies: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Number of each word, the words by number, and whether a number stands for no word."""
    data = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
    stops = np.flatnonzero(data == 10)
    coded = binary(data[data != 10], np.diff(stops, prepend=-1) - 1).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, pc.equal(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)


class Growth:
    """The projections of one language's frequent words in one shard."""

    def __init__(self, lang: str, rows: list[tuple[list[bytes], bytes]], hot: Hot, least: int):
        self.columns, self.names, self.blank = zip(*(read_words([r[0][k] for r in rows]) for k in range(len(rows[0][0]))))
        self.n = np.concatenate([np.frombuffer(r[1], np.int32) for r in rows]).astype(np.int64)
        self.hot = [hot.of(lang, x) > 1 for x in self.names[:2]]
        self.least = least

    def all(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """(words, occurrences) of frequent phrases; the counts of two hot words are parts of theirs and all told."""
        yield from self.extended((), np.arange(len(self.n)), 0, False)

    def extended(self, prefix: tuple[bytes, ...], projected: np.ndarray, depth: int, split: bool) -> Iterator[tuple[tuple[bytes, ...], int]]:
        word = self.columns[depth][projected]
        order = np.argsort(word, kind="stable")
        word, projected = word[order], projected[order]
        at = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        total = np.add.reduceat(self.n[projected], at)
        at, word = np.append(at, len(projected)), word[at]
        hot = self.hot[depth][word] if depth < 2 else np.zeros(len(word), bool)
        told = (total >= self.least) | (hot if depth == 0 else hot & split)
        for i in np.flatnonzero(told & ~self.blank[depth][word]).tolist():
            phrase = (*prefix, self.names[depth][int(word[i])].as_py())
            if depth:
                yield phrase, int(total[i])
            if depth + 1 < len(self.columns):
                yield from self.extended(phrase, projected[at[i] : at[i + 1]], depth + 1, bool(hot[i]))


def grown(batches: Iterable[pa.RecordBatch], hot: Hot, least: int) -> Iterator[pa.RecordBatch]:
    def told(held):
        by: dict[str, list] = {}
        for lang, bodies, n in held:
            by.setdefault(lang, []).append((bodies, n))
        for lang, rows in by.items():
            found = list(Growth(lang, rows, hot, least).all())
            phrases = pa.array([b" ".join(p) for p, _ in found], pa.binary()).cast(pa.string())
            yield pa.record_batch([pa.array([lang] * len(found), pa.string()), phrases, pa.array([len(p) for p, _ in found], pa.int32()), pa.array([f for _, f in found], pa.int64())], ["lang", "phrase", "size", "f"])

    held, last = [], None
    for b in batches:
        for shard, lang, bodies, n in zip(*(b.column(c).to_pylist() for c in ("shard", "lang", "words", "counts"))):
            if shard != last and held:
                yield from told(held)
                held = []
            last = shard
            held.append((lang, bodies, n))
    if held:
        yield from told(held)


def frequent(docs: DataFrame, least: int = 10, longest: int = 3, shard_places: int = 1 << 21) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all words, and (lang, phrase, size, f) of all phrases of 2 to longest words with f >= least."""
    session = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(word_counts, "lang string, phrase string, f long")
    known = kept_as_table(counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "phrase-words")
    total = known.agg(F.sum("f")).first()[0] or 0
    parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), total // (4 * shard_places))
    shards = 4 * parts
    unit = max(least, shard_places // 4, total >> 20)
    hot = Hot(known.where(F.col("f") > unit).toLocalIterator(), unit)
    sent = texts.mapInArrow(lambda b: pointers(b, hot, shards, longest), "shard long, lang string, words array<binary>, counts binary")
    found = sent.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(lambda b: grown(b, hot, least), "lang string, phrase string, size int, f long")
    whole = found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return known, kept_as_table(whole, "phrase-counts")


def subphrases(size: int, shortest: int) -> list[tuple[int, int]]:
    return [(i, n) for n in range(shortest, size) for i in range(size - n + 1)]


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, cover: int = 50, top: int = 2000, salts: int = 64, **options) -> DataFrame:
    """Each language's first top phrases: lang, rank, phrase, a, l, r, n, score.

    a: occurrences of the phrase; l, r: those of its two parts, cut where
    floor(1000000 a a / (l r)), the score, is least (then after the fewest words); n: the language's words. Phrases that mostly
    (cover per cent) occur inside a longer one are left out.
    """
    known, found = frequent(docs, least, longest, **options)
    part = F.split("phrase", " ")
    join = lambda i, n: F.array_join(F.slice(part, i, n), " ")
    counts = known.where(F.col("f") >= least).unionByName(found.select("lang", "phrase", "f"))
    cuts = F.expr("explode(sequence(1, size - 1))").alias("k")
    halves = found.select("lang", "phrase", "size", F.col("f").alias("a"), cuts).select("lang", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("left"), join(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    scored = (
        halves.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .withColumn("score", F.expr("cast(a as decimal(19, 0)) * cast(a as decimal(19, 0)) * 1000000bd div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    )
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = [F.when(F.col("size") == s, F.array(*(join(F.lit(i + 1), F.lit(n)) for i, n in subphrases(s, 2)))) for s in range(3, longest + 1)]
    if inner:
        longer = found.where("size > 2").select("lang", F.explode(F.coalesce(*inner)).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        best = best.join(longer, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {cover} * a"))
    rows = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    few = salted
    for groups in (salts, -(-salts // 8)):  # the last window so reads some times top rows of a language
        few = few.withColumn("salt", F.col("salt") % groups).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    sizes = known.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
