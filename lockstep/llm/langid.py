"""Language identification with a linear-chain conditional random field over words.

Every word with a letter gets scores from affixes, byte n-grams within the word, and a lexicon of frequent
training words; learned transitions join neighbours, and forward-backward gives each word's
label probabilities, so parts in other languages are labelled as such. A text's language is the
label with the highest mean probability over its words, and its score that mean.

Forward-backward runs over whole texts in slices of many texts: words are cut into blocks of
``BLOCK``, the blocks' transfer matrices are chained along each text, and then all blocks run side by side.
So a very long text takes as many steps as its number of blocks.

The field is fitted on about ``per_label`` documents of each language, of all languages there are; beyond ``full_labels``
languages each gets fewer, so that the sample stays bounded. ``words_each`` words of each document are taken, from runs all over
the text, and words beyond ``PIECE`` characters count as words of that length (this bounded sample is the only one here); sequences splice runs of several documents, which is what teaches transitions.
The sample depends on ids and rates only, not on partitions. Prediction is map-only: no shuffle.

Nulls: a null text, or one without a letter, is ``und`` with score 0; null ids and sources are carried; null
languages are not learned. With nothing to learn from, all is ``und``. Repeated rows give repeated results.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, SLICE, SOLID, U, kept_names, prefix_sums, range_hash, slices, words

BLOCK, RUN, PIECE = 64, 16, 64
TRI, PRE, SUF, LEX = 1 << 15, 1 << 14, 1 << 14, 1 << 16
AT = np.cumsum([0, 1 << 16, TRI, PRE, SUF])
SIZE = int(AT[-1] + LEX)
ALPHA = np.array([i >= 128 or chr(i).isalpha() for i in range(256)])
MIX = np.uint32(2654435761)


class Features:
    """Feature numbers of the words with letters in a buffer."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lexicon: np.ndarray | None):
        data = LOWER[data]
        starts, ends, first = words(data, offs, SOLID)
        has = np.concatenate([[0], np.cumsum(ALPHA[data])])
        keep = has[ends] > has[starts]
        self.first = np.concatenate([[0], np.cumsum(keep)])[first]
        self.starts, self.ends = starts[keep], ends[keep]
        clean = np.full(len(data) + 3, 32, np.uint8)
        clean[1:-2] = np.where(SOLID[data], data, 32)
        wide = clean.astype(np.uint32)
        self.bi = (wide[:-1] << np.uint32(8) | wide[1:])[: len(data) + 2]  # clean positions are one higher
        three = wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]
        self.tri = (three * MIX) >> np.uint32(17)
        at = self.starts
        self.pre = (three[at + 1] * MIX ^ wide[at + 1] * np.uint32(97)) >> np.uint32(18) if len(at) else at
        self.suf = (three[np.maximum(self.ends - 2, 0)] * MIX) >> np.uint32(18) if len(at) else at
        self.hash = range_hash(prefix_sums(data), self.starts, self.ends) if len(at) else np.empty(0, U)
        self.lex = np.zeros(len(at), np.int64)
        if lexicon is not None and len(lexicon) and len(at):
            p = np.minimum(np.searchsorted(lexicon, self.hash), len(lexicon) - 1)
            self.lex = np.where(lexicon[p] == self.hash, p % (LEX - 1) + 1, 0)

    def scores(self, w: np.ndarray) -> np.ndarray:
        """Sum of weights of each word, by label."""
        n = len(self.tri)
        each = w[self.bi[:n]] + w[AT[1] + self.tri.astype(np.int64)]
        total = np.zeros((n + 1, w.shape[1]))
        np.cumsum(each, axis=0, out=total[1:])
        lo, hi = self.starts, np.minimum(self.ends, n)  # windows from the space before the word to its end
        return total[hi] - total[lo] + w[AT[2] + self.pre.astype(np.int64)] + w[AT[3] + self.suf.astype(np.int64)] + w[AT[4] + self.lex]

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """All (feature, word) pairs."""
        n = len(self.tri)
        hi = np.minimum(self.ends, n)
        count = hi - self.starts
        word = np.repeat(np.arange(len(count)), count)
        pos = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.starts, count)
        ids = np.arange(len(count))
        return np.concatenate([self.bi[pos].astype(np.int64), AT[1] + self.tri[pos].astype(np.int64), AT[2] + self.pre.astype(np.int64), AT[3] + self.suf.astype(np.int64), AT[4] + self.lex]), np.concatenate([word, word, ids, ids, ids])


def marginals(scores: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Label probabilities of every word; first bounds the words of each text."""
    n, k = scores.shape
    if not n:
        return scores
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(trans - trans.max())
    count = np.diff(first)
    nb = -(-count // BLOCK)
    block_first = np.concatenate([[0], np.cumsum(nb)])
    total = int(block_first[-1])
    text = np.repeat(np.arange(len(count)), nb)
    number = np.arange(total) - block_first[text]
    at = first[text] + number * BLOCK
    place = at[:, None] + np.arange(BLOCK)
    real = place < first[text + 1][:, None]
    eb = np.where(real[:, :, None], e[np.minimum(place, n - 1)], 1.0)
    start = np.full((k, k), 1.0 / k)
    step = np.broadcast_to(a, (total, k, k)).copy()
    step[number == 0] = start
    eye = np.eye(k)

    def matrix(t):
        if t == 0:
            return step
        return np.where(real[:, t, None, None], a, eye)

    m = np.broadcast_to(eye, (total, k, k))
    for t in range(BLOCK):
        if not real[:, t].any():
            break
        m = np.matmul(m, matrix(t)) * eb[:, t, None, :]
        m = m / m.sum(axis=(1, 2), keepdims=True)
    fore, back = np.full((total, k), 1.0 / k), np.ones((total, k))
    most = int(nb.max(initial=0))
    for j in range(1, most):
        now = block_first[:-1][nb > j] + j
        v = np.matmul(fore[now - 1][:, None, :], m[now - 1])[:, 0]
        fore[now] = v / v.sum(axis=1, keepdims=True)
    for j in range(most - 2, -1, -1):
        now = block_first[:-1][nb > j + 1] + j
        v = np.matmul(m[now + 1], back[now + 1][:, :, None])[:, :, 0]
        back[now] = v / v.sum(axis=1, keepdims=True)
    alphas = np.empty((total, BLOCK, k))
    v = fore
    for t in range(BLOCK):
        v = (np.matmul(v[:, None, :], matrix(t))[:, 0]) * eb[:, t]
        v = v / v.sum(axis=1, keepdims=True)
        alphas[:, t] = v
    out = np.empty((total, BLOCK, k))
    v = back
    for t in range(BLOCK - 1, -1, -1):
        out[:, t] = alphas[:, t] * v
        v = np.matmul(matrix(t), (eb[:, t] * v)[:, :, None])[:, :, 0]
        v = v / v.sum(axis=1, keepdims=True)
    gamma = out[real]
    return gamma / gamma.sum(axis=1, keepdims=True)


class Field:
    """A fitted field: labels, feature weights, transitions, and the lexicon's word hashes."""

    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray, lexicon: np.ndarray):
        self.labels, self.weights, self.trans, self.lexicon = labels, weights, trans, lexicon

    @classmethod
    def fit(cls, runs: list[tuple[str, str]], labels: list[str], epochs: int = 6, batch: int = 256, rate: float = 0.3, length: int = 32, frequent: int = 3, seed: int = 5) -> Field:
        """runs: (label, text of a run of words), in a fixed order."""
        rng = np.random.default_rng(seed)
        number = {x: i for i, x in enumerate(labels)}
        order = rng.permutation(len(runs))
        texts = [runs[i][1] for i in order]
        data = np.frombuffer(" ".join(texts).encode(), np.uint8)
        f = Features(data, np.array([0, len(data)]), None)
        # One long sequence of spliced runs, then cut to equal lengths.
        hashes, counts = np.unique(f.hash, return_counts=True)
        lexicon = hashes[counts >= frequent][: LEX - 1]
        f = Features(data, np.array([0, len(data)]), lexicon)
        ends = np.cumsum([len(t.encode()) + 1 for t in texts])
        y = np.array([number[runs[i][0]] for i in order])[np.searchsorted(ends, f.starts, "right")] if len(f.starts) else np.empty(0, int)
        k, n = len(labels), len(y) // length
        w, trans = np.zeros((SIZE, k)), np.zeros((k, k))
        gw, gt = np.full((SIZE, k), 1e-6), np.full((k, k), 1e-6)
        ids, word = f.flat()
        sort = np.argsort(word, kind="stable")
        ids, word = ids[sort], word[sort]
        for _ in range(epochs):
            for at in range(0, n, batch):
                lo, hi = at * length, min(n, at + batch) * length
                a, b = np.searchsorted(word, [lo, hi])
                i, p = ids[a:b], word[a:b] - lo
                s = np.stack([np.bincount(p, w[i, c], hi - lo) for c in range(k)], axis=1).reshape(-1, length, k)
                e = np.exp(s - s.max(axis=2, keepdims=True))
                m = np.exp(trans - trans.max())
                yy = y[lo:hi].reshape(-1, length)
                fore, scale = np.empty_like(e), None
                v = e[:, 0]
                fore[:, 0] = v / v.sum(axis=1, keepdims=True)
                for t in range(1, length):
                    v = (fore[:, t - 1] @ m) * e[:, t]
                    fore[:, t] = v / v.sum(axis=1, keepdims=True)
                back = np.ones_like(e)
                pair = np.zeros((k, k))
                for t in range(length - 2, -1, -1):
                    right = e[:, t + 1] * back[:, t + 1]
                    joint = fore[:, t, :, None] * m * right[:, None, :]
                    pair += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                    v = right @ m.T
                    back[:, t] = v / v.sum(axis=1, keepdims=True)
                gamma = fore * back
                gamma /= gamma.sum(axis=2, keepdims=True)
                g = (np.eye(k)[yy] - gamma).reshape(-1, k)
                grad = np.stack([np.bincount(i, g[p, c], SIZE) for c in range(k)], axis=1) / len(yy)
                told = np.zeros((k, k))
                np.add.at(told, (yy[:, :-1].ravel(), yy[:, 1:].ravel()), 1)
                tgrad = (told - pair) / len(yy)
                grad -= 1e-5 * w
                gw += grad**2
                gt += tgrad**2
                w += rate * grad / np.sqrt(gw)
                trans += rate * tgrad / np.sqrt(gt)
        return cls(labels, w.astype(np.float32), trans, lexicon)

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        names, values = [], []
        # The transfer matrices grow with the square of the labels: slices get smaller beyond 16.
        for a, b, data, offs in slices(texts, SLICE * 256 // max(256, len(self.labels) ** 2)):
            f = Features(data, offs, self.lexicon)
            gamma = marginals(f.scores(self.weights), f.first, self.trans) if self.labels else np.zeros((len(f.starts), 0))
            total = np.zeros((len(gamma) + 1, len(self.labels)))
            np.cumsum(gamma, axis=0, out=total[1:])
            count = np.diff(f.first)
            mean = (total[f.first[1:]] - total[f.first[:-1]]) / np.maximum(count, 1)[:, None]
            best = mean.argmax(axis=1) if self.labels else np.zeros(len(count), int)
            lettered = np.concatenate([[0], np.cumsum((data | 32) - 97 < 26)])
            ascii_letters = lettered[offs[1:]] > lettered[offs[:-1]]
            for r in range(b - a):
                known = self.labels and count[r] and (ascii_letters[r] or any(c.isalpha() for c in texts[a + r].as_py() or ""))
                names.append(self.labels[best[r]] if known else "und")
                values.append(min(1.0, float(mean[r, best[r]])) if known else 0.0)
        return names, values


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def thresholds(counts: dict[str, int], per_label: int, full_labels: int) -> tuple[int, dict[str, int]]:
    """How many documents of each label are drawn, and below which hash of 63 bits a label's documents are candidates: some more than that, however many there are."""
    each = max(1, int(per_label * min(1.0, full_labels / max(1, len(counts)))))
    return each, {label: min((1 << 63) - 1, ((2 * each + 100) << 63) // n) for label, n in counts.items()}


def fit(docs: DataFrame, per_label: int = 250, words_each: int = 128, full_labels: int = 64) -> Field:
    """The field learned from docs (text, lang, doc_id), of which a bounded sample is taken to the driver.

    Of each label the documents with the least hashes of id and text are drawn: per_label of them, or fewer beyond full_labels labels, but always one.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return Field([], np.zeros((SIZE, 0), np.float32), np.zeros((0, 0)), np.empty(0, U))
    labels = sorted(counts)
    each, below = thresholds(counts, per_label, full_labels)
    limits = docs.sparkSession.createDataFrame(list(below.items()), "lang string, below long")
    drawn = known.select("doc_id", "lang", "text", F.shiftrightunsigned(F.xxhash64(F.lit(9), "doc_id", "text"), 1).alias("hash")).join(F.broadcast(limits), "lang").where("hash <= below")
    drawn = drawn.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id", "text"))).where(F.col("place") <= each)

    def runs(batches):
        for b in batches:
            rows = []
            for i, lang, text in zip(b.column("doc_id").to_pylist(), b.column("lang").to_pylist(), b.column("text").to_pylist()):
                t = [w[k : k + PIECE] for w in text.split() for k in range(0, len(w), PIECE)]
                rng = np.random.default_rng(zlib.crc32(str(i).encode()))
                at = np.arange(0, len(t), RUN)
                for s in sorted(rng.permutation(at)[: words_each // RUN].tolist()):
                    rows.append((zlib.crc32(f"{i}:{s}".encode()), lang, " ".join(t[s : s + RUN])))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], ["rank", "lang", "run"])

    found = drawn.select("doc_id", "lang", "text").mapInArrow(runs, "rank long, lang string, run string").toArrow().to_pydict()
    rows = sorted(zip(found["rank"], found["lang"], found["run"]))
    return Field.fit([(lang, run) for _, lang, run in rows if run], labels)


def told_by(field: Field, session) -> Callable[[str], Column]:
    """A function from a column's name to the prediction for its texts: a struct of lang_pred and score."""
    sent = session.sparkContext.broadcast((field.labels, field.weights, field.trans, field.lexicon))

    def tell(texts: pa.Array) -> pa.Array:
        names, values = Field(*sent.value).predict(texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())], ["lang_pred", "score"])

    return F.arrow_udf(tell, "struct<lang_pred:string,score:double>")


def predict(docs: DataFrame, field: Field) -> DataFrame:
    """docs with lang_pred and score; columns that have these names get _kept added to theirs."""
    names = kept_names(docs.columns, ("lang_pred", "score"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`").alias(n) for c, n in names.items())).alias("row"), told_by(field, docs.sparkSession)("text").alias("told"))
    return rows.select("row.*", "told.*")


def confident(docs: DataFrame, field: Field, least: float) -> DataFrame:
    """The rows of docs, unchanged, whose language is known with a score of at least least."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), told_by(field, docs.sparkSession)("text").alias("told"))
    return rows.where((F.col("told.lang_pred") != "und") & (F.col("told.score") >= least)).select("row.*")
