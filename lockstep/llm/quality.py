"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over n-grams of ``ORDER`` bytes (digits are one symbol, as are whitespace characters; a text ends with a symbol of its
own), kept exactly, in 48 bits. Its counts grow with the trusted text. A task sums its counts before they are
shuffled, packed, to shards, by the two bytes before an n-gram's last. All that the orders from the third on need, continuation
counts, context totals and interpolation, is then within a shard; shards tell counts of counts, of which the discounts of all are made, and
counts of pairs of bytes, from which the two lowest orders (2^16 entries) are made and sent to all.

Scoring joins every document's n-grams with the sharded counts. A task cuts its documents into blocks of about ``BLOCK`` bytes
and asks for a block's distinct n-grams once, packed by shard; a shard gives their interpolated probabilities. Answers go back to the block, which
travels compressed, and every whole text is scored there. A shard has several parts, each with the shard's
counts, where many blocks ask, so no part answers more than about ``ASKED`` requests.
A block is named by a hash of what it holds, and one that finds an answer missing fails its task, so a repeated task over a source that gives
other rows never yields a wrong score.

The same is done with the text of documents labelled toxic, whose counts are joined beside. The contrast of a document is the most by which
the second model's log-probability exceeds the first's over ``RUN`` bytes in a row: abuse that only toxic documents hold stands out
in a long text whose perplexity it leaves as it was.

A document is kept if its perplexity is at most its language's ``quantile`` of trusted documents' perplexity times
``slack``, and its contrast at most its language's quantile of theirs plus ``margin``; languages without trusted documents use
those of all languages. The quantiles are those of trusted documents that the model did not learn from.

Shuffles: packed counts; packed requests and answers; compressed blocks. Labelled ids are sent to all tasks if they are ``SENT`` at
most; beyond, the texts that a bit array of 8 MB lets pass are shuffled by id. The quantiles are mergeable sketches.
Nulls: a null or empty text has one n-gram, the end, and its perplexity; a null language uses the
overall thresholds; null ids match no label. Repeated labels count once; a document with both kinds is not trusted. Repeated rows
repeat their results. Without trusted text, all probabilities are uniform and all documents are kept; without toxic text no contrast is
told (null) or required. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U, cut, kept_as_table, sieve, slices, stir

ORDER, LOW = 6, 2
START, END = 0xFF, 0xFE  # bytes that UTF-8 has not
#: Bytes of text in a block, of all text for each shard of the counts, and requests that a part answers.
BLOCK, SHARD, ASKED = 16 << 20, 1 << 28, 16_000_000
#: Labelled ids that are sent to all tasks (9 bytes each) instead of shuffling their texts.
SENT = 4_000_000
RUN = 8
FOLD = np.array([48 if 48 <= i <= 57 else 32 if i in (9, 10, 11, 12, 13) else i for i in range(256)], np.uint8)
MODELS = ("trusted", "toxic")


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that end at each byte and at each text's end, as numbers, and the first of each text."""
    k, pad = len(offs) - 1, ORDER - 1
    size = np.diff(offs)
    at = np.arange(len(data)) + np.repeat(np.arange(k), size) * (pad + 1) + pad
    symbol = np.full(len(data) + k * (pad + 1), START, np.uint8)
    symbol[at] = FOLD[data]
    first = offs[:-1] + np.arange(k) * (pad + 1)
    symbol[first + pad + size] = END
    out = symbol.astype(U)
    for j in range(1, ORDER):
        out[j:] |= symbol[:-j].astype(U) << U(8 * j)
    real = np.ones(len(symbol), bool)
    for j in range(pad):
        real[first + j] = False
    return out[real], offs + np.arange(k + 1)


def shard_of(g: np.ndarray, shards: int) -> np.ndarray:
    """The shard of n-grams: by the two bytes before the last."""
    return (stir((g >> U(8)) & U(0xFFFF)) % U(shards)).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """Numbers, with equal bytes of all beside each other, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes(), 1)


def unpacked(body: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(body), np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What is taken off counts of one, two, and more, from how many n-grams have counts of one to four."""
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]  # too few counts to estimate
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]


def few(n: np.ndarray) -> np.ndarray:
    """How many of the counts are one, two, three and four."""
    return np.bincount(np.minimum(n, 5), minlength=6)[1:5]


def levels(g: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(order, n-grams, counts) of sorted n-grams, and below them continuation counts: in how many n-grams of the next order one ends.

    Down to the third order all n-grams that count for another are in its shard.
    """
    for order in range(ORDER, LOW, -1):
        yield order, g, n
        g, n = np.unique(g & U((1 << (8 * order - 8)) - 1), return_counts=True)


def smoothed(n: np.ndarray, context: np.ndarray, d: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own probabilities of n-grams with counts n, where each of the sorted contexts starts, and the weights of the lower order after them."""
    cost = np.minimum(np.array(d)[np.minimum(n, 3) - 1], n)
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    total, free = np.add.reduceat(n, first), np.add.reduceat(cost, first)
    return (n - cost) / np.repeat(total, np.diff(np.r_[first, len(n)])), first, free / total


def low_order(n: np.ndarray) -> np.ndarray:
    """Probabilities of a byte after another, from the continuation counts of all 2^16 pairs."""
    p = np.full(1, 1.0 / 256)
    for order, count in ((1, (n.reshape(256, 256) > 0).sum(axis=0)), (2, n)):
        used = np.flatnonzero(count)
        own, weight = np.zeros(len(count)), np.ones(len(count) >> 8)
        if len(used):
            x, first, w = smoothed(count[used], used >> 8, discounts(*few(count[used])))
            own[used], weight[used[first] >> 8] = x, w
        p = own + np.repeat(weight, 256) * p[np.arange(len(own)) & (len(p) - 1)]
    return p


COUNTS = "shard long, model int, kind string, grams binary, counts binary"


def distinct(g: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers."""
    g = np.sort(g)
    return g[np.r_[True, g[1:] != g[:-1]]] if len(g) else g


def summed(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers, and the sums of what is beside each."""
    order = np.argsort(g)
    g, n = g[order], n[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    return g[first], np.add.reduceat(n, first)


def counted(texts: DataFrame, shards: int, flush: int = 1 << 22) -> DataFrame:
    """Counts of the n-grams of texts (model, text) by shard and model, and of kind "few" and "pairs" what shards know of the counts of counts and of pairs of bytes.

    A task sends an n-gram once for each flush of them; a shard's counts are merged about a million at a time.
    """
    schema = pa.schema([("shard", pa.int64()), ("model", pa.int32()), ("kind", pa.string()), ("grams", pa.binary()), ("counts", pa.binary())])

    def row(shard, model, kind, g, n):
        return pa.record_batch([pa.array([shard], pa.int64()), pa.array([model], pa.int32()), pa.array([kind]), pa.array([packed(np.diff(g, prepend=U(0)))], pa.binary()), pa.array([packed(n.astype("<i8"))], pa.binary())], schema=schema)

    def count(batches):
        def tell(model, held):
            g, n = np.unique(np.concatenate(held), return_counts=True)
            shard = shard_of(g, shards)
            order = np.argsort(shard, kind="stable")
            g, n, shard = g[order], n[order], shard[order]
            edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
            for a, z in zip(edge, edge[1:]):
                yield row(int(shard[a]), model, "counts", g[a:z], n[a:z])

        held, size = [[] for _ in MODELS], [0 for _ in MODELS]
        for b in batches:
            model = np.asarray(b.column("model"))
            for m in range(len(MODELS)):
                for _, _, data, offs in slices(b.filter(pa.array(model == m)).column("text")):
                    held[m].append(grams(data, offs)[0])
                    size[m] += len(held[m][-1])
                    if size[m] >= flush:
                        yield from tell(m, held[m])
                        held[m], size[m] = [], 0
        for m, x in enumerate(held):
            if x:
                yield from tell(m, x)

    def merge(batches):
        def tell(key, held):
            g, n = summed(*(np.concatenate(x) for x in zip(*held)))
            yield row(*key, "counts", g, n)
            of = np.zeros((ORDER + 1, 4), np.int64)
            for order, h, k in levels(g, n):
                of[order] = few(k)
            yield row(*key, "few", np.zeros(of.size, U), of.reshape(-1))
            pairs, n = np.unique(h & U(0xFFFF), return_counts=True)  # h: the third order
            yield row(*key, "pairs", pairs, n)

        key, held, size = None, [], 0
        for b in batches:
            for shard, model, _, g, n in zip(*(b.column(c).to_pylist() for c in schema.names)):
                if (shard, model) != key and held:
                    yield from tell(key, held)
                    held, size = [], 0
                key = shard, model
                held.append((np.cumsum(unpacked(g, "<u8"), dtype=U), unpacked(n, "<i8")))
                size += len(held[-1][0])
                if size > 1 << 20:
                    held, size = [summed(*(np.concatenate(x) for x in zip(*held)))], 0
        if held:
            yield from tell(key, held)

    rows = texts.mapInArrow(count, COUNTS).repartition(shards, "shard").sortWithinPartitions("shard", "model")
    return kept_as_table(rows.mapInArrow(merge, COUNTS), "counts")


@dataclass
class Model:
    """Counts by shard (shard, model, grams, counts), the number of shards, and for each model the discounts by order and the probabilities of pairs."""

    counts: DataFrame
    shards: int
    discounts: list[list[list[float]]]
    low: list[np.ndarray]


class Shard:
    """The orders above LOW of a shard: for each model and order the n-grams, their own probabilities, the contexts and their weights."""

    def __init__(self, counts: dict[int, tuple[np.ndarray, np.ndarray]], d: list[list[list[float]]]):
        self.of = {}
        for m, (g, n) in counts.items():
            for order, h, k in levels(g, n):
                own, first, weight = smoothed(k, h >> U(8), d[m][order])
                self.of[m, order] = h, own, (h >> U(8))[first], weight

    def logs(self, g: np.ndarray, low: list[np.ndarray]) -> np.ndarray:
        """Natural logarithms of each model's probability of n-grams, as rows."""
        out = np.empty((len(low), len(g)), np.float16)
        for m, p in enumerate(low):
            p = p[(g & U(0xFFFF)).astype(np.int64)]
            for k in range(LOW + 1, ORDER + 1):
                if (m, k) not in self.of:
                    continue
                grams_, own, contexts, weight = self.of[m, k]
                now = g & U((1 << (8 * k)) - 1)
                at = np.minimum(np.searchsorted(grams_, now), len(grams_) - 1)
                a = np.where(grams_[at] == now, own[at], 0.0)
                now = now >> U(8)
                at = np.minimum(np.searchsorted(contexts, now), len(contexts) - 1)
                p = a + np.where(contexts[at] == now, weight[at], 1.0) * p
            out[m] = np.log(p)
        return out


def ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def blocks(docs: DataFrame, shards: int, salts: int) -> DataFrame:
    """(block, body, requests): documents, compressed, and their distinct n-grams by the part that answers."""

    def pack(batches):
        held, size = [], 0

        def tell():
            t = pa.Table.from_batches(held).combine_chunks()
            g = distinct(np.concatenate([distinct(grams(data, offs)[0]) for _, _, data, offs in slices(t.column("text"))]))
            body = ipc(t.to_batches()[0])
            name = xxhash.xxh64_intdigest(body)
            shard = shard_of(g, shards)
            order = np.argsort(shard, kind="stable")
            g, shard = g[order], shard[order]
            edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
            asked = [{"part": int(shard[a]) * salts + name % salts, "body": packed(np.diff(g[a:z], prepend=U(0)))} for a, z in zip(edge, edge[1:])]
            kind = pa.list_(pa.struct([("part", pa.int32()), ("body", pa.binary())]))
            return pa.record_batch([pa.array(np.array([name], U).view(np.int64)), pa.array([body], pa.binary()), pa.array([asked], kind)], ["block", "body", "requests"])

        for b in batches:
            at = 0
            sizes = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(b.column("text")), 0), np.int64))
            while at < b.num_rows:
                before = int(sizes[at - 1]) if at else 0
                end = min(b.num_rows, max(at + 1, int(np.searchsorted(sizes, before + BLOCK - size, "right"))))
                held.append(b.slice(at, end - at))
                size += int(sizes[end - 1]) - before
                at = end
                if size >= BLOCK or at < b.num_rows:
                    yield tell()
                    held, size = [], 0
        if held:
            yield tell()

    return docs.mapInArrow(pack, "block long, body binary, requests array<struct<part:int,body:binary>>")


def scores(t: pa.Table, g: np.ndarray, logs: np.ndarray, toxic: bool) -> pa.RecordBatch:
    """Rows of a block with their perplexity and contrast, from the logarithms of its sorted distinct n-grams."""
    # Two tables of places by hashes find nearly all n-grams; the others are searched.
    bits = max(10, int(len(g) * 2).bit_length())
    places = [lambda x, k=k: ((x * U(k)) >> U(64 - bits)).astype(np.int64) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
    tables, left = [], np.arange(len(g), dtype=np.int32)
    for place in places:
        table = np.zeros(1 << bits, np.int32)
        h = place(g[left])
        table[h] = left
        tables.append(table)
        left = left[table[h] != left]

    def find(own: np.ndarray) -> np.ndarray:
        at = tables[0][places[0](own)]
        miss = np.flatnonzero(g[at] != own)
        at[miss] = tables[1][places[1](own[miss])]
        miss = miss[g[at[miss]] != own[miss]]
        at[miss] = np.searchsorted(g, own[miss])
        return at

    logs = logs.astype(np.float32)
    perplexity, contrast = [np.empty(0)], [np.empty(0)]
    for _, _, data, offs in slices(t.column("text")):
        own, first = grams(data, offs)
        at = find(own)
        total = np.concatenate([[0.0], np.cumsum(logs[0][at], dtype=np.float64)])
        n = np.diff(first)
        perplexity.append(np.exp(-(total[first[1:]] - total[first[:-1]]) / n))
        if toxic:
            more = np.concatenate([[0.0], np.cumsum(logs[1][at] - logs[0][at], dtype=np.float64)])
            # Runs of RUN n-grams that end within a text; its first ones are shorter.
            start = np.maximum(np.arange(len(own)) + 1 - RUN, np.repeat(first[:-1], n))
            contrast.append(np.maximum.reduceat(more[1:] - more[start], first[:-1]))
        else:
            contrast.append(np.full(len(n), np.nan))
    p, c = np.concatenate(perplexity), np.concatenate(contrast)
    batch = t.to_batches()[0] if t.num_rows else t
    names = [x for x in t.column_names if x != "text"]
    return pa.record_batch([*(batch.column(x) for x in names), pa.array(p, pa.float64()), pa.array(c, pa.float64(), from_pandas=True)], [*names, "perplexity", "contrast"])


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """Kept columns, perplexity and contrast of each document."""
    session = docs.sparkSession
    shards, toxic = model.shards, len(model.low) > 1
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    salts = max(1, math.ceil(size / 25 / shards / ASKED))  # large blocks ask for one in 25 of their bytes, about
    sent = session.sparkContext.broadcast((model.low, model.discounts))
    first = (F.col("shard") * salts).cast("int")
    counts = model.counts.select(F.explode(F.sequence(first, first + (salts - 1))).alias("part"), F.lit(0).alias("kind"), F.col("model").cast("long").alias("block"), "grams", "counts")
    # Both sides read the same exchange: the blocks are made once.
    dealt = blocks(docs.select(*keep, "text"), shards, salts).repartition(int(session.conf.get("spark.sql.shuffle.partitions")), "block")

    def ask(batches):
        for b in batches:
            for name, asked in zip(b.column("block").to_pylist(), b.column("requests").to_pylist()):
                n = len(asked)
                yield pa.record_batch([pa.array([x["part"] for x in asked], pa.int32()), pa.array([1] * n, pa.int32()), pa.array([name] * n, pa.int64()), pa.array([x["body"] for x in asked], pa.binary()), pa.nulls(n, pa.binary())], ["part", "kind", "block", "grams", "counts"])

    def answer(batches):
        low, d = sent.value
        part, held, shard = None, {}, None
        for b in batches:
            for p, kind, name, g, n in zip(*(b.column(c).to_pylist() for c in ("part", "kind", "block", "grams", "counts"))):
                if p != part:
                    part, held, shard = p, {}, None
                g = np.cumsum(unpacked(g, "<u8"), dtype=U)
                if kind == 0:
                    held[name] = g, unpacked(n, "<i8")
                    continue
                if shard is None:
                    shard, held = Shard(held, d), {}
                yield pa.record_batch([pa.array([name], pa.int64()), pa.array([p], pa.int32()), pa.array([packed(shard.logs(g, low).reshape(-1))], pa.binary())], ["block", "part", "body"])

    asked = dealt.mapInArrow(ask, "part int, kind int, block long, grams binary, counts binary")
    rows = counts.union(asked).repartition(shards * salts, "part").sortWithinPartitions("part", "kind")
    answers = rows.mapInArrow(answer, "block long, part int, body binary").groupBy("block").agg(F.collect_list(F.struct("part", "body")).alias("answers"))

    def tell(batches):
        for b in batches:
            for body, asked, got in zip(*(b.column(c).to_pylist() for c in ("body", "requests", "answers"))):
                found = {x["part"]: x["body"] for x in got or []}
                if {x["part"] for x in asked} != set(found):
                    raise RuntimeError("a block's n-grams have no answer: its source gave other rows when it was read again")
                g = np.concatenate([np.cumsum(unpacked(x["body"], "<u8"), dtype=U) for x in asked])
                logs = np.concatenate([unpacked(found[x["part"]], "<f2").reshape(1 + toxic, -1) for x in asked], axis=1)
                order = np.argsort(g)
                yield scores(from_ipc(body), g[order], logs[:, order], toxic)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return dealt.join(answers, "block", "left").mapInArrow(tell, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "perplexity double, contrast double"]))


def labelled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(model, text) of the documents in ids (doc_id, model): by a sorted list of ids where these are at most ``SENT``, else by a shuffle of the texts that a bit array lets pass."""
    sc = docs.sparkSession.sparkContext
    texts = docs.where("doc_id is not null").select("doc_id", "text")
    if isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType)) and ids.count() <= SENT:
        found = ids.toArrow()
        own, models = np.asarray(found.column("doc_id"), np.int64), np.asarray(found.column("model"), np.int32)
        order = np.argsort(own)
        sent = sc.broadcast((own[order], models[order]))

        def model_of(rows: pa.Array) -> pa.Array:
            own, models = sent.value
            if not len(own):
                return pa.nulls(len(rows), pa.int32())
            rows = rows.to_numpy()
            at = np.minimum(np.searchsorted(own, rows), len(own) - 1)
            return pa.array(models[at], pa.int32(), mask=own[at] != rows)

        return texts.select(F.arrow_udf(model_of, "int")(F.col("doc_id").cast("long")).alias("model"), "text").where("model is not null")
    bits = sc.broadcast(sieve(ids.select(F.xxhash64("doc_id").alias("node"))))

    def passes(h: pa.Array) -> pa.Array:
        low = h.to_numpy() & (8 * len(bits.value) - 1)
        return pa.array((bits.value[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1 == 1)

    return texts.where(F.arrow_udf(passes, "boolean")(F.xxhash64("doc_id"))).join(ids.hint("merge"), "doc_id").select("model", "text")


def train(docs: DataFrame, trusted: DataFrame, toxic: DataFrame) -> Model:
    """The models of the texts of documents whose doc_id is in trusted, and, if there are any, in toxic."""
    ids = cut(trusted.select("doc_id", F.lit(0).alias("model")).union(toxic.select("doc_id", F.lit(1).alias("model"))))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(4096, max(64, math.ceil(size / SHARD)))
    rows = counted(labelled(docs, ids), shards)

    def stats(kind: str) -> dict[tuple[int, int], int]:
        """Sums over all shards, by model and place."""

        def tell(batches):
            for b in batches:
                for model, g, n in zip(*(b.column(c).to_pylist() for c in ("model", "grams", "counts"))):
                    n = unpacked(n, "<i8")
                    g = np.cumsum(unpacked(g, "<u8"), dtype=U) if kind == "pairs" else np.arange(len(n))
                    yield pa.record_batch([pa.array(np.full(len(n), model, np.int32)), pa.array(g.astype(np.int64)), pa.array(n)], ["model", "place", "n"])

        found = rows.where(F.col("kind") == kind).select("model", "grams", "counts").mapInArrow(tell, "model int, place long, n long").groupBy("model", "place").agg(F.sum("n").alias("n"))
        return {(m, k): n for m, k, n in found.collect()}  # 2^16 for each model at most

    pairs, n = stats("pairs"), stats("few")
    models = 1 + max([m for m, _ in pairs], default=0)
    low = []
    for m in range(models):
        count = np.zeros(1 << 16, np.int64)
        own = [(k, v) for (x, k), v in pairs.items() if x == m]
        if own:
            count[[k for k, _ in own]] = [v for _, v in own]
        low.append(low_order(count))
    of = [[discounts(*(n.get((m, 4 * order + i), 0) for i in range(4))) for order in range(ORDER + 1)] for m in range(models)]
    return Model(rows.where("kind = 'counts'").drop("kind"), shards, of, low)


def by_label(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids of trusted and of toxic documents."""
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return told.where("q = 1 and t = 0").select("doc_id"), told.where("t = 1").select("doc_id")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, slack: float = 1.5, margin: float = 2.0, apart: int = 4) -> DataFrame:
    """doc_id, lang, perplexity, threshold, contrast, contrast_threshold and keep of each document.

    One in apart of the trusted documents, by a hash of the id, is not learned from: thresholds are those of texts that the model has not seen.
    """
    trusted, toxic = (cut(x) for x in by_label(labels))
    aside = F.pmod(F.xxhash64(F.lit(apart), "doc_id"), F.lit(apart)) == 0
    scored = cut(score(docs, train(docs, trusted.where(~aside), toxic)))
    known = scored.join(trusted.where(aside), "doc_id", "left_semi")
    at = [F.percentile_approx(c, quantile, 10000) for c in ("perplexity", "contrast")]
    # Cut, so that the join deals both sides anew and can split a language with most of the rows.
    by_lang = cut(known.where("lang is not null").groupBy("lang").agg(at[0].alias("own"), at[1].alias("own_contrast")))
    overall = known.agg(*at).first()
    told = scored.join(by_lang, "lang", "left")
    limits = [F.coalesce(F.col(c), F.lit(x if x is not None else math.inf)) for c, x in zip(("own", "own_contrast"), overall)]
    limits = [limits[0] * slack, limits[1] + margin]
    keep = (F.col("perplexity") <= limits[0]) & F.coalesce(F.col("contrast") <= limits[1], F.lit(True))
    return told.select("doc_id", "lang", "perplexity", limits[0].alias("threshold"), "contrast", limits[1].alias("contrast_threshold"), keep.alias("keep"))
