"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source's documents are dealt by a hash of their id and text into at most ``blocks`` blocks.
A source whose target is f times its size offers every block floor(f) times, and a
permuted selection of its blocks once more, the last of these cut where the quota ends. These copies are the source's
quota of blocks. A binary tree over the output shards splits the quotas: at each node the copies of all sources that
are left are divided between the two halves by one multivariate hypergeometric draw. A shard then
draws its numbers of each source's permuted copies; draws are disjoint. What the mix takes of a document is
the sum over the copies of its block that were drawn: the whole document, or in a cut copy the words that are
left for it in hash order, the last document giving its first words only. So the words taken are the rounded target exactly.
``mixture`` writes the drawn copies out by shard, in an order shuffled within the shard.

Targets are found by rounds of sums over all sources (each caps the sources that are above their
limit), no task holds all of them; sources are numbered by their sorted partitions. The tree
works on ``GROUP`` sources at a time: the quotas of groups are split first, and each group's share of every shard then among
its sources, which is the same distribution.

Shuffles: partial sums by (source, block); sources, sorted; copies, at most ``most * blocks`` for a source; one join of documents on
(source, block), which splits the largest source ``blocks`` ways. No window holds more
than the copies of one source, or the documents of one block.

Nulls: a null text has size 0; a null source is a source of its own, ordered last; null
ids hash like any value, with their texts. Empty texts are kept with 0 taken words. Repeated rows count as
separate documents (all rows that agree in id and text are in one block). Kept columns that are named like
results get ``_kept`` added to their names. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, kept_names, word_counts

WEIGHTS = (3, 1, 2)
#: Sources whose quotas one task splits.
GROUP = 1 << 16
RESULTS = ("size", "source_size", "target", "taken", "draws", "copy", "shard", "words")


def numbered(sources: DataFrame) -> DataFrame:
    """sources (src, source_size) with number, their place by code point, null last, from 0."""
    held = cut(sources.orderBy(F.col("src").isNull(), "src"))
    placed = held.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("i"))
    counts = dict(sorted(tuple(r) for r in placed.groupBy("part").count().collect()))  # one row for each partition
    start, total = {}, 0
    for part, n in counts.items():
        start[part], total = total, total + n
    before = F.create_map(*(F.lit(x) for kv in start.items() for x in kv))[F.col("part")] if start else F.lit(0)
    return placed.select("src", "source_size", (before + F.col("i")).cast("long").alias("number"))


def with_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """sources (src, source_size, number) with target: shares of the total by weight, none above most times its size; what is cut off goes to the others by weight."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("number") % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    left, free, above = total, None, F.lit(False)
    while True:
        held, all_free = rows.agg(F.sum(F.when(above, F.col("limit"))), F.sum(F.when(~above, F.col("weight")))).first()
        left = total - (held or 0.0)
        if not all_free or left <= 0:
            level = F.lit(0.0)
            break
        level = left * F.col("weight") / all_free
        now = above | (level > F.col("limit"))
        if all_free == free:
            break
        above, free = now, all_free
    return rows.withColumn("target", F.when(above, F.col("limit")).otherwise(level)).drop("weight", "limit")


def draw_part(rng: np.random.Generator, counts: np.ndarray, take: int) -> np.ndarray:
    """How many of each kind are among take of all, by one multivariate hypergeometric draw, of any number of copies.

    Every copy is chosen by itself first, with the probability take / all. Of the same number of copies all choices are
    equally likely then, so that adding or removing as many as the number is off, drawn in the same way, keeps them so.
    """
    total = int(counts.sum())
    if take <= 0 or take >= total:
        return counts.copy() if take >= total else np.zeros_like(counts)
    chosen = rng.binomial(counts, take / total)
    off = take - int(chosen.sum())
    return chosen + draw_part(rng, counts - chosen, off) if off >= 0 else chosen - draw_part(rng, chosen, -off)


def split_tree(quotas: np.ndarray, room: np.ndarray, seed: list[int]):
    """(source, shard, copies) of all draws: quotas of the sources (all long) split among shards with these rooms, which have the same sum."""
    past_room = np.r_[0, np.cumsum(room)]

    def node(which: np.ndarray, counts: np.ndarray, first: int, past: int):
        if past - first == 1:
            yield from ((int(i), first, int(n)) for i, n in zip(which, counts))
            return
        mid = (first + past) // 2
        left = draw_part(np.random.default_rng([*seed, first, past]), counts, int(past_room[mid] - past_room[first]))
        for part, a, b in ((left, first, mid), (counts - left, mid, past)):
            some = part > 0
            if some.any():
                yield from node(which[some], part[some], a, b)

    own = quotas > 0
    if own.any():
        yield from node(np.flatnonzero(own), quotas[own].astype(np.int64), 0, len(room))


def drawn(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(number, shard, copies) from quotas (number, quota), each node of the tree split for groups of sources and then within them."""
    grouped = quotas.withColumn("group", F.expr(f"number div {GROUP}"))
    totals = cut(grouped.groupBy("group").agg(F.sum("quota").alias("quota")))
    total = int(totals.agg(F.sum("quota")).first()[0] or 0)
    room = np.array([total * (s + 1) // shards - total * s // shards for s in range(shards)], np.int64)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["number", "shard", "copies"])

    def emit(found, name):
        held = []
        for i, shard, n in found:
            held.append((name(i), shard, n))
            if len(held) == 1 << 15:
                yield batch(held)
                held = []
        yield batch(held)

    def top(batches):
        rows = sorted((g, q) for b in batches for g, q in zip(b.column("group").to_pylist(), b.column("quota").to_pylist()))
        if rows:
            yield from emit(split_tree(np.array([q for _, q in rows]), room, [seed]), lambda i: rows[i][0])

    # One row for each group of sources: a few, at any size that fits a table of sources.
    of_group = totals.coalesce(1).mapInArrow(top, "number long, shard long, copies long").withColumnRenamed("number", "group")
    rooms = of_group.groupBy("group").agg(F.collect_list(F.struct("shard", "copies")).alias("rooms"))

    def within(key, table):
        # One group: at most GROUP sources.
        rows = sorted(zip(table.column("number").to_pylist(), table.column("quota").to_pylist()))
        own = np.zeros(shards, np.int64)
        for r in table.column("rooms")[0].as_py():
            own[r["shard"]] = r["copies"]
        got = list(split_tree(np.array([q for _, q in rows]), own, [seed, 1 + key[0].as_py()]))
        return pa.table({"number": pa.array([rows[i][0] for i, _, _ in got], pa.int64()), "shard": pa.array([s for _, s, _ in got], pa.int64()), "copies": pa.array([n for _, _, n in got], pa.int64())})

    return grouped.join(rooms, "group").groupBy("group").applyInArrow(within, "number long, shard long, copies long")


def draws_of_blocks(by_block: DataFrame, weights, share: float, most: float, shards: int | None, shard_words: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Targets by source (src, source_size, target), and the draws of each block (src, block, draws: array of copy, shard, room), from by_block (src, block, words)."""
    sources = numbered(by_block.groupBy("src").agg(F.sum("words").alias("source_size")))
    targets = cut(with_targets(sources, weights, share, most))
    if shards is None:
        shards = max(1, math.ceil((targets.agg(F.sum("target")).first()[0] or 0) / shard_words))
    quota = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0).cast("int")
    told = targets.withColumn("full", full).withColumn("rest", quota - F.col("full") * F.col("source_size"))
    blocks = by_block.alias("b").join(told.alias("t"), F.col("b.src").eqNullSafe(F.col("t.src"))).where("words > 0").select("t.number", "block", "words", "full", "rest")
    order = Window.partitionBy("number").orderBy(F.xxhash64(F.lit(seed + 1), "number", "block"), "block")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("room", F.least("words", F.greatest(F.lit(0), F.col("rest") - before)))
    copies = F.concat(F.transform(F.expr("IF(full > 0, sequence(1, full), array())"), lambda k: F.struct(k.alias("copy"), F.col("words").alias("room"))), F.when(F.col("room") > 0, F.array(F.struct((F.col("full") + 1).alias("copy"), "room"))).otherwise(F.array().cast("array<struct<copy:int,room:bigint>>")))
    copies = cut(blocks.select("number", "block", F.inline(copies)))
    permuted = Window.partitionBy("number").orderBy(F.xxhash64(F.lit(seed + 2), "number", "block", "copy"), "block", "copy")
    ranked = copies.withColumn("rank", F.row_number().over(permuted).cast("long"))
    dealt = drawn(copies.groupBy("number").agg(F.count("*").alias("quota")), shards, seed)
    ends = F.sum("copies").over(Window.partitionBy("number").orderBy("shard"))
    ranges = dealt.withColumn("past", ends).select("number", "shard", F.explode(F.sequence(F.col("past") - F.col("copies") + 1, F.col("past"))).alias("rank"))
    placed = ranked.join(ranges, ["number", "rank"]).groupBy("number", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard", "room"))).alias("draws"))
    named = placed.join(targets.select("number", "src"), "number").select("src", "block", "draws")
    return targets.drop("number"), cut(named)


def with_draws(docs: DataFrame, keep: tuple[str, ...], weights, share: float, most: float, blocks: int, shards: int | None, shard_words: int, seed: int) -> DataFrame:
    """row (the kept columns), size, source_size, target, hash, and draws: array of copy, shard, and the words it takes of the document."""
    count = F.arrow_udf(lambda t: word_counts(t), "long")
    row = F.xxhash64(F.lit(seed), "doc_id", "text")
    names = kept_names(keep, RESULTS)
    base = docs.select(F.struct(*(F.col(f"`{c}`").alias(n) for c, n in names.items())).alias("row"), F.col("source").alias("src"), row.alias("hash"), F.pmod(row, F.lit(blocks)).cast("int").alias("block"), count("text").alias("size"))
    by_block = cut(base.groupBy("src", "block").agg(F.sum("size").alias("words")))
    targets, draws = draws_of_blocks(by_block, weights, share, most, shards, shard_words, seed)
    # Small tables, cut, so that joins deal both sides anew and can split a block with very many rows.
    of_block = cut(by_block.alias("b").join(targets.alias("t"), F.col("b.src").eqNullSafe(F.col("t.src"))).join(draws.alias("d"), F.col("b.src").eqNullSafe(F.col("d.src")) & (F.col("b.block") == F.col("d.block")), "left").select("b.src", "b.block", "source_size", "target", "draws"))
    rows = base.alias("b").join(of_block.alias("t"), F.col("b.src").eqNullSafe(F.col("t.src")) & (F.col("b.block") == F.col("t.block"))).select("b.*", "source_size", "target", F.col("draws").alias("of_block"))
    inner = Window.partitionBy("src", "block").orderBy("hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    own = F.transform("of_block", lambda d: F.struct(d["copy"].alias("copy"), d["shard"].alias("shard"), F.greatest(F.lit(0), F.least(F.col("size"), d["room"] - F.col("before"))).alias("words")))
    own = F.coalesce(F.filter(own, lambda d: d["words"] > 0), F.array().cast("array<struct<copy:int,shard:bigint,words:bigint>>"))
    return rows.select("row", "size", "source_size", "target", "hash", own.alias("draws"))


OPTIONS = {"weights": WEIGHTS, "share": 1.5, "most": 2.0, "blocks": 8192, "shards": None, "shard_words": 1 << 22, "seed": 7}


def assign(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """One row per document: keep, size, source_size, target, taken, and draws: the copies drawn of it, each with its shard and words.

    Options and their defaults are those of ``OPTIONS``; without shards there is one for each ``shard_words`` words taken.
    """
    rows = with_draws(docs, keep, **(OPTIONS | options))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    return rows.select("row.*", "size", "source_size", "target", taken.alias("taken"), "draws")


def mixture(docs: DataFrame, keep: tuple[str, ...], **options) -> DataFrame:
    """The mix itself: a row for each copy drawn of a document with its shard and words, in a shuffled order within each shard."""
    seed = (OPTIONS | options)["seed"]
    rows = with_draws(docs, keep, **(OPTIONS | options)).withColumn("draw", F.explode("draws"))
    order: Column = F.xxhash64(F.lit(seed + 4), "hash", "draw.copy")
    rows = rows.select("row", "size", "source_size", "target", "draw", order.alias("order")).repartition("draw.shard").sortWithinPartitions("draw.shard", "order")
    return rows.select("row.*", "size", "source_size", "target", "draw.*")
