"""SimHash near-duplicates with a Gray-ordered hierarchical index.

A document's fingerprint is the bitwise majority of the XXH64 values of its word
shingles. Equal fingerprints collapse to one row first, so copies never meet in pairs.
Fingerprints within ``radius`` bits agree on two of ``radius + 2`` blocks; every pair of blocks
deals them into groups that agree there. A group is sorted by Gray rank, and runs of
neighbours form nodes, level upon level, that hold the bits all their members share.
A search walks the levels for many fingerprints at once, adds only the differing bits
that a node has beyond its parent, and drops a whole node when the sum exceeds the radius.
Groups that exceed ``large`` are dealt again by parts of the remaining bits, one of which
must agree as well.

Links join into components of fingerprints; copies get theirs by an equi-join.

Nulls: a null or empty text, or one of spaces only, has fingerprint zero and links like any
other. A null doc_id never becomes a component's id unless all its members' ids are null.
Repeated rows give repeated results. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U, cut, groups_of, sieve, slices
from .components import components

SEED = 42
FAN = 8
#: Bands of MinHash values: all of a pair at J = 0.8 differ with a probability of (1 - 0.8^5)^24 = 7e-5.
BANDS, ROWS = 24, 5


def hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of each shingle of width words; of the whole sequence if it is shorter."""
    tokens = text.lower().split()
    if not tokens:
        return []
    line = b" ".join(tokens)
    h = xxhash.xxh64_intdigest
    if len(tokens) <= width:
        return [h(line, SEED)]
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = [0, *(ends[:-width] + 1).tolist()]
    return [h(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]


def fingerprints(texts: pa.Array, width: int = 3) -> pa.Array:
    """Majority bits of every text's shingle hashes, as signed longs."""
    out: list[np.ndarray] = [np.empty(0, U)]
    for _, _, data, offs in slices(texts):
        raw = data.tobytes()
        fps = np.zeros(len(offs) - 1, U)
        for k in range(len(fps)):
            h = hashes(raw[offs[k] : offs[k + 1]], width)
            if h:
                bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones = np.zeros(64, np.int64)
                for a in range(0, len(bits), 255):  # sums of bytes that cannot overflow
                    ones += np.add.reduce(bits[a : a + 255], axis=0, dtype=np.uint8)
                fps[k] = np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0]
        out.append(fps)
    return pa.array(np.concatenate(out).view(np.int64), pa.int64())


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U(s))
    return x


def least_hashes(texts: pa.Array, width: int, bits: int):
    """The MinHash values of every text's shingle set, one array for each text."""
    rng = np.random.default_rng(SEED)
    times, plus = rng.integers(0, 1 << 63, bits, dtype=U) << U(1) | U(1), rng.integers(0, 1 << 63, bits, dtype=U)
    for _, _, data, offs in slices(texts):
        raw = data.tobytes()
        for k in range(len(offs) - 1):
            h = shingle_set(raw[offs[k] : offs[k + 1]], width)
            least = np.full(bits, ~U(0))
            for i in range(0, len(h), 512):
                part = h[i : i + 512, None]
                part = (part ^ (part >> U(29))) * times + plus
                np.minimum(least, (part ^ (part >> U(32))).min(axis=0), out=least)
            yield least


def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    return np.unique(np.array(hashes(text, width) or [0], U))


def one_bit(least: np.ndarray) -> bytes:
    return np.packbits((least >> U(7)) & U(1) == 1).tobytes()


def sketches(texts: pa.Array, width: int = 5, bits: int = 256) -> pa.Array:
    """One-bit MinHash of every text's shingle set: bits agree with probability (1 + J) / 2."""
    return pa.array([one_bit(x) for x in least_hashes(texts, width, bits)], pa.binary())


def signatures(texts: pa.Array, width: int = 5, bits: int = 256) -> pa.Array:
    """The sketch of every text, and a key of each of ``BANDS`` bands of ``ROWS`` MinHash values."""
    sketch, keys = [], []
    for x in least_hashes(texts, width, bits):
        sketch.append(one_bit(x))
        keys.append([xxhash.xxh64_intdigest(x[i * ROWS : (i + 1) * ROWS].tobytes(), i) for i in range(BANDS)])
    keys = pa.array(np.array(keys, U).reshape(-1).view(np.int64), pa.int64())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, BANDS), pa.int32()), keys)
    return pa.StructArray.from_arrays([pa.array(sketch, pa.binary()), lists], ["sketch", "bands"])


def same_words(texts: pa.Array, seed: int = SEED) -> pa.Array:
    """A hash of every text's words in small letters: equal for texts with equal shingles in equal order."""
    out = [np.empty(0, U)]
    for _, _, data, offs in slices(texts):
        raw = data.tobytes()
        out.append(np.array([xxhash.xxh64_intdigest(b" ".join(raw[a:b].lower().split()), seed) for a, b in zip(offs.tolist(), offs[1:].tolist())], U))
    return pa.array(np.concatenate(out).view(np.int64), pa.int64())


def spread(n: int, near) -> np.ndarray:
    """Labels of the connected parts of n things. near(i, left) tells which of the things left are linked to i.

    Things found are not compared with each other again, so that a group of mostly similar ones takes few steps.
    """
    label, left = np.arange(n), np.arange(n)
    while len(left):
        start, left = left[0], left[1:]
        queue = [start]
        while queue and len(left):
            ok = near(queue.pop(), left)
            if ok.any():
                label[left[ok]] = start
                queue += left[ok].tolist()
                left = left[~ok]
    return label


def exact_links(texts: list[bytes], similarity: float) -> np.ndarray:
    """Labels of the parts that pairs with a Jaccard index of five-word shingles of at least similarity connect."""
    sets = [shingle_set(t) for t in texts]
    size = np.array([len(x) for x in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.r_[0, np.cumsum(size)]
    mark = np.zeros(int(flat.max()) + 1, bool)
    held: list = [None, None, None]

    def near(i, left):
        if held[0] is not left:
            held[:] = left, np.concatenate([flat[first[k] : first[k + 1]] for k in left]), np.r_[0, np.cumsum(size[left])[:-1]]
        own = flat[first[i] : first[i + 1]]
        mark[own] = True
        both = np.add.reduceat(mark[held[1]], held[2], dtype=np.int64)
        mark[own] = False
        return both >= similarity * (size[i] + size[left] - both) - 1e-9

    return spread(len(texts), near)


def search(group: np.ndarray, fps: np.ndarray, radius: int, most: int = 1 << 18):
    """Yields all pairs of one group within radius bits, some at a time. group: sorted ids; fps: in Gray order within a group.

    most bounds the places looked at together; what is beyond waits, level by level.
    """
    n = len(fps)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.empty(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    rank = np.arange(n) - np.repeat(first, sizes)
    ones, masked, starts = [fps], [np.full(n, ~U(0))], []
    while len(ones[-1]) > len(first):
        parent = np.flatnonzero(rank % FAN == 0)
        both = np.bitwise_and.reduceat(ones[-1] & masked[-1], parent)
        neither = np.bitwise_and.reduceat(~ones[-1] & masked[-1], parent)
        starts.append(parent)
        ones.append(both)
        masked.append(both | neither)  # the bits that all below share
        rank = rank[parent] // FAN
    own = np.flatnonzero(np.repeat(sizes > 1, sizes))
    root = np.repeat(np.arange(len(first)), sizes)[own]
    zero = np.zeros(len(own), np.int8)
    # What is open: searches at nodes of a level, or (opened) searches that have passed their nodes and go on to the children.
    work = [(len(starts), False, own[a : a + most], root[a : a + most], zero[a : a + most], np.zeros(len(own[a : a + most]), U)) for a in range(0, len(own), most)]
    while work:
        level, opened, q, node, acc, known = work.pop()
        if opened:
            s = starts[level]
            count = np.diff(np.r_[s, len(ones[level])])[node]
            child = np.repeat(s[node], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            q, node, acc, known = np.repeat(q, count), child, np.repeat(acc, count), np.repeat(known, count)
        mask = masked[level][node]
        acc = acc + np.bitwise_count((fps[q] ^ ones[level][node]) & mask & ~known).astype(np.int8)
        ok = acc <= radius
        if level == 0:
            ok &= q < node
            if ok.any():
                yield q[ok], node[ok]
            continue
        q, node, acc, known = q[ok], node[ok], acc[ok], mask[ok]
        part = max(1, most // FAN)
        work += [(level - 1, True, q[a : a + part], node[a : a + part], acc[a : a + part], known[a : a + part]) for a in range(0, len(q), part)]


def join_up(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after the links (i, j): the smallest place that each place is linked to."""
    while True:
        a, b = label[i], label[j]
        low = np.minimum(a, b)
        if (a == b).all():
            return label
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


def masks(radius: int) -> tuple[list[int], list[tuple[int, int]], list[list[int]]]:
    """Block masks, the pairs of blocks, and for each pair radius + 1 parts of the remaining bits."""
    m = radius + 2
    edges = [64 * i // m for i in range(m + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    pairs = list(combinations(range(m), 2))
    parts = []
    for i, j in pairs:
        rest = [b for b in range(64) if not ((blocks[i] | blocks[j]) >> b) & 1]
        cuts = [len(rest) * k // (radius + 1) for k in range(radius + 2)]
        parts.append([sum(1 << b for b in rest[a:c]) for a, c in zip(cuts, cuts[1:])])
    return blocks, pairs, parts


def links(unique: DataFrame, radius: int = 2, large: int = 1 << 17, agree: float = 0.0) -> DataFrame:
    """(a, b) that connect the same nodes of unique (node, fp, and sketch where agree is set) as all links do.

    A link is a pair of fingerprints within radius bits, whose sketches agree in at least that share of bits.
    Of the links found in a group, only stars leave the task: no more rows than the group has members.
    """
    blocks, pairs, parts = masks(radius)
    signed = lambda x: F.lit(x - (1 << 64) if x >> 63 else x).cast("long")
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col("fp").bitwiseAND(signed(blocks[i] | blocks[j])).alias("key")) for k, (i, j) in enumerate(pairs)))
    columns = ["node", "fp", *(["sketch"] if agree else [])]
    dealt = unique.select(*columns, F.inline(kinds)).withColumn("part", F.lit(-1))
    big = cut(dealt.groupBy("kind", "key").count().where(F.col("count") > large).select("kind", "key", F.lit(True).alias("big")))
    marked = dealt.withColumn("big", F.lit(None).cast("boolean")) if big.isEmpty() else dealt.join(big, ["kind", "key"], "left")
    again = F.create_map(*(x for k, p in enumerate(parts) for x in (F.lit(k), F.array(*(F.struct(F.lit(i).alias("part"), (F.col("fp").bitwiseAND(signed(m | blocks[pairs[k][0]] | blocks[pairs[k][1]]))).alias("key")) for i, m in enumerate(p))))))
    small = marked.where("big is null").select("kind", "part", "key", *columns)
    split = marked.where("big").select(*columns, "kind", F.inline(again[F.col("kind")])).select("kind", "part", "key", *columns)
    rows = small.union(split).repartition("kind", "part", "key").sortWithinPartitions("kind", "part", "key")

    def once(kind, part, x):
        """A pair is told once: by the first two equal blocks, and there by the first equal part."""
        equal = np.stack([(x & U(b)) == 0 for b in blocks])
        rank = np.cumsum(equal, axis=0)
        out = np.zeros(len(x), bool)
        for k, (p, q) in enumerate(pairs):
            here = (kind == k) & equal[p] & equal[q] & (rank[q] == 2)
            out |= here & (part == -1)
            if (part >= 0).any():
                earlier = np.zeros(len(x), bool)
                for s, m in enumerate(parts[k]):
                    same = (x & U(m)) == 0
                    out |= here & (part == s) & same & ~earlier
                    earlier |= same
        return out

    def find(batches):
        def flush(kind, part, key, node, fp, *sketch):
            fp = fp.view(U)
            order = np.lexsort((gray_rank(fp), key, part, kind))
            kind, part, key, node, fp = kind[order], part[order], key[order], node[order], fp[order]
            body = np.stack([x.view(U) for x in sketch], axis=1)[order] if sketch else None
            group = np.cumsum(np.r_[False, (kind[1:] != kind[:-1]) | (part[1:] != part[:-1]) | (key[1:] != key[:-1])]) if len(fp) else np.empty(0, int)
            label = np.arange(len(fp))
            for i, j in search(group, fp, radius):
                ok = label[i] != label[j]
                ok[ok] = once(kind[i[ok]], part[i[ok]], fp[i[ok]] ^ fp[j[ok]])
                if body is not None:
                    differ = np.bitwise_count(body[i[ok]] ^ body[j[ok]]).sum(axis=1, dtype=np.int64)
                    ok[ok] = differ <= (1 - agree) * 64 * body.shape[1]
                label = join_up(label, i[ok], j[ok])
            own = np.flatnonzero(label != np.arange(len(label)))
            return pa.record_batch([pa.array(node[own]), pa.array(node[label[own]])], ["a", "b"])

        held: list[tuple] = []
        for b in batches:
            now = [np.asarray(b.column(c)) for c in ("kind", "part", "key", "node", "fp")]
            if agree:
                raw = np.frombuffer(b"".join(b.column("sketch").to_pylist()), "<i8").reshape(b.num_rows, -1)
                now += [np.ascontiguousarray(raw[:, k]) for k in range(raw.shape[1])]
            held.append(tuple(now))
            now = tuple(np.concatenate(x) for x in zip(*held))
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]) | (now[2] != now[2][-1])) if len(now[0]) else []
            if len(last):
                cutoff = int(last[-1]) + 1
                yield flush(*(x[:cutoff] for x in now))
                now = tuple(x[cutoff:] for x in now)
            held = [now]
        if held:
            yield flush(*held[0])

    return rows.mapInArrow(find, "a long, b long")


def grouped(docs: DataFrame, widths: tuple[int, ...], radius: int, agree: float) -> DataFrame:
    """doc_id, fp (of the first width) and component_id of every document; links are those of any width's fingerprints."""
    fps = [f"fp{k}" for k in range(len(widths))]
    columns = [F.arrow_udf(lambda t, w=w: fingerprints(t, w), "long")("text").alias(c) for c, w in zip(fps, widths)]
    if agree:
        columns.append(F.arrow_udf(lambda t: sketches(t), "binary")("text").alias("sketch"))
    node = F.xxhash64(*fps, "sketch") if agree else F.xxhash64(*fps) if len(fps) > 1 else F.col("fp0")
    each = cut(docs.select("doc_id", *columns).withColumn("node", node))
    extra = [F.first("sketch").alias("sketch")] if agree else []
    unique = each.groupBy("node", *fps).agg(F.min("doc_id").alias("least"), *extra)
    edges = None
    for c in fps:
        more = links(unique.select("node", F.col(c).alias("fp"), *(["sketch"] if agree else [])), radius, agree=agree)
        edges = more if edges is None else edges.union(more)
    found = components(edges).withColumnRenamed("node", "known")
    roots = unique.join(found, unique.node == found.known, "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    roots = cut(roots)
    heads = cut(roots.groupBy("root").agg(F.min("least").alias("component_id")))
    told = cut(roots.join(heads, "root").select("node", "component_id"))  # so that the join can split hot fingerprints
    return each.join(told, "node").select("doc_id", F.col("fp0").alias("fp"), "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, agree: float = 0.0) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    return grouped(docs, (width,), radius, agree).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def bounds(keys: list) -> list[tuple[int, int]]:
    """Where groups of more than one row start and end."""
    at = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
    return [(a, b) for a, b in zip(at, at[1:]) if b - a > 1]


def band_links(unique: DataFrame, agree: float) -> DataFrame:
    """(a, b) that connect nodes (node, sketch, bands) with an equal band whose sketches agree in at least that share of bits."""

    def find(batches):
        for key, node, sketch in groups_of(batches, ("key", "node", "sketch")):
            from_, to = [], []
            for a, b in bounds(key):
                body = np.frombuffer(b"".join(sketch[a:b]), "<u8").reshape(b - a, -1)
                most = (1 - agree) * 64 * body.shape[1]
                label = spread(b - a, lambda i, left, body=body, most=most: np.bitwise_count(body[left] ^ body[i]).sum(axis=1, dtype=np.int64) <= most)
                for i in np.flatnonzero(label != np.arange(b - a)):
                    from_.append(node[a + i])
                    to.append(node[a + label[i]])
            yield pa.record_batch([pa.array(from_, pa.int64()), pa.array(to, pa.int64())], ["a", "b"])

    rows = unique.select(F.explode("bands").alias("key"), "node", "sketch").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(find, "a long, b long")


def sifted(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, packed text) of the documents of nodes, and of a few others."""
    sent = docs.sparkSession.sparkContext.broadcast(sieve(nodes))

    def tell(texts: pa.Array) -> pa.Array:
        node, bits = same_words(texts), sent.value
        low = np.asarray(node) & (8 * len(bits) - 1)
        ok = (bits[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1 == 1
        packed = [zlib.compress((t.as_py() or "").encode(), 1) if x else None for t, x in zip(texts, ok)]
        return pa.StructArray.from_arrays([node, pa.array(packed, pa.binary())], ["node", "packed"])

    return docs.select(F.arrow_udf(tell, "struct<node:long,packed:binary>")("text").alias("told")).select("told.*").where("packed is not null")


def verified(texts: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of the parts into which exact links divide each group of texts (part, node, packed)."""

    def find(batches):
        for part, node, text in groups_of(batches, ("part", "node", "packed")):
            told: dict[int, int] = {}
            for a, b in bounds(part):
                one = list(dict(zip(node[a:b], text[a:b])).items())
                label = exact_links([zlib.decompress(t) for _, t in one], similarity)
                told |= {one[i][0]: one[k][0] for i, k in enumerate(label.tolist())}
            yield pa.record_batch([pa.array(list(told), pa.int64()), pa.array(list(told.values()), pa.int64())], ["known", "root"])

    return texts.select("part", "node", "packed").repartition("part").sortWithinPartitions("part").mapInArrow(find, "known long, root long")


def hashable(docs: DataFrame) -> list[Column]:
    """The columns, those that hold maps as JSON."""
    return [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]


def one_of_each(docs: DataFrame, widths: tuple[int, ...] = (2, 3), radius: int = 6, similarity: float = 0.8) -> DataFrame:
    """One row of each component: the first by doc_id, nulls last, and of those by a hash of all columns.

    Candidates are fingerprints of two or of three words within radius bits, and texts with an equal band of MinHash values, whose
    sketches of five-word shingles tell of the similarity, less four standard deviations of the estimate. The texts that candidates
    connect meet in one task, and only pairs whose sets of five-word shingles are as similar link.
    """
    share = (1 + similarity) / 2
    agree = share - 4 * (share * (1 - share) / 256) ** 0.5
    fps = [f"fp{k}" for k in range(len(widths))]
    # Rows by id, null ids last; the hash of all columns tells rows of equal id apart.
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64(*hashable(docs)).alias("hash"))
    told = F.arrow_udf(lambda t: signatures(t), "struct<sketch:binary,bands:array<bigint>>")("text")
    node = F.arrow_udf(lambda t: same_words(t), "long")("text").alias("node")
    check = F.arrow_udf(lambda t: same_words(t, SEED + 1), "long")("text").alias("check")
    prints = [F.arrow_udf(lambda t, w=w: fingerprints(t, w), "long")("text").alias(c) for c, w in zip(fps, widths)]
    each = cut(docs.select(row.alias("row"), node, check, *prints, told.alias("told")).select("row", "node", "check", *fps, "told.*"))
    unique = cut(each.groupBy("node").agg((F.min("check") < F.max("check")).alias("clash"), *(F.first(c).alias(c) for c in (*fps, "sketch", "bands"))))
    edges = band_links(unique, agree)
    for c in fps:
        edges = edges.union(links(unique.select("node", F.col(c).alias("fp"), "sketch"), radius, agree=agree))
    loose = cut(components(edges).select("node", F.col("root").alias("part")))
    roots = cut(verified(sifted(docs, loose).dropDuplicates(["node"]).join(loose, "node"), similarity))
    component = F.coalesce("root", "node")
    # Texts that only a hash of 64 bits takes for equal are kept apart by the other 64.
    clash = unique.where("clash").select(F.col("node").alias("twice"))
    told = each.select("row", "node", "check").join(roots, F.col("node") == F.col("known"), "left").join(clash, F.col("node") == F.col("twice"), "left")
    heads = cut(told.groupBy(component.alias("root"), F.when(F.col("twice").isNotNull(), F.col("check")).alias("check")).agg(F.min("row").alias("row")))
    # Joined and made distinct by the same columns, which are never null: the texts are dealt once. The columns
    # of docs are held in one, so that no name of theirs meets these.
    keys = ["none", "id", "hash"]
    rows = docs.select(row.alias("at"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("all")).select("at.*", "all")
    return rows.join(heads.select("row.*"), keys).dropDuplicates(keys).select("all.*")
