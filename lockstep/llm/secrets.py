"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of a file is addressed by the SHA-256 of its text. A ledger holds one row for each
pair of blob and rule version that was scanned, with the findings' places. A scan takes the
distinct blobs of its input, finds which pairs the ledger lacks, runs only these rules
on only these blobs, and returns the new ledger rows; ``update`` appends them to a ledger's Parquet table. Findings are
joined back from blobs to all paths.

Places come from the pieces that a rule's pattern splits a text into: a running sum
of the lengths of gaps and matches gives each match's code points. The running sum is a
window over the matches of one blob; blobs without a match leave before any shuffle of matches.

Shuffles: distinct blobs (the text, once); the matches; an equi-join of paths on
blobs, in which a blob with very many paths is split like any skewed key.

Nulls: a null text is an empty blob; null paths are carried. Empty texts have no findings. Repeated rows
repeat their findings. Texts are scanned whole. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

# The patterns of the rules, their least lengths.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
PRIVATE = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
GITHUB = r"gh[pousr]_[A-Za-z0-9]{36,}"
SLACK = r"xox[abprs]-[A-Za-z0-9-]{10,}"


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost matches count if the given group has enough characters. A changed rule gets a new version."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


BASE = (Rule("assign", ASSIGN, 2, 6), Rule("access", ACCESS, 0, 20), Rule("hex", HEX, 0, 24))
RULES = (*BASE, Rule("private_key", PRIVATE), Rule("github", GITHUB), Rule("slack", SLACK))
LEDGER = "blob string, rule string, version int, findings array<struct<start:int,end:int>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def pieces(text: Column, rule: Rule) -> Column:
    """Gap before, length, and whether it counts, for each match in order."""
    p = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    told = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    zipped = F.transform(F.arrays_zip(gaps.alias("g"), found.alias("m"), told.alias("t")), lambda x: F.struct(F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("length"), (F.length(x["t"]) >= rule.least).alias("counts")))
    return F.when(F.rlike(text, p), F.filter(zipped, lambda x: x["length"].isNotNull()))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows: findings of every pair of blob and rule version that the ledger lacks."""
    # Copies collapse in each task before anything is dealt by blob.
    blobs = docs.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
    ids = {f"{r.name}:{r.version}" for r in rules}
    if ledger is None:
        todo = blobs.withColumn("done", F.array().cast("array<string>"))
    else:
        done = ledger.select("blob", F.concat_ws(":", "rule", "version").alias("id")).where(F.col("id").isin(*ids)).groupBy("blob").agg(F.collect_set("id").alias("done"))
        unseen = blobs.join(done.where(F.size("done") == len(ids)), "blob", "left_anti")
        todo = unseen.join(done, "blob", "left").withColumn("done", F.coalesce("done", F.array().cast("array<string>")))
    rows = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.array_contains("done", f"{r.name}:{r.version}").alias("old"), F.when(~F.array_contains("done", f"{r.name}:{r.version}"), pieces(F.col("text"), r)).alias("found")) for r in rules))
    pairs = todo.select("blob", F.inline(rows)).where("not old").drop("old")
    # Pairs without a match stay in the ledger as well, so that they are not scanned again.
    each = pairs.select("blob", "rule", "version", F.posexplode_outer("found").alias("i", "x")).select("blob", "rule", "version", "i", "x.*")
    past = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("blob", "rule", "version").orderBy("i"))
    placed = each.withColumn("end", past.cast("int")).withColumn("start", (F.col("end") - F.col("length")).cast("int"))
    return placed.groupBy("blob", "rule", "version").agg(F.array_sort(F.collect_list(F.when(F.col("counts"), F.struct("start", "end")))).alias("findings"))


def update(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger at path, after what it lacks for docs was scanned and appended. A new ledger starts where there is none.

    One writer at a time. An update that fails leaves no rows; one that is done again adds none.
    """
    session = docs.sparkSession
    place = session._jvm.org.apache.hadoop.fs.Path(path)
    known = session.read.schema(LEDGER).parquet(path) if place.getFileSystem(session._jsc.hadoopConfiguration()).exists(place) else None
    scan(docs, known, rules).write.mode("append").parquet(path)
    return session.read.schema(LEDGER).parquet(path)


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, path: str = "doc_id") -> DataFrame:
    """path, and its blob's spans as a sorted array of (start, kind, end), kind being the rule's number."""
    number = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(f"{r.name}:{r.version}"), F.lit(k))))
    known = ledger.where(F.size("findings") > 0).withColumn("kind", number[F.concat_ws(":", "rule", "version")]).where("kind is not null")
    # Cut, so that the join deals both sides anew and can split a blob with very many paths.
    by_blob = cut(known.select("blob", "kind", F.inline("findings")).groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")))
    paths = docs.select(path, blob_of(F.col("text")).alias("blob"))
    return paths.join(by_blob, "blob", "left").select(path, "blob", F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("spans"))


def report(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and places of each document's findings, as text."""
    names = F.array(*(F.lit(r.name) for r in rules))
    line = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{r.name}") for k, r in enumerate(BASE)]
    base = F.filter("spans", lambda x: x["kind"] < len(BASE))
    return findings(docs, ledger, rules).select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
