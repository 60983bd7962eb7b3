"""The operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, langid, media, mixing, oracles, phrases, pii, quality, repeats, secrets, simhash, weighted
from .common import own_folder, table


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of secrets in each document, from a ledger that is filled in two deliveries: about half of the documents, then all.

    The second scans only what the first has not: blobs not met before.
    """
    docs = table(spark, sf_dir, "documents")
    path = own_folder(spark, "secrets-ledger")
    secrets.update(docs.where(F.xxhash64("doc_id") >= 0), path)
    return secrets.report(docs, secrets.update(docs, path))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.assign(table(spark, sf_dir, "documents"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's perplexity under the model of trusted text, its language's threshold, and whether it is kept."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, with the item and its share found."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation whose texts hold control strings of common templates.
TRICKY = "\\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted conversations say when read back."""
    added = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    return chat.digests(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without strings of 50 bytes that start in an earlier one."""
    return repeats.removals(table(spark, sf_dir, "documents"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stored form of each document's text holds when read back."""
    docs = media.with_media(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return media.described(docs).drop("text", "media")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid.held_out(F.col("doc_id")).alias("held_out"))
    field = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), field).drop("text")


#: Key of the surrogates of the driver's synthetic tables. It is no secret; data of real persons need one of their own.
PII_KEY = "synthetic tables"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's text with its entities replaced, and their number."""
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, counts=True)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language whose words occur together more often than apart."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint, and its likeness to those of its edited text and of the next document."""
    return weighted.fingerprinted(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": oracles.OP3, "op2_decontamination": oracles.OP2, "op7_secrets": oracles.OP7, "op11_phrases": oracles.OP11}
