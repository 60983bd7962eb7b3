"""A corpus pipeline: language, near-duplicates, benchmark items, personal data, and the mix of sources.

Each stage works on all rows that the stage before kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lockstep.llm import decontaminate, langid, mixing, pii, simhash
from lockstep.llm.common import own_folder, small_batches, table

#: Least mean probability of its language for a document to stay.
CONFIDENCE = 0.4


#: Key of the surrogates of the driver's synthetic tables. It is no secret; data of real persons need one of their own.
PII_KEY = "synthetic tables"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with enough confidence; the field learns from those that are not held out.

    Null texts, and empty ones or others without a letter, have no language and go. Rows with a null id or language, repeated rows and all further
    columns, under any name, pass unchanged. With nothing to learn from all go; an empty table stays empty.
    """
    small_batches(spark)
    field = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.confident(docs, field, CONFIDENCE)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, null ids last, ties by a hash of all columns.

    Null, empty and blank texts are alike. Rows that share an id, or have none, are told apart by their texts: only rows whose texts are near-duplicates
    remove each other. Of rows that agree in all columns one stays. Further columns pass unchanged under any name.
    """
    small_batches(spark)
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain none and stay. Rows that are alike stay or go alike; null ids and further columns pass unchanged.
    Without items all stay.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data, in text and n_chars.

    Null texts stay null, empty ones empty. Equal texts get equal surrogates, whatever their ids. Further columns, under any name, and texts without
    personal data pass unchanged.
    """
    small_batches(spark)
    return pii.replace(docs, PII_KEY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken and the output shards of their copies.

    Null and empty texts have no words and are not taken. A null source is one of its own; rows that are alike count each. Columns
    named like results (size, source_size, target, taken, draws) get _kept added.
    """
    small_batches(spark)
    return mixing.assign(docs, tuple(docs.columns)).where("taken > 0")


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", private),
    ("mixing", mix),
]

#: Language, fingerprints, surrogates and draws have no counterpart in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and reread as Parquet in the cluster's shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = own_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
