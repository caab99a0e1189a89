"""A corpus pipeline over ``documents``: toxicity, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every stage but
the last returns the columns of the documents it keeps.  ``run`` writes each
stage's result as Parquet into the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagegate.llm import decontaminate, minhash, packing, secrets, toxicity
from stagegate.llm.common import Scratch, crc_mod
from stagegate.llm.queries import table, vocabulary


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5; the lexicon learns from four fifths of the labelled ones."""
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0))
    return toxicity.keep_clean(docs, lexicon)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group that shares 0.8 of its five-word shingles."""
    return minhash.keep_one(docs, percent=80, size=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in the text replaced by its kind."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), 0)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

# the toxicity stage learns a lexicon, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs
