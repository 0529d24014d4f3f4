"""From documents to packed sequences: drop toxic ones, keep one of near copies, mix, pack.

Each stage reads what the one before has written. All but the last return the columns of documents.
In every stage null texts count as empty, texts of any length are read whole, other columns may have any
name and type, and an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import mixing, packing, simhash, toxicity
from pulsegrid.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold.

    Repeated rows share their fate; empty texts have a score too. Without usable labels none is dropped,
    unless all labels are toxic.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with SimHash fingerprints at most two bits apart, one.

    The one with the smallest id stays, once if its row is repeated; documents without words are one group.
    Rows without an id all stay.
    """
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which large sources and languages weigh less than they did.

    A null source or language is a value of its own. Rows with one id and text share their fate.
    """
    return mixing.keep_mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens.

    An empty text is its end token alone; rows with a null or repeated id are documents of their own.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has neither Zstandard nor XXH64, nor the tokenizer: tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
