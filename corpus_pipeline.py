"""From raw documents to token ids: five stages, each over all that the one before has kept.

Toxic documents go, one document of every group of near-duplicates stays, secrets are masked, sources
are mixed to their target weights, and what is left is encoded. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch, use_local_folder
from glotspark.llm import bpe, minhash, mixing, secrets, toxicity
from glotspark.llm.arrow import small_batches

# Training, sampling and component search are beyond SQL: the tests compare with brute force.
ORACLE_SQL = None


# Near-duplicates share this percentage of their five-word shingles at least.
PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold calibrated for their language, or else the general one;
    null and empty texts are scored like any other."""
    network = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, network, lang="lang")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document with the least id of every component; documents without words, or without an id,
    all stay. Of rows that share an id each goes or stays by its own text."""
    return minhash.keep_one(docs, Scratch(spark).until_exit(), percent=PERCENT)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark."""
    return secrets.redact(docs, secrets.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixing.expand(docs, Scratch(spark).until_exit())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, exact, n_tokens)``; ``exact``: the ids decode to the text's bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


# The columns of documents that stages read.
READ = ("doc_id", "text", "lang", "source", "n_chars")


def prepared(stage):
    """A stage in small batches, over columns whose names can't be in its way.

    Whatever else a table holds, dotted names and such that a stage uses itself too, is named by its
    place until the stage is done. The last stage has columns of its own.
    """

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        first = {name: place for place, name in reversed(list(enumerate(docs.columns)))}
        plain = [
            name if name in READ and first[name] == place else f"extra_column_{place}"
            for place, name in enumerate(docs.columns)
        ]
        done = stage(spark, docs.toDF(*plain), sf_dir)
        return done.toDF(*docs.columns) if done.columns == plain else done

    return run_stage


STAGES = [
    ("toxicity", prepared(drop_toxic)),
    ("near_duplicates", prepared(drop_near_duplicates)),
    ("secrets", prepared(mask_secrets)),
    ("mixing", prepared(mix_sources)),
    ("encoding", prepared(encode)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage is written as Parquet and read again."""
    use_local_folder(spark)
    scratch = Scratch(spark).until_exit()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
