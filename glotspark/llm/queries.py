"""One registered query per operator of this package, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

from . import (
    bpe,
    fingerprints,
    licenses,
    minhash,
    mixing,
    orchard,
    quality,
    repeats,
    secrets,
    spelling,
    token_counts,
    topk,
    toxicity,
)
from .arrow import small_batches


def documents(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_repeat_removal(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.summary(
        repeats.remove_repeats(documents(spark, sf), Scratch(spark).until_exit())
    )


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.count_by_line(documents(spark, sf), path, public_tokenizers.PATTERN)


def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(documents(spark, sf))


def op4_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_edits(documents(spark, sf))


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(documents(spark, sf), path, public_tokenizers.PATTERN)


def op6_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf), Scratch(spark).until_exit())
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "times")


def op7_minmax_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf), Scratch(spark).until_exit())


def op8_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    found = secrets.scan(docs, secrets.fit(docs))
    spans = F.col("spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secrets.KINDS[:3]],
        F.sha2(secrets.span_text(spans, base_only=True), 256).alias("base_sha256"),
        secrets.span_text(spans).alias("spans"),
        count("markov"),
    )


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    network = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return toxicity.score(docs, network, lang="lang").select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.col("flagged").cast("int").alias("flagged_by_language"),
    )


def op10_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return topk.search(vectors, F.col("vec_id") % 100 == 0)


def op11_orchard_codes(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    coded, books = orchard.compress(vectors, Scratch(spark).until_exit())
    return coded.select(
        "vec_id",
        orchard.code_text(F.col("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(orchard.digest(books)).alias("codebooks_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    runs = spelling.run_counts(documents(spark, sf), damaged=spelling.DAMAGED)
    words = runs.filter(F.col("n") >= spelling.LEAST_COUNT)
    return spelling.group(words, Scratch(spark).until_exit()).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


def op13_quality_ratio(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    ratio = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return quality.judge(docs, ratio).withColumn("ratio", F.round("ratio", 9))


def queries() -> dict:
    return {
        "op1_repeat_removal": op1_repeat_removal,
        "op2_token_counts": op2_token_counts,
        "op3_license_scan": op3_license_scan,
        "op4_fingerprint": op4_fingerprint,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_mix_sources": op6_mix_sources,
        "op7_minmax_near_dedup": op7_minmax_near_dedup,
        "op8_secret_scan": op8_secret_scan,
        "op9_toxicity": op9_toxicity,
        "op10_exact_topk": op10_exact_topk,
        "op11_orchard_codes": op11_orchard_codes,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_quality_ratio": op13_quality_ratio,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_license_scan": licenses.sql(),
        "op10_exact_topk": topk.sql(),
        "op11_orchard_codes": orchard.sql(),
        "op12_spelling_variants": spelling.sql(),
        "op13_quality_ratio": quality.sql(),
    }
