"""Language profiles as JSON: ``{"freq": {gram: count}, "n_words": [c1, c2, ...], "name": code}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

PROFILE_SCHEMA = "freq map<string,bigint>, n_words array<bigint>, name string"

# A language is written as several objects of about this many grams, so that a language with a
# huge vocabulary never has to fit in one task.
GRAMS_PER_OBJECT = 10_000


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """``(lang, n, gram, freq, total)`` from one-object-per-file or one-object-per-line JSON.

    A malformed object fails the read: a guesser must not lose a language silently.
    """
    objects = spark.read.schema(PROFILE_SCHEMA).option("mode", "FAILFAST").json(path)
    grams = objects.select(
        F.col("name").alias("lang"), "n_words", F.explode("freq").alias("gram", "freq")
    ).withColumn("n", F.length("gram"))
    return grams.select(
        "lang", "n", "gram", "freq", F.get("n_words", F.col("n") - 1).alias("total")
    )


def write_profiles(profile: DataFrame, path: str) -> None:
    """Write a profile as JSON lines, one folder per language."""
    with Scratch(profile.sparkSession) as scratch:
        profile = scratch.table(profile, "profile")
        largest, longest = (
            profile.groupBy("lang")
            .agg(F.count("*").alias("grams"), F.max("n").alias("n"))
            .agg(F.max("grams"), F.max("n"))
            .first()
        )
        objects = -(-(largest or 0) // GRAMS_PER_OBJECT) or 1
        totals = [
            F.coalesce(F.max(F.when(F.col("n") == n, F.col("total"))), F.lit(0))
            for n in range(1, max(3, longest or 0) + 1)
        ]
        sizes = profile.groupBy("lang").agg(F.array(*totals).alias("n_words"))
        shards = (
            profile.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(objects)))
            .groupBy("lang", "shard")
            .agg(F.map_from_entries(F.collect_list(F.struct("gram", "freq"))).alias("freq"))
        )
        (
            shards.join(sizes, "lang")
            .select("freq", "n_words", F.col("lang").alias("name"), "lang")
            .write.partitionBy("lang")
            .json(path)
        )
