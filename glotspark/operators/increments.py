"""Learning from new texts only: sums that are kept with a model and added up.

A hashed Naive Bayes model is a function of how many texts and grams every class has. These sums, per
fold, class and point of the grid, are whole numbers, so sums of some texts and of others add up to
those of all, whatever the order. A model refitted from them is the model of all texts, to its digest.
The sums have the size of the models, not that of the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions.storage import Scratch, new_path

from .features import feature_stages, label_decoder
from .grams import gram_counts_by_size
from .tuning import GRID, ClassSums, bucket_sums, fit_from_sums

DOCUMENTS = "fold int, label string, documents long"
COUNTS = "n int, features int, fold int, label string, bucket int, tf long"


@dataclass(frozen=True)
class Sums:
    """``documents (fold, label, documents)`` and ``counts (n, features, fold, label, bucket, tf)``."""

    documents: DataFrame
    counts: DataFrame

    def plus(self, other: Sums) -> Sums:
        documents = self.documents.unionByName(other.documents).groupBy("fold", "label")
        keys = ["n", "features", "fold", "label", "bucket"]
        counts = self.counts.unionByName(other.counts).groupBy(*keys)
        return Sums(
            documents.agg(F.sum("documents").alias("documents")),
            counts.agg(F.sum("tf").alias("tf")),
        )

    def save(self, path: str) -> None:
        self.documents.write.parquet(f"{path}/documents")
        self.counts.write.parquet(f"{path}/counts")


def load_sums(spark: SparkSession, path: str) -> Sums:
    return Sums(
        spark.read.schema(DOCUMENTS).parquet(f"{path}/documents"),
        spark.read.schema(COUNTS).parquet(f"{path}/counts"),
    )


def sums_of(
    prepared: DataFrame,
    fold: Column,
    scratch: Scratch,
    grid: Sequence[tuple[int, int]] = GRID,
) -> Sums:
    """The sums of texts ``(filteredText, label)``; rows without a label are left out."""
    rows = prepared.filter(F.col(C.LABEL).isNotNull()).select(
        F.col(C.LABEL).alias("label"), fold.cast("int").alias("fold"), C.FILTERED
    )
    keys = ["fold", "label"]
    sizes = sorted({n for n, _ in grid})
    counts = scratch.table(gram_counts_by_size(rows, C.FILTERED, sizes, keys), "counts")
    points = [
        bucket_sums(counts, (n, features), keys).select(
            F.lit(n).alias("n"), F.lit(features).alias("features"), *keys, "bucket", "tf"
        )
        for n, features in grid
    ]
    documents = rows.groupBy(*keys).agg(F.count("*").alias("documents"))
    return Sums(documents.select("fold", "label", "documents"), reduce(DataFrame.union, points))


def fit_sums(spark: SparkSession, sums: Sums, point: tuple[int, int]) -> PipelineModel:
    """The model of one point of the grid on all texts that the sums stand for.

    Labels are indexed by the number of their texts, ties in label order, as a fit on texts does.
    """
    documents = sums.documents.collect()  # one row per fold and label
    totals: dict[str, int] = {}
    for row in documents:
        totals[row.label] = totals.get(row.label, 0) + row.documents
    labels = sorted(totals, key=lambda label: (-totals[label], label))
    index = {label: place for place, label in enumerate(labels)}
    chosen = sums.counts.filter((F.col("n") == point[0]) & (F.col("features") == point[1]))
    table = chosen.select("fold", "label", "bucket", "tf").toArrow()  # the size of a model
    counts = (
        table["fold"].to_numpy().astype(np.int64),
        np.array([index[label] for label in table["label"].to_pylist()], dtype=np.int64),
        table["bucket"].to_numpy().astype(np.int64),
        table["tf"].to_numpy().astype(np.int64),
    )
    by_class = {(row.fold, index[row.label]): row.documents for row in documents}
    model = fit_from_sums(spark, ClassSums(by_class, {point: counts}), len(labels), point)
    return PipelineModel([*feature_stages(*point), model, label_decoder(labels)])


def stored(sums: Sums, spark: SparkSession) -> Sums:
    """The sums written as tables, for a caller that reads them more than once."""
    path = new_path(spark, "sums")
    sums.save(path)
    return load_sums(spark, path)
