"""Grid search with cross-validation in two passes over the texts.

A multinomial Naive Bayes model is a function of per-class feature sums and document counts. The
sums per ``(fold, class)`` therefore hold the training set of every fold: leaving fold k out means
leaving its rows out. The first pass counts the grams per fold and class, for all grid points at
once; only distinct grams are hashed. The second pass scores every text with the models that have
not seen it. No feature vectors are stored: for short texts they are many times larger than the
texts.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import SparseVector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions import spaced
from glotspark.functions.storage import Scratch

from .evaluate import confusion, weighted_f1
from .features import (
    feature_stages,
    fit_label_index,
    label_decoder,
    language_pipeline,
    naive_bayes,
)
from .grams import gram_counts_by_size
from .hashed import BucketTable, best_class, bucket_table, hashed_scores

# The tuning grid and the number of folds.
GRAM_SIZES = (3, 4)
FEATURE_COUNTS = (20_000, 25_000, 30_000)
FOLDS = 2

GRID = tuple((n, features) for n in GRAM_SIZES for features in FEATURE_COUNTS)

# Stands in for "no documents" where a class is missing from a training split: the class keeps its
# index, and ln(weight + 1) is 0 to the last digit that matters.
NO_WEIGHT = 1e-12


def fold_of(key: Column, folds: int = FOLDS) -> Column:
    """A fold that depends on nothing but the row, so retries and reruns agree."""
    return F.pmod(key, F.lit(folds)).cast("int")


def text_fold(text: Column, folds: int = FOLDS) -> Column:
    """Fold by content: copies of one text never sit on both sides of a split."""
    return fold_of(F.xxhash64(text), folds)


@dataclass(frozen=True)
class Tuned:
    model: PipelineModel
    labels: list[str]
    # (n, features, fold, weighted_f1)
    metrics: list[tuple[int, int, int, float]]
    best: tuple[int, int]


@dataclass(frozen=True)
class ClassSums:
    """Whole-number sums of what every fold and class holds.

    ``documents`` counts texts per ``(fold, class index)``. ``counts`` has, per grid point, the
    arrays ``(fold, class, bucket, frequency)``: as many numbers as a model of that point has, or
    fewer. Being whole numbers, they do not depend on partitions or on the order of rows.
    """

    documents: dict[tuple[int, int], int]
    counts: dict[tuple[int, int], tuple[np.ndarray, ...]]


def bucket_sums(counts: DataFrame, point: tuple[int, int], keys: Sequence[str]) -> DataFrame:
    """``(keys, bucket, tf)`` of counted grams ``(keys, n, gram, freq)`` for one grid point; only
    distinct grams are hashed."""
    n, features = point
    terms = counts.filter(F.col("n") == n).select(
        *keys, "freq", F.array(spaced(F.col("gram"))).alias(C.NGRAMS)
    )
    hashing = HashingTF(inputCol=C.NGRAMS, outputCol=C.FEATURES, numFeatures=features)
    bucket = F.unwrap_udt(F.col(C.FEATURES))["indices"][0].alias("bucket")
    hashed = hashing.transform(terms).select(*keys, "freq", bucket)
    return hashed.groupBy(*keys, "bucket").agg(F.sum("freq").alias("tf"))


def class_counts(
    texts: DataFrame, grid: Sequence[tuple[int, int]], scratch: Scratch
) -> DataFrame:
    """``(fold, labelIndex, n, gram, freq)`` as a table."""
    sizes = sorted({n for n, _ in grid})
    return scratch.table(
        gram_counts_by_size(texts, C.FILTERED, sizes, ["fold", C.LABEL_INDEX]), "counts"
    )


def class_sums(
    texts: DataFrame,
    grid: Sequence[tuple[int, int]],
    scratch: Scratch,
    counts: DataFrame | None = None,
) -> ClassSums:
    """What any training split needs, from ``(fold, labelIndex, filteredText)``."""
    keys = ["fold", C.LABEL_INDEX]
    counts = class_counts(texts, grid, scratch) if counts is None else counts
    rows = texts.groupBy(*keys).agg(F.count("*").alias("documents")).collect()
    found = {}
    for point in grid:
        sums = bucket_sums(counts, point, keys).toArrow()
        found[point] = tuple(
            sums[name].to_numpy().astype(np.int64) for name in (*keys, "bucket", "tf")
        )
    counted = {(row.fold, int(row[C.LABEL_INDEX])): row.documents for row in rows}
    return ClassSums(counted, found)


def fit_from_sums(
    spark: SparkSession,
    sums: ClassSums,
    classes: int,
    point: tuple[int, int],
    left_out: int | None = None,
) -> NaiveBayesModel:
    """The model that a fit on all texts outside fold ``left_out`` would give.

    Every class is one row: its mean vector, weighted by its number of documents. All ``classes``
    are present, so a class index always is the label index.
    """
    fold, label, bucket, tf = sums.counts[point]
    rows = []
    for index in range(classes):
        documents = sum(
            count for key, count in sums.documents.items() if key[1] == index and key[0] != left_out
        )
        chosen = label == index
        if left_out is not None:
            chosen &= fold != left_out
        total = np.zeros(point[1], dtype=np.int64)
        np.add.at(total, bucket[chosen], tf[chosen])
        used = np.flatnonzero(total)
        vector = SparseVector(point[1], used.tolist(), (total[used] / max(1, documents)).tolist())
        rows.append((float(index), float(documents) or NO_WEIGHT, vector))
    train = spark.createDataFrame(rows, [C.LABEL_INDEX, "weight", C.FEATURES]).coalesce(1)
    return naive_bayes(weightCol="weight").fit(train)


def held_out_scores(
    texts: DataFrame,
    models: Mapping[tuple[tuple[int, int], int], NaiveBayesModel],
    table: BucketTable,
    scratch: Scratch,
) -> DataFrame:
    """``(n, features, fold, weighted_f1)``: each text scored by the models of its own fold. ``table``
    has the buckets of all grams of the texts."""
    grid = sorted({point for point, _ in models})
    scored = []
    for k in sorted({fold for _, fold in models}):
        own = [(point, models[point, k]) for point in grid]
        rows = texts.filter(F.col("fold") == k)
        rows = hashed_scores(rows, C.FILTERED, "sums", table, own, scratch)
        guesses, begin = [], 0
        for (n, size), model in own:
            guesses.append(
                F.struct(
                    F.lit(n).alias("n"),
                    F.lit(size).alias("features"),
                    best_class("sums", model, begin).alias(C.PREDICTION_INDEX),
                )
            )
            begin += model.numClasses
        scored.append(rows.select("fold", C.LABEL_INDEX, F.inline(F.array(*guesses))))
    together = functools.reduce(DataFrame.union, scored)
    keys = ["n", "features", "fold"]
    return weighted_f1(confusion(together, C.LABEL_INDEX, C.PREDICTION_INDEX, keys), keys)


def tune(
    prepared: DataFrame,
    fold: Column,
    grid: Sequence[tuple[int, int]] = GRID,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> Tuned:
    """Cross-validate every grid point and refit the best one on all rows.

    ``prepared`` holds ``filteredText`` and ``label``. Equal averages go to the first grid point.
    ``parallelism`` is the number of models fitted at a time, each from a handful of summed rows.
    """
    spark = prepared.sparkSession
    labeled = prepared.filter(F.col(C.LABEL).isNotNull())
    with Scratch(spark) as scratch:
        texts = scratch.table(
            labeled.select(C.LABEL, fold.alias("fold"), C.FILTERED), "labeled", partition_by="fold"
        )
        indexer = fit_label_index(texts.select(C.LABEL))
        labels = list(indexer.labels)
        indexed = indexer.transform(texts)
        held_out = range(folds)
        counts = class_counts(indexed, grid, scratch)
        sums = class_sums(indexed, grid, scratch, counts)

        def fit(job: tuple[tuple[int, int], int]) -> NaiveBayesModel:
            return fit_from_sums(spark, sums, len(labels), *job)

        jobs = [(point, k) for point in grid for k in held_out]
        with ThreadPool(parallelism) as pool:
            fitted = pool.map(inheritable_thread_target(spark)(fit), jobs)
        grams = counts.select("n", "gram").distinct()
        table = bucket_table(grams, sorted({size for _, size in grid}), scratch)
        scores = held_out_scores(indexed, dict(zip(jobs, fitted)), table, scratch).collect()
    f1 = {((row.n, row.features), row.fold): row.weighted_f1 for row in scores}

    tested = [[f1[point, k] for k in held_out if (point, k) in f1] for point in grid]
    averages = [sum(values) / len(values) for values in tested]
    best = grid[averages.index(max(averages))]
    model = PipelineModel(
        [
            *feature_stages(*best),
            fit_from_sums(spark, sums, len(labels), best),
            label_decoder(labels),
        ]
    )
    metrics = [(*point, k, f1[point, k]) for point, k in jobs if (point, k) in f1]
    return Tuned(model, labels, metrics, best)


def stock_cross_validator(
    labels: Sequence[str],
    grid_sizes: Sequence[int] = GRAM_SIZES,
    feature_counts: Sequence[int] = FEATURE_COUNTS,
    folds: int = FOLDS,
    fold_column: str | None = None,
    seed: int = 42,
    parallelism: int = 2,
) -> CrossValidator:
    """The same search with Spark's own cross-validator, which reruns the pipeline each time."""
    pipeline = language_pipeline(labels)
    _, ngram, hashing, *_ = pipeline.getStages()
    params = (
        ParamGridBuilder()
        .addGrid(ngram.n, list(grid_sizes))
        .addGrid(hashing.numFeatures, list(feature_counts))
        .build()
    )
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=params,
        evaluator=MulticlassClassificationEvaluator(
            labelCol=C.LABEL_INDEX, predictionCol=C.PREDICTION_INDEX
        ),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    return validator.setFoldCol(fold_column) if fold_column else validator
