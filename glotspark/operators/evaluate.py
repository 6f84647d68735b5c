"""How often predictions agree with labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark import columns as C


def success_rate(
    df: DataFrame, label: str = C.LABEL, prediction: str = C.PREDICTION
) -> DataFrame:
    """One row ``(correct, predicted, percent_successrate)``; null rate for no rows.

    One conditional aggregate in one scan. A null label never counts as correct.
    """
    counted = df.agg(
        F.count_if(F.col(label) == F.col(prediction)).alias("correct"),
        F.count("*").alias("predicted"),
    )
    share = F.col("correct").cast("double") / F.nullif(
        F.col("predicted").cast("double"), F.lit(0.0)
    )
    return counted.withColumn("percent_successrate", share * F.lit(100.0))


def confusion(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, label, prediction, count)``: everything the quality measures need."""
    return df.groupBy(
        *keys, F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count("*").alias("count"))


def class_scores(confused: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """True positives, actual and predicted counts and F1 per class of a confusion table."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    parts = F.array(
        F.struct(
            F.col("label").alias("class"),
            hit.alias("tp"),
            F.col("count").alias("actual"),
            F.lit(0).cast("long").alias("guessed"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("long").alias("tp"),
            F.lit(0).cast("long").alias("actual"),
            F.col("count").alias("guessed"),
        ),
    )
    sums = (
        confused.select(*keys, F.inline(parts))
        .groupBy(*keys, "class")
        .agg(*[F.sum(name).alias(name) for name in ("tp", "actual", "guessed")])
    )
    f1 = F.lit(2.0) * F.col("tp") / (F.col("actual") + F.col("guessed"))
    return sums.withColumn("f1", f1)


def weighted_f1(confused: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """F1 per class weighted by class size, which is the evaluator's default metric."""
    weighted = F.sum(F.col("f1") * F.col("actual")) / F.sum("actual")
    scores = class_scores(confused, keys)
    return (scores.groupBy(*keys) if keys else scores).agg(weighted.alias("weighted_f1"))
