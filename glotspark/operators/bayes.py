"""Multinomial Naive Bayes over exact character grams, as aggregations and joins.

The hashed ML pipeline is the production model; this form needs no hashing, so its numbers can be
checked in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions.storage import Scratch

from .coded import counted_in_tasks
from .gram_model import GramModel, micro, save_gram_model


@dataclass(frozen=True)
class GramBayes:
    """``counts (label, gram, count)``, ``classes (label, docs, grams, pi, absent)`` by index."""

    counts: DataFrame
    classes: DataFrame
    n: int
    smoothing: float

    def theta(self) -> DataFrame:
        """``(label, gram, count, theta)`` for the grams each class has shown.

        Any other gram of the vocabulary has the class's ``absent`` weight, so the table holds no
        zero counts and never grows to labels times vocabulary.
        """
        sizes = self.classes.select("label", "denominator")
        theta = F.ln(F.col("count") + F.lit(self.smoothing)) - F.ln("denominator")
        return self.counts.join(sizes, "label").select(
            "label", "gram", "count", theta.alias("theta")
        )

    def model(self, path: str | None = None) -> GramModel:
        classes = self.classes.select(
            "label", micro(F.col("pi")).alias("pi"), micro(F.col("absent")).alias("absent")
        )
        rows = classes.collect()
        weights = (
            self.theta()
            .join(classes.select("label", "absent"), "label")
            .select(
                F.col("label").alias("class"),
                F.lit(self.n).alias("n"),
                "gram",
                (micro(F.col("theta")) - F.col("absent")).alias("weight"),
            )
        )
        return save_gram_model(
            weights,
            [row.label for row in rows],
            [self.n],
            [row.pi for row in rows],
            [row.absent for row in rows],
            path=path,
        )


def fit_gram_bayes(
    df: DataFrame,
    label: str = C.LABEL,
    text: str = C.FILTERED,
    n: int = 3,
    smoothing: float = 1.0,
) -> GramBayes:
    """One pass over the text counts grams and documents together, in the tasks that read it."""
    rows = df.filter(F.col(label).isNotNull()).select(
        F.col(label).alias("label"), F.col(text).alias("bayes_text")
    )
    # Every text has a row without a gram.
    found = counted_in_tasks(rows, "bayes_text", [n], ["label"], every=True)
    # The returned frames read this table.
    counted = Scratch(df.sparkSession).until_exit().table(
        found.groupBy("label", "gram").agg(
            F.sum("freq").alias("count"), F.count_if(F.col("gram").isNull()).alias("starts")
        ),
        "bayes",
    )
    counts = counted.filter(F.col("gram").isNotNull()).select("label", "gram", "count")
    vocabulary = counts.select("gram").distinct().count()
    sums = counted.groupBy("label").agg(
        F.sum("starts").alias("docs"), F.sum("count").alias("grams")
    )
    # One row per class; the order is that of the label index.
    rows = sums.orderBy(F.desc("docs"), "label").collect()
    denominator = F.col("grams") + F.lit(smoothing * vocabulary)
    total = sum(row.docs for row in rows) + smoothing * len(rows)
    classes = (
        df.sparkSession.createDataFrame(rows, sums.schema)
        .coalesce(1)
        .withColumn("pi", F.ln(F.col("docs") + F.lit(smoothing)) - F.ln(F.lit(total)))
        .withColumn("denominator", denominator)
        .withColumn("absent", F.ln(F.lit(smoothing)) - F.ln("denominator"))
    )
    return GramBayes(counts, classes, n, smoothing)
