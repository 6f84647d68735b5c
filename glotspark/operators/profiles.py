"""Language profiles and the language guesser.

A profile lists, per language, how often each gram of one to three characters occurs. A text gets
the language with the highest

    sum over grams g of count(g) * (ln(p(g | language) + eps) - ln(eps)),  p = freq / total

where ``total`` counts the grams of the same length. Grams a language has never shown add nothing,
ties go to the smaller language code, and a text without any known gram is "unknown".
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions import folded
from glotspark.functions.storage import BROADCAST_BYTES, Scratch

from .coded import counted_in_tasks
from .gram_model import GramModel, micro, predict, save_gram_model
from .grams import gram_counts_by_size
from .sketches import WIDTH, frequent

EPSILON = 1e-6
SIZES = (1, 2, 3)


def build_profile(
    df: DataFrame,
    lang: str = "lang",
    text: str = C.TEXT,
    sizes: Sequence[int] = SIZES,
    min_count: int = 1,
) -> DataFrame:
    """``(lang, n, gram, freq, total)`` from texts of known language.

    ``min_count`` leaves out rare grams before the totals are taken; it bounds the profile of a
    corpus whose noise keeps adding new grams.
    """
    counts = gram_counts_by_size(df.withColumnRenamed(lang, "lang"), text, sizes, ["lang"])
    counts = counts.filter(F.col("freq") >= min_count) if min_count > 1 else counts
    totals = counts.groupBy("lang", "n").agg(F.sum("freq").alias("total"))
    return counts.join(totals, ["lang", "n"]).select("lang", "n", "gram", "freq", "total")


def build_frequent_profile(
    df: DataFrame,
    min_count: int,
    lang: str = "lang",
    text: str = C.TEXT,
    sizes: Sequence[int] = SIZES,
    width: int = WIDTH,
) -> DataFrame:
    """``build_profile`` with ``min_count``, for a corpus whose rare grams are too many to shuffle.

    A count-min sketch tells first which grams may be frequent enough; only these are counted. The
    texts are read twice, and rare grams leave the task that they are found in only by chance.
    """
    found = counted_in_tasks(df.withColumnRenamed(lang, "lang"), text, sizes, ["lang"])
    value = F.struct("lang", "gram")
    kept = found.filter(frequent(found, value, F.col("freq"), min_count, width).may_be(value))
    counts = kept.groupBy("lang", "n", "gram").agg(F.sum("freq").alias("freq"))
    counts = counts.filter(F.col("freq") >= min_count)
    totals = counts.groupBy("lang", "n").agg(F.sum("freq").alias("total"))
    return counts.join(totals, ["lang", "n"]).select("lang", "n", "gram", "freq", "total")


def fold_profile(profile: DataFrame) -> DataFrame:
    """A profile whose grams are folded to the representatives of their scripts, as imported ones are;
    grams that become equal add up. For texts that ``labeler`` folds alike."""
    grams = profile.select("lang", "n", folded(F.col("gram")).alias("gram"), "freq", "total")
    return grams.groupBy("lang", "n", "gram").agg(
        F.sum("freq").alias("freq"), F.max("total").alias("total")
    )


def profile_weights(profile: DataFrame, eps: float = EPSILON) -> DataFrame:
    """``(class, n, gram, weight)`` of the guesser's score, in micro-nats."""
    weight = F.ln(F.col("freq") / F.col("total") + F.lit(eps)) - F.lit(math.log(eps))
    return profile.select(
        F.col("lang").alias("class"), "n", "gram", micro(weight).alias("weight")
    )


def fit_guesser(profile: DataFrame, eps: float = EPSILON, path: str | None = None) -> GramModel:
    """Turn a profile into a stored weight table that texts are scored against."""
    with Scratch(profile.sparkSession) as scratch:
        profile = scratch.table(profile, "profile")
        named = profile.filter(F.col("lang").isNotNull())
        languages = sorted(row.lang for row in named.select("lang").distinct().collect())
        sizes = sorted(row.n for row in named.select("n").distinct().collect())
        return save_gram_model(
            profile_weights(named, eps), languages, sizes, unknown=C.UNKNOWN, path=path
        )


def labeler(
    guesser: GramModel,
    text: str = C.FILTERED,
    out: str = C.LABEL,
    limit: int = BROADCAST_BYTES,
    fold: bool = False,
) -> Callable[[DataFrame], DataFrame]:
    """A ``DataFrame -> DataFrame`` step that adds the guessed language.

    ``fold`` is for profiles with one character for a whole script, see ``fold_profile``.
    """

    def label(df: DataFrame) -> DataFrame:
        if not fold:
            return predict(df, text, out, guesser, limit)
        own = f"{out}_folded"
        return predict(df.withColumn(own, folded(F.col(text))), own, out, guesser, limit).drop(own)

    return label
