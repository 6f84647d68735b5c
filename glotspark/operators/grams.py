"""Counting character grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark.functions import char_ngrams

from .coded import counted_in_tasks


def explode_grams(df: DataFrame, text: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """One row per occurrence of an ``n``-gram, with ``keys`` carried along."""
    return df.select(*keys, F.explode(char_ngrams(F.col(text), n, spaced=False)).alias("gram"))


def gram_counts(df: DataFrame, text: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, gram, count)``; counted before the shuffle, so no gram is hot after it."""
    return explode_grams(df, text, n, keys).groupBy(*keys, "gram").agg(F.count("*").alias("count"))


def gram_counts_by_size(
    df: DataFrame, text: str, sizes: Sequence[int], keys: Sequence[str]
) -> DataFrame:
    """``(keys, n, gram, freq)`` for several gram lengths from one pass over the text.

    Tasks count the grams of a piece of text at a time, so that one row per distinct gram of a piece
    goes on to be added up.
    """
    return (
        counted_in_tasks(df, text, sizes, keys)
        .groupBy(*keys, "n", "gram")
        .agg(F.sum("freq").alias("freq"))
    )


def top_grams(df: DataFrame, text: str, n: int, k: int) -> DataFrame:
    """The ``k`` most frequent grams, ties in gram order."""
    return gram_counts(df, text, n).orderBy(F.desc("count"), "gram").limit(k)
