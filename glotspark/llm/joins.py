"""Joins of large texts with small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

# A table below this size is sent to all executors; beyond it both sides of a join are shuffled.
SMALL_BYTES = 64 * 1024 * 1024


def small(df: DataFrame, bound: int) -> DataFrame:
    """Marks ``df`` for sending to all executors where ``bound`` says that it is small: what its rows
    hold at most, in bytes, from a count of these rows."""
    return F.broadcast(df) if bound <= SMALL_BYTES else df


def text_key(text: Column) -> list[Column]:
    """Two hashes, ``mark`` and ``twin``, that know a text by 128 bits; null and empty differ."""
    return [
        F.xxhash64(text).alias("mark"),
        F.xxhash64(F.lit(1), text, F.isnull(text)).alias("twin"),
    ]


def one_each(
    docs: DataFrame, key: list[str], scratch: Scratch, keys: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(rows, several)``: of the rows ``(*key, text)`` one per key, ``copied`` where there were more,
    and the keys of those. Only rows of such keys are shuffled, combined first. ``keys`` are the keys of
    all rows, where a narrower table has them.
    """
    counted = (docs if keys is None else keys).groupBy(*key).agg(F.count("*").alias("rows"))
    several = scratch.table(counted.filter("rows > 1").select(*key), "several")
    count = several.count()
    if not count:
        return docs.select(*key, "text", F.lit(False).alias("copied")), several
    bound = 16 * len(key) * count
    repeated = docs.join(small(several, bound), key, "left_semi")
    once = scratch.table(
        repeated.groupBy(*key).agg(F.min("text").alias("text"), F.lit(True).alias("copied")), "texts"
    )
    single = docs.join(small(several, bound), key, "left_anti")
    return single.select(*key, "text", F.lit(False).alias("copied")).union(once), several


def positional(df: DataFrame) -> DataFrame:
    """``df`` with columns named by their places, so that no name of its own can be in the way."""
    return df.toDF(*[f"column{place}" for place in range(len(df.columns))])
