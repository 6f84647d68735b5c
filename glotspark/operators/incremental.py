"""Rows that have no prediction yet, and one row per key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions.storage import BROADCAST_BYTES, Scratch

# What a row of a hash table holds besides the key's own bytes.
ROW_BYTES = 64


@dataclass(frozen=True)
class FreshKeys:
    """``keys (key, copies)``: the keys of one source that are not predicted yet.

    One pass over the source's key column decides everything that follows: which rows are read,
    how they are found, and which keys stand in several rows.
    """

    keys: DataFrame
    rows: int
    nbytes: int
    repeated: int


def fresh_keys(
    rows: DataFrame, predicted: DataFrame, scratch: Scratch, key: str = C.ID
) -> FreshKeys:
    """A null key is never among the predicted ones, so rows without one count as fresh."""
    keys = scratch.table(
        rows.select(key)
        .join(predicted.select(key), key, "left_anti")
        .groupBy(key)
        .agg(F.count("*").alias("copies")),
        "fresh",
    )
    return measured(keys, key)


def measured(keys: DataFrame, key: str = C.ID) -> FreshKeys:
    """A written table ``(key, copies)`` with the figures that plans are chosen by."""
    size = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + F.lit(ROW_BYTES)
    count, nbytes, repeated = keys.agg(
        F.count("*"), F.sum(size), F.count_if(F.col("copies") > 1)
    ).first()
    return FreshKeys(keys, count, nbytes or 0, repeated)


def only_fresh(
    rows: DataFrame, fresh: FreshKeys, key: str = C.ID, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows of the fresh keys.

    Where the keys are few, by their measured bytes, they go to the rows. Otherwise, such as in a
    first run after an import, rows and keys meet by a shuffle; tables bucketed by the key skip it.
    """
    if not fresh.rows:
        return rows.limit(0)
    keys = fresh.keys.select(F.col(key).alias("fresh_key"))
    if fresh.nbytes <= limit:
        keys = F.broadcast(keys)
    return rows.join(keys, F.col(key).eqNullSafe(F.col("fresh_key")), "left_semi")


def unpredicted(
    rows: DataFrame, predicted: DataFrame, key: str = C.ID, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows whose key is not among the predicted ones (``rows LEFT JOIN predicted ... IS NULL``)."""
    scratch = Scratch(rows.sparkSession).until_exit()
    return only_fresh(rows, fresh_keys(rows, predicted, scratch, key), key, limit)


def one_per_key(
    rows: DataFrame, fresh: FreshKeys, key: str = C.ID, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Keep one row per key: the least by the other columns, so reruns keep the same one.

    Only keys that the source holds more than once are looked at; where there are none, as in a
    table with a primary key, the rows pass through untouched. Rows with a null key all stay.
    """
    if not fresh.repeated:
        return rows
    repeated = fresh.keys.filter(f"copies > 1 AND {key} IS NOT NULL").select(key)
    if fresh.nbytes <= limit:
        repeated = F.broadcast(repeated)
    others = [name for name in rows.columns if name != key]
    kept = (
        rows.join(repeated, key, "left_semi")
        .groupBy(key)
        .agg(F.min(F.struct(*others)).alias("row"))
        .select(key, "row.*")
    )
    return rows.join(repeated, key, "left_anti").unionByName(kept.select(*rows.columns))
