"""Folds in which every label has its share, to a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glotspark import columns as C
from glotspark.functions.storage import BROADCAST_BYTES, Scratch

# Rows that are equal in the order columns are spread over this many ranges at most.
SPREAD = 1024


def stratified_folds(
    df: DataFrame,
    folds: int,
    scratch: Scratch,
    label: str = C.LABEL,
    order: Sequence[str] = (C.FILTERED,),
    fold: str = "fold",
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with column ``fold``: a row's rank within its label, in the order of some columns, modulo
    ``folds``. So the folds of a label differ by one row at most.

    No label is numbered as a whole. Rows are sorted into ranges, whatever their labels; each range
    numbers the rows of every label by itself, and a table of one row per range and label tells how
    many came before. A label with a third of all rows, or a value that many rows share, is spread over
    ranges like any other. Of rows equal in all order columns any may come first. Null labels are a label.
    """
    own = ["range_", "salt_", "rank_", "before_", "of_range", "of_label"]
    salted = df.withColumn(
        "salt_", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))
    )
    keys = [F.col(name).asc_nulls_first() for name in order]
    parts = [*keys, "salt_"]
    sorted_ = salted.repartitionByRange(ranges, *parts) if ranges else salted.repartitionByRange(*parts)
    # Written, as a second look at the ranges could cut them elsewhere.
    ranged = scratch.table(sorted_.withColumn("range_", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("range_", label).orderBy(*parts)
    numbered = ranged.withColumn("rank_", F.row_number().over(within))
    counts = ranged.groupBy("range_", label).agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy(label).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    shifts = scratch.table(
        counts.select(
            F.col("range_").alias("of_range"),
            F.col(label).alias("of_label"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before_"),
        ),
        "shifts",
    )
    if shifts.count() * 128 <= BROADCAST_BYTES:
        shifts = F.broadcast(shifts)
    same = (F.col("range_") == F.col("of_range")) & F.col(label).eqNullSafe(F.col("of_label"))
    position = F.col("before_") + F.col("rank_") - 1
    placed = numbered.join(shifts, same)
    return placed.withColumn(fold, F.pmod(position, F.lit(folds)).cast("int")).drop(*own)
