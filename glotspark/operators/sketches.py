"""Counters of bounded size over values of unbounded number: count-min sketches as DataFrames.

A value adds to one slot in each of a few rows of counters; the least of its slots is at least its count.
Tasks add up their slots before the shuffle, so it carries no more rows per task than the sketch has
slots, whatever the vocabulary. What is asked of a sketch here is which slots reach a count: one bit
each, sent with the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 1 << 18
DEPTH = 2


def slots(value: Column, width: int = WIDTH, depth: int = DEPTH) -> list[Column]:
    """The slot of a value in each row of counters, numbered through."""
    return [
        (F.pmod(F.xxhash64(value, F.lit(row)), F.lit(width)) + F.lit(row * width)).cast("int")
        for row in range(depth)
    ]


@dataclass(frozen=True)
class Frequent:
    """Which slots of a sketch have reached a count."""

    words: tuple[int, ...]
    width: int
    depth: int

    def may_be(self, value: Column) -> Column:
        """True for every value that has reached the count; for a few others too."""
        bits = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        tests = [
            F.getbit(F.get(bits, F.shiftright(slot, 6)), F.pmod(slot, F.lit(64))) == 1
            for slot in slots(value, self.width, self.depth)
        ]
        found = tests[0]
        for test in tests[1:]:
            found &= test
        return found

    @property
    def count(self) -> int:
        return sum(word.bit_count() if word >= 0 else (word + (1 << 64)).bit_count() for word in self.words)


def frequent(
    values: DataFrame, value: Column, weight: Column, least: int,
    width: int = WIDTH, depth: int = DEPTH,
) -> Frequent:
    """The slots of the values whose weights add up to ``least`` or more, by one pass."""
    numbered = values.select(
        F.explode(F.array(*slots(value, width, depth))).alias("slot"), weight.alias("weight")
    )
    full = numbered.groupBy("slot").agg(F.sum("weight").alias("weight")).filter(F.col("weight") >= least)
    # At most one number per slot, whatever the values.
    found = full.select("slot").toArrow()["slot"].to_numpy().astype(np.int64)
    bits = np.zeros(width * depth, dtype=np.uint8)
    bits[found] = 1
    words = np.packbits(bits, bitorder="little").view("<i8")
    return Frequent(tuple(words.tolist()), width, depth)
