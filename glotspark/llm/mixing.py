"""Mixing sources to target weights by balanced sampling.

Every source gets a target size: its share of the mix by weight, at most ``CAP`` times what it has;
what is above goes to the others by weight until none is above. A document of a source that is
taken ``r`` times over on average is taken ``floor(r)`` times for sure and once more with the
fractional part as its inclusion probability. These probabilities are rounded by the cube method:
the vector of probabilities moves at random, its mean kept, through the null space of the balance
constraints, the source's total of words and its number of documents, until every entry but as many
as there are constraints is 0 or 1.

One such flight runs per block of a source. What a block leaves over, two documents at most, goes
with the leftovers of other blocks into a block of the next round, until each source is one block.
That last block also gets about ``RESERVE`` documents of the source that have been kept back. Once
no more than ``LANDING`` documents are open in it, the landing gives up the balance of documents and
keeps that of words. The largest document is settled first, against all others together, so that
the one that remains to be drawn by lot is a small one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glotspark.functions.storage import BROADCAST_BYTES, Scratch

from .joins import positional, small

# The weights of the sources in order, repeating, the size of the mix as a share of
# all sizes, and how many times a source and a document may be taken.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
WORD = r"[^\x20\x09-\x0D]+"

# Documents that one flight balances, on average.
BLOCK = 128
RESERVE = 64
LANDING = 16
SEED = 42
_NEAR = 1e-9


def size_of(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---- targets --------------------------------------------------------------------------------


def numbered(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``place``, from 0, in order of code points, null last, without a global window: ranges
    of sources are numbered by themselves and shifted by the sizes of the ranges before."""
    order = F.col("source").asc_nulls_last()
    ranged = scratch.table(
        sources.repartitionByRange(order)
        .withColumn("range", F.spark_partition_id())
        .withColumn("row", F.row_number().over(Window.partitionBy("range").orderBy(order))),
        "sources",
    )
    counts = sorted(ranged.groupBy("range").count().collect())  # one row per partition
    shifts = np.concatenate(([0], np.cumsum([row["count"] for row in counts])))[: len(counts)]
    shift = ranged.sparkSession.createDataFrame(
        [(row["range"], int(start)) for row, start in zip(counts, shifts)],
        "range int, shift long",
    )
    return ranged.join(F.broadcast(shift), "range").withColumn(
        "place", F.col("shift") + F.col("row") - 1
    )


def targets(
    sized: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS, share: float = SHARE
) -> DataFrame:
    """``(source, source_size, target)``, one row per source.

    The shares are a few rounds of one aggregate each: a source that its share would take above
    its cap keeps to the cap, and the rest is shared again. Caps only ever get reached by more
    sources, so the rounds end. Sources without words have target 0.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    rows = scratch.table(
        numbered(totals, scratch).select(
            "source",
            "source_size",
            F.get(cycle, F.pmod("place", F.lit(len(weights)))).alias("weight"),
            (F.lit(CAP) * F.col("source_size")).alias("cap"),
        ),
        "weights",
    )
    everything = rows.agg(F.sum("source_size")).first()[0] or 0
    rate, capped = 0.0, -1
    while True:
        above = F.col("cap") <= F.col("weight") * F.lit(rate)
        state = rows.agg(
            F.count_if(above).alias("capped"),
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("spent"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if state["capped"] == capped or not state["weight"]:
            break
        capped = state["capped"]
        rate = (share * everything - state["spent"]) / state["weight"]
    target = F.least(F.col("cap"), F.col("weight") * F.lit(rate))
    return rows.select("source", "source_size", target.alias("target"))


# ---- the cube method ------------------------------------------------------------------------


class Flight:
    """The flight of one block: at most three documents are in motion at a time."""

    def __init__(self, name: str):
        digest = hashlib.blake2b(name.encode(), digest_size=8).digest()
        self.random = np.random.default_rng(int.from_bytes(digest, "little"))
        self.active: list[list] = []  # [row, size, chance]

    def add(self, row: tuple, size: float, chance: float) -> Iterator[tuple[tuple, float]]:
        """Takes in one document and yields those whose chance has become 0 or 1."""
        self.active.append([row, size, chance])
        while len(self.active) > 2 and (direction := null_vector([a[1] for a in self.active])):
            yield from self.move(direction)

    def move(self, direction: Sequence[float]) -> Iterator[tuple[tuple, float]]:
        chances = [a[2] for a in self.active]
        up = min(
            (1 - p) / u if u > 0 else p / -u for p, u in zip(chances, direction) if u
        )
        down = min(p / u if u > 0 else (1 - p) / -u for p, u in zip(chances, direction) if u)
        # The mean stays: a long way is taken as rarely as it is long.
        step = up if self.random.random() * (up + down) < down else -down
        kept = []
        for entry, u in zip(self.active, direction):
            entry[2] = entry[2] + step * u
            if entry[2] < _NEAR or entry[2] > 1 - _NEAR:
                yield entry[0], float(round(entry[2]))
            else:
                kept.append(entry)
        self.active = kept

    def rest(self) -> Iterator[tuple[tuple, float]]:
        """What is left when the block ends."""
        while len(self.active) > 1 and self.active[0][1] == self.active[1][1]:
            yield from self.move([1.0, -1.0])
        for row, _, chance in self.active:
            yield row, chance
        self.active = []

    def land(self, block: Sequence[tuple]) -> Iterator[tuple[tuple, float]]:
        """Rounds a whole block; ``block`` is that of the last round.

        The largest open document moves, and all others together make up for it.
        """
        sizes = np.array([row[1] for row in block], dtype=np.float64)
        chances = np.array([row[4] for row in block])
        while len(moving := np.flatnonzero((chances > 0) & (chances < 1))):
            size = sizes[moving]
            largest = int(np.argmax(size))
            unit = np.zeros(len(moving))
            unit[largest] = 1.0
            # Every other document moves in proportion to the room it has.
            room = np.minimum(chances[moving], 1 - chances[moving])
            room[largest] = 1.0
            balance = np.stack([size, np.ones(len(moving))])[: 2 if len(moving) > LANDING else 1]
            scaled = balance * room
            gram = scaled @ balance.T
            direction = room * (unit - balance.T @ np.linalg.lstsq(gram, scaled @ unit)[0])
            if len(moving) == 1 or size.sum() == size[largest]:
                direction = unit  # nothing can make up for it
            if abs(direction).max() < _NEAR:  # sizes that are all alike
                direction[largest], direction[largest - 1] = 1.0, -1.0
            direction /= abs(direction).max()
            moves = abs(direction) > _NEAR
            rising = np.where(direction > 0, 1 - chances[moving], chances[moving])
            falling = np.where(direction > 0, chances[moving], 1 - chances[moving])
            up = (rising[moves] / abs(direction[moves])).min()
            down = (falling[moves] / abs(direction[moves])).min()
            step = up if self.random.random() * (up + down) < down else -down
            moved = chances[moving] + step * np.where(moves, direction, 0.0)
            moved[moved < _NEAR] = 0.0
            moved[moved > 1 - _NEAR] = 1.0
            chances[moving] = moved
        for row, chance in zip(block, chances.tolist()):
            yield row, chance


def null_vector(sizes: Sequence[float]) -> list[float]:
    """A direction that changes neither the words nor the number of documents; of three sizes."""
    a, b, c = sizes[:3]
    if a == b:
        return [1.0, -1.0, 0.0]
    if b == c:
        return [0.0, 1.0, -1.0]
    largest = max(abs(b - c), abs(c - a), abs(a - b))
    return [(b - c) / largest, (c - a) / largest, (a - b) / largest]


_ROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("size", pa.int64()),
        ("source", pa.string()),
        ("copy", pa.int64()),
        ("chance", pa.float64()),
        ("block", pa.int64()),
    ]
)
_DDL = "doc_id long, size long, source string, copy long, chance double, block long"


def fly(df: DataFrame, turn: int, seed: int = SEED) -> DataFrame:
    """One flight per ``(source, block)``; blocks stream through, large documents first.

    The order within a block depends on nothing but the rows, so a retry does the same. Where
    ``landing`` is set the block is the only one of its source, and is held whole.
    """
    salt = F.xxhash64("doc_id", "copy", F.lit(seed))
    magnitude = F.floor(F.log2(F.col("size") + 1) / 2)
    dealt = (
        df.repartition("source", "block")
        .sortWithinPartitions(
            "source", "block", F.desc(magnitude), salt, "doc_id", "copy", "chance"
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, flight, held = None, None, []

        def close() -> Iterator[tuple]:
            if flight:
                yield from (flight.land(held) if held else flight.rest())

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in (*_ROW.names, "landing")]
            out: list[tuple] = []
            for *row, landing in zip(*columns):
                here = (row[2], row[5])
                if here != present:
                    out += close()
                    present, held = here, []
                    flight = Flight(f"{seed}:{turn}:{here}")
                if landing:
                    held.append(tuple(row))
                else:
                    out += flight.add(tuple(row), float(row[1]), row[4])
            yield rows(out)
        yield rows(list(close()))

    def rows(out: list) -> pa.RecordBatch:
        done = [(*row[:4], chance, row[5]) for row, chance in out]
        columns = list(zip(*done)) if done else [[] for _ in _ROW]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, _ROW)], schema=_ROW
        )

    return dealt.mapInArrow(run, _DDL)


def rounded(
    df: DataFrame, scratch: Scratch, block: int = BLOCK, seed: int = SEED
) -> DataFrame:
    """``(doc_id, size, source, copy, chance)`` with every chance rounded to 0 or 1.

    ``df`` holds the documents with a chance between 0 and 1.
    """
    totals = df.groupBy("source").agg(F.count("*").alias("total"))
    same = df["source"].eqNullSafe(totals["source"])
    lot = F.pmod(F.xxhash64("copy", "doc_id", F.lit(seed)), F.col("total"))
    open_rows = df.join(totals, same).select(df["*"], (lot < RESERVE).alias("kept_back"))
    closed, turn = [], 0
    while True:
        moving = F.count_if(~F.col("kept_back"))
        blocks = F.greatest(F.ceil(moving / block), F.lit(1))
        counts = open_rows.groupBy("source").agg(blocks.alias("blocks"))
        placed = open_rows.join(counts, open_rows["source"].eqNullSafe(counts["source"])).select(
            open_rows["*"],
            F.pmod(F.xxhash64("doc_id", "copy", F.lit(seed + turn)), F.col("blocks")).alias(
                "block"
            ),
            (F.col("blocks") == 1).alias("landing"),
        )
        waits = F.col("kept_back") & ~F.col("landing")
        flown = scratch.table(fly(placed.filter(~waits), turn, seed), "flight")
        still = (F.col("chance") > 0) & (F.col("chance") < 1)
        closed.append(flown.filter(~still))
        left = flown.filter(still).drop("block").withColumn("kept_back", F.lit(False))
        open_rows = scratch.table(
            left.union(placed.filter(waits).select(*left.columns)), "open"
        )
        turn += 1
        if not open_rows.limit(1).count():
            break
    whole = closed[0]
    for more in closed[1:]:
        whole = whole.union(more)
    return whole.drop("block")


def mix(
    df: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, size, source_size, target, times, taken)``, one row per row of ``df``.

    ``times`` is how often the mix takes the document and ``taken`` the words of all these. A null
    source is a source of its own, listed last; texts that are null or without words have size 0.
    Rows that share an id, or have none, are taken one by one. Reruns give the same result.
    """
    sized = scratch.table(
        df.select(
            F.col(key).cast("long").alias("doc_id"),
            size_of(F.col(text)).alias("size"),
            F.col(source).cast("string").alias("source"),
            F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 40)).alias("copy"),
        ),
        "sized",
    )
    wanted = scratch.table(targets(sized, scratch, weights, share), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Shares that are whole numbers but for rounding leave nothing to chance.
    whole = F.floor(rate + _NEAR)
    rates = wanted.select(
        F.col("source").alias("of_source"),
        "source_size",
        "target",
        whole.alias("whole"),
        F.greatest(rate - whole, F.lit(0.0)).alias("chance"),
    )
    known = rates.agg(F.count("*"), F.sum(F.octet_length("of_source"))).first()
    if (known[0] or 0) * 64 + (known[1] or 0) <= BROADCAST_BYTES:
        rates = F.broadcast(rates)
    rows = sized.join(rates, F.col("source").eqNullSafe(F.col("of_source")))
    drawn = rounded(
        rows.filter(F.col("chance") > _NEAR).select(
            "doc_id", "size", "source", "copy", "chance"
        ),
        scratch,
        block,
        seed,
    )
    certain = rows.filter(F.col("chance") <= _NEAR).select(
        "doc_id", "size", "source", "copy", F.lit(0.0).alias("chance")
    )
    times = (F.col("whole") + F.col("chance").cast("long")).alias("times")
    return (
        drawn.union(certain)
        .join(rates.drop("chance"), F.col("source").eqNullSafe(F.col("of_source")))
        .select("doc_id", "copy", "size", "source_size", "target", times)
        .withColumn("taken", F.col("size") * F.col("times"))
    )


def expand(
    df: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    **options,
) -> DataFrame:
    """The rows and columns of ``df``, each as many times as ``mix`` with these ``options`` takes it."""
    mixed = scratch.table(mix(df, scratch, key, text, source, **options), "mixed")
    of_row = ["doc_id", "copy"]
    numbered = Window.partitionBy(*of_row).orderBy(F.desc("times"))
    # Rows with the same id and text are told apart by a number; most have none of their like.
    times = scratch.table(
        mixed.select(*of_row, "times", F.row_number().over(numbered).alias("number")), "times"
    )
    own = positional(df)
    rows = own.select(
        F.struct(*own.columns).alias("row"),
        F.col(own.columns[df.columns.index(key)]).cast("long").alias("own_id"),
        F.pmod(
            F.xxhash64(own.columns[df.columns.index(text)]), F.lit(1 << 40)
        ).alias("own_copy"),
    )
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_copy") == F.col("copy"))
    repeated = times.filter("number > 1").select(*of_row).distinct()
    alone = times["doc_id"].eqNullSafe(repeated["doc_id"]) & (times["copy"] == repeated["copy"])
    single = small(times.join(repeated, alone, "left_anti"), 40 * times.count())
    taken = rows.join(single, same).select("row", "times")
    if repeated.limit(1).count():
        order = Window.partitionBy("own_id", "own_copy").orderBy(F.xxhash64("row"))
        alike = rows.join(
            small(repeated, 24 * repeated.count()), same, "left_semi"
        ).withColumn("own_number", F.row_number().over(order))
        taken = taken.union(
            alike.join(times, same & (F.col("own_number") == F.col("number"))).select(
                "row", "times"
            )
        )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return taken.filter("times > 0").select("row", each).select("row.*").toDF(*df.columns)
