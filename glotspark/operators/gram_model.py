"""A linear model over exact character grams, scored without moving the texts.

The language guesser and the exact-gram Naive Bayes are both of the form

    score(text, class) = intercept(class) + sum over grams of weight(gram, class)

Weights are whole numbers of micro-nats, so a score does not depend on the order of summation:
every plan, retry and partitioning gives the same answer, ties included.

``predict`` sends the weight table to the executors and scores each text where it lies: no shuffle,
no key. A table above a bound is sent in slices of that size, one after the other; every slice adds
its part of the scores to the rows, so the answers do not depend on the table's size.
``predict_by_join`` is the same as a join of the grams of blocks of texts with the weight table.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from glotspark.functions import normalized
from glotspark.functions.storage import BROADCAST_BYTES, Scratch, new_path

from .coded import (
    Trie,
    grams_by_block,
    in_blocks,
    pieces,
    points_of,
    scores_of,
    small_batches,
    summed,
    trie_of,
)
from .sketches import frequent

MICRO = 1_000_000

# Texts of a gram beyond which its weights go to the texts instead of meeting them by a shuffle.
HEAVY = 100_000

# A slice of a weight table is not made smaller than this.
SLICE_BYTES = 1024 * 1024


def micro(value: Column) -> Column:
    """Whole micro-nats of a logarithmic weight."""
    return F.round(value * F.lit(float(MICRO))).cast("long")


@dataclass(frozen=True)
class GramModel:
    """Classes in tie-breaking order, and the path of the weight table ``(n, gram, w0, w1, ...)``.

    ``unknown`` is the answer for a text none of whose grams is in the table; without it such a
    text is decided by the intercepts.
    """

    path: str
    sizes: tuple[int, ...]
    classes: tuple[str, ...]
    intercepts: tuple[int, ...]
    unknown: str | None
    rows: int

    @property
    def nbytes(self) -> int:
        """Size of the weight table in memory: text key, weights, hash slot."""
        return self.rows * (48 + 8 * (len(self.classes) + 1))

    def slices(self, limit: int) -> int:
        """Number of slices of about ``limit`` bytes, one for a table that fits."""
        return max(1, -(-self.nbytes // max(limit, SLICE_BYTES)))

    def table(self, spark: SparkSession) -> DataFrame:
        weights = "".join(f", w{i} long" for i in range(len(self.classes)))
        return spark.read.schema(f"n int, gram string{weights}").parquet(f"{self.path}/weights")

    def copy_to(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("overwrite").parquet(f"{path}/weights")
        replace(self, path=path).save_header(spark)

    def save_header(self, spark: SparkSession) -> None:
        header = json.dumps(
            {
                "sizes": self.sizes,
                "classes": self.classes,
                "intercepts": self.intercepts,
                "unknown": self.unknown,
                "rows": self.rows,
            }
        )
        spark.createDataFrame([(header,)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{self.path}/header")


def load_gram_model(spark: SparkSession, path: str) -> GramModel:
    header = json.loads(spark.read.text(f"{path}/header").first().value)
    return GramModel(
        path,
        tuple(header["sizes"]),
        tuple(header["classes"]),
        tuple(header["intercepts"]),
        header["unknown"],
        header["rows"],
    )


def save_gram_model(
    weights: DataFrame,
    classes: Sequence[str],
    sizes: Sequence[int],
    intercepts: Sequence[int] | None = None,
    absent: Sequence[int] | None = None,
    unknown: str | None = None,
    path: str | None = None,
) -> GramModel:
    """Store long weights ``(class, n, gram, weight)`` as one row per gram.

    ``absent`` is the weight of a class for a gram that the table holds for other classes only;
    the given weights come on top of it.
    """
    spark = weights.sparkSession
    path = path or new_path(spark, "grams")
    absent = absent or [0] * len(classes)
    intercepts = intercepts or [0] * len(classes)
    columns = [
        (F.coalesce(F.max(F.when(F.col("class") == name, F.col("weight"))), F.lit(0)) + base)
        .cast("long")
        .alias(f"w{position}")
        for position, (name, base) in enumerate(zip(classes, absent))
    ]
    weights.groupBy(F.col("n").cast("int").alias("n"), "gram").agg(*columns).write.parquet(
        f"{path}/weights"
    )
    rows = spark.read.parquet(f"{path}/weights").count()
    model = GramModel(path, tuple(sizes), tuple(classes), tuple(intercepts), unknown, rows)
    model.save_header(spark)
    return model


# Slices that executors keep for the next use, the latest ones.
SENT_TABLES = 8
_sent: OrderedDict = OrderedDict()


def _broadcast_table(context: SparkContext, model: GramModel, number: int, slices: int):
    """One slice of the weight table as a broadcast variable, the same for every use.

    Executors drop those that have not been asked for lately. A frame that still needs one gets it
    from the driver again.
    """
    key = (context.applicationId, model, number, slices)
    if key not in _sent:
        _sent[key] = _send_table(context, model, number, slices)
    _sent.move_to_end(key)
    while len(_sent) > SENT_TABLES:
        (application, *_), oldest = _sent.popitem(last=False)
        if application == context.applicationId:
            oldest.unpersist()
    return _sent[key]


def _send_table(context: SparkContext, model: GramModel, number: int, slices: int):
    """``(trie, sums)`` of one slice: per node the weights of its gram and of all its prefixes, one
    column per class and one that counts hits."""
    table = model.table(SparkSession.builder.getOrCreate())
    if slices > 1:
        table = table.filter(F.pmod(F.xxhash64("gram"), F.lit(slices)) == number)
    weights = [f"w{i}" for i in range(len(model.classes))]
    return context.broadcast(_prefix_sums(table.toArrow(), weights))


def _prefix_sums(table: pa.Table, weights: Sequence[str]) -> tuple[Trie, np.ndarray]:
    """``(trie, sums)`` of rows ``(gram, w0, w1, ...)``, see ``_send_table``."""
    grams = table["gram"].to_pylist()
    trie, node, parents = trie_of(grams, np.array([len(gram) for gram in grams], dtype=np.int64))
    sums = np.zeros((trie.nodes, len(weights) + 1), dtype=np.int64)
    own = np.flatnonzero(node >= 0)
    for position, name in enumerate(weights):
        sums[node[own], position] = table[name].to_numpy()[own]
    sums[node[own], -1] = 1
    offset = 1
    for keys in trie.levels:
        level = slice(offset, offset + len(keys))
        sums[level] += sums[parents[level]]
        offset += len(keys)
    return trie, sums


def _slice_scorer(spark: SparkSession, model: GramModel, number: int, slices: int):
    """A vectorized function ``text -> scores``, one number per class and the hits."""
    shared = _broadcast_table(spark.sparkContext, model, number, slices)
    width = len(model.classes) + 1

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie, sums = shared.value
        read = trie.reader(deepest=True)

        def score(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
            (node,) = read(points)
            return summed(sums.take(node, axis=0), starts)

        yield from scores_of(batches, score, width, pa.int64())

    return F.arrow_udf(predict, "array<long>")


def _choice(model: GramModel, scores: Sequence[Column], hits: Column) -> Column:
    """The class of the highest score, the first of several."""
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    choice = F.coalesce(
        *[F.when(score == best, F.lit(name)) for score, name in zip(scores, model.classes)]
    )
    if model.unknown is not None:
        choice = F.when(hits > 0, choice).otherwise(F.lit(model.unknown))
    return choice


def predict(
    df: DataFrame,
    text: str,
    out: str,
    model: GramModel,
    limit: int = BROADCAST_BYTES,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Add the best class as column ``out``, to every row where it lies.

    A table of several slices is sent slice by slice, and the rows with their scores so far are
    written in between, so that no executor ever holds more than one slice.
    """
    spark = df.sparkSession
    if not model.classes or not model.rows:
        return df.withColumn(out, F.lit(model.unknown).cast("string"))
    slices = model.slices(limit)
    scores = f"{out}_scores"

    def scorer(number: int) -> Callable:
        return _slice_scorer(spark, model, number, slices)

    df = add_scores(df, text, scores, scorer, slices, scratch)
    sums = [
        F.get(scores, F.lit(i)) + F.lit(base) for i, base in enumerate(model.intercepts)
    ]
    return df.withColumn(out, _choice(model, sums, F.get(scores, F.lit(len(sums))))).drop(scores)


def add_scores(
    df: DataFrame,
    text: str,
    scores: str,
    scorer: Callable[[int], Callable],
    slices: int,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Adds the array ``scores``: the sums of what the scorers of all slices give for the text."""
    spark = df.sparkSession
    small_batches(spark)
    scratch = scratch or (Scratch(spark).until_exit() if slices > 1 else None)
    done = None
    for number in range(slices):
        part = scorer(number)(normalized(F.col(text)))
        if number:
            part = F.zip_with(scores, part, lambda x, y: x + y)
        df = df.withColumn(scores, part)
        if number + 1 < slices:
            df, last = scratch.table(df, "scores"), done
            done = df
            if last is not None:
                scratch.drop(last)
    # Generated from a one-element array, so that no expression runs the scorer a second time.
    return df.withColumn(scores, F.explode(F.array(scores)))


def fits_in_memory(model: GramModel, limit: int = BROADCAST_BYTES) -> bool:
    return model.nbytes <= limit


def score_by_join(
    df: DataFrame,
    key: str,
    text: str,
    model: GramModel,
    limit: int = BROADCAST_BYTES,
    heavy: int = HEAVY,
) -> DataFrame:
    """``(key, hits, s0, s1, ...)``: matched grams and scores per class, by joining grams.

    The texts are written in blocks of some MB. The distinct grams of a block meet their weights, then the
    block's texts meet the weights of its own grams, so that a task holds one block and never the table.
    With a table below ``limit`` the join of grams is a broadcast one, above it a shuffle of a row per block
    and gram. A gram that may stand in ``heavy`` texts gets its weights without it, see ``_join_split``.
    """
    spark = df.sparkSession
    scratch = Scratch(spark).until_exit()
    table = model.table(spark).drop("n")
    weights = [f"w{i}" for i in range(len(model.classes))]
    texts = scratch.table(in_blocks(df.select(key, normalized(F.col(text)).alias("text"))), "blocks")
    grams = scratch.table(grams_by_block(texts, model.sizes), "block_grams")
    if fits_in_memory(model, limit):
        joined = grams.join(F.broadcast(table), "gram")
    else:
        joined = _join_split(grams, table, heavy)
    known = joined.select("block", "gram", *weights)
    numbers = ["hits", *[f"s{i}" for i in range(len(weights))]]
    schema = StructType([texts.schema[0], *[StructField(name, LongType()) for name in numbers]])

    def score(block: pa.Table, grams: pa.Table) -> pa.Table:
        trie, sums = _prefix_sums(grams, weights)
        read = trie.reader(deepest=True)
        keys, found = [], []
        for batch in block.to_batches():
            for begin, end in pieces(batch.column(1)):
                points, starts = points_of(batch.column(1).slice(begin, end - begin))
                (node,) = read(points)
                keys.append(batch.column(0).slice(begin, end - begin))
                found.append(summed(sums[node], starts))
        values = np.concatenate(found)
        columns = [pa.chunked_array(keys), pa.array(values[:, -1])]
        columns += [pa.array(values[:, place]) for place in range(len(weights))]
        return pa.table(columns, names=schema.names)

    # Every block has texts; one without a known gram has no rows on the other side.
    scored = texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, schema)
    return scored.groupBy(F.col(scored.columns[0]).alias(key)).agg(
        F.sum("hits").alias("hits"),
        *[(F.sum(f"s{i}") + base).alias(f"s{i}") for i, base in enumerate(model.intercepts)],
    )


def _join_split(grams: DataFrame, table: DataFrame, heavy: int) -> DataFrame:
    """``grams (block, gram, texts)`` with the weights of those that the table holds.

    In how many texts a gram may stand is known from a sketch. The weights of grams that may stand in
    ``heavy`` texts or more go to the blocks; the others meet them by a shuffle, in which no gram has
    that many rows. A sketch of a few slots can't tell heavy grams from more others than its heavy
    slots hold, so what is sent is a small share of the table; beyond the bound it is shuffled too.
    """
    often = frequent(grams, F.col("gram"), F.col("texts"), heavy)
    if not often.count:
        return grams.join(table, "gram")
    is_heavy = F.coalesce(often.may_be(F.col("gram")), F.lit(False))
    known = table.filter(is_heavy)
    row = 48 + 8 * len(table.columns)
    if known.count() * row > BROADCAST_BYTES:
        return grams.join(table, "gram")
    near = grams.filter(is_heavy).join(F.broadcast(known), "gram")
    far = grams.filter(~is_heavy).join(table.filter(~is_heavy), "gram")
    return near.unionByName(far)


def predict_by_join(
    df: DataFrame,
    key: str,
    text: str,
    out: str,
    model: GramModel,
    limit: int = BROADCAST_BYTES,
    heavy: int = HEAVY,
) -> DataFrame:
    """``(key, out)`` for every row of ``df``; ``key`` must be unique and not null."""
    scores = [F.col(f"s{i}") for i in range(len(model.classes))]
    choice = _choice(model, scores, F.col("hits"))
    return score_by_join(df, key, text, model, limit, heavy).select(key, choice.alias(out))
