"""Scores of hashed Naive Bayes models without feature vectors of the texts.

The distinct grams of the texts are hashed by Spark's own stage, once each, and sent to the tasks with
their buckets. A text's score is the sum of what the buckets of its grams weigh, so all points of a grid
are scored in one pass over the texts. A table above the limit is sent in slices, see ``gram_model``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions import spaced
from glotspark.functions.storage import BROADCAST_BYTES, Scratch

from .coded import counted_in_tasks, scores_of, summed, trie_of
from .gram_model import SLICE_BYTES, add_scores


# Numbers of a table of weights by gram that a task makes at most; beyond it weights are looked up by
# bucket at every place of a text.
TABLE_NUMBERS = 1 << 23


@dataclass
class BucketTable:
    """``table (n, gram, b0, b1, ...)``: the buckets of grams for feature counts ``sizes``."""

    table: DataFrame
    sizes: tuple[int, ...]
    rows: int
    sent: dict = field(default_factory=dict)

    def slices(self, limit: int) -> int:
        return max(1, -(-self.rows * (48 + 4 * len(self.sizes)) // max(limit, SLICE_BYTES)))

    def send(self, number: int, slices: int):
        """``(trie, buckets)`` of one slice as a broadcast variable; a node without a gram of the table
        has the bucket behind the last one."""
        if (number, slices) not in self.sent:
            table = self.table
            if slices > 1:
                table = table.filter(F.pmod(F.xxhash64("gram"), F.lit(slices)) == number)
            found = table.toArrow()
            grams = found["gram"].to_pylist()
            trie, node, _ = trie_of(grams, np.array([len(gram) for gram in grams], dtype=np.int64))
            own, buckets = np.flatnonzero(node >= 0), []
            for place, size in enumerate(self.sizes):
                bucket = np.full(trie.nodes, size, dtype=np.int32)
                bucket[node[own]] = found[f"b{place}"].to_numpy()[own]
                buckets.append(bucket)
            if slices > 1:
                self.sent.clear()
            self.sent[number, slices] = self.table.sparkSession.sparkContext.broadcast((trie, buckets))
        return self.sent[number, slices]


def bucket_table(grams: DataFrame, sizes: Sequence[int], scratch: Scratch) -> BucketTable:
    """The buckets of distinct grams ``(n, gram)``."""
    terms = grams.select("n", "gram", F.array(spaced(F.col("gram"))).alias(C.NGRAMS))
    for place, size in enumerate(sizes):
        hashing = HashingTF(inputCol=C.NGRAMS, outputCol=f"v{place}", numFeatures=size)
        bucket = F.unwrap_udt(F.col(f"v{place}"))["indices"][0].alias(f"b{place}")
        kept = [name for name in terms.columns if name != C.NGRAMS]
        terms = hashing.transform(terms).select(*kept, C.NGRAMS, bucket)
    table = scratch.table(terms.drop(C.NGRAMS), "buckets")
    return BucketTable(table, tuple(sizes), table.count())


def distinct_grams(df: DataFrame, text: str, sizes: Sequence[int]) -> DataFrame:
    """``(n, gram)`` of all texts."""
    return counted_in_tasks(df, text, sizes, []).select("n", "gram").distinct()


def hashed_scores(
    df: DataFrame,
    text: str,
    out: str,
    table: BucketTable,
    models: Sequence[tuple[tuple[int, int], NaiveBayesModel]],
    scratch: Scratch | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds the array ``out``: per model its sums by class, then the number of grams outside the table.

    ``models`` are in the order of their gram lengths.
    """
    context = df.sparkSession.sparkContext
    slices = table.slices(limit)
    weights = []
    for (n, size), model in models:
        theta = model.theta.toArray().T
        none = np.zeros((1, theta.shape[1]))
        weights.append((n, table.sizes.index(size), np.concatenate((theta, none))))
    lengths = sorted({n for (n, _), _ in models})
    width = sum(theta.shape[1] for *_, theta in weights) + 1
    weighed = context.broadcast(weights)

    def scorer(number: int) -> Callable:
        shared = table.send(number, slices)
        least = table.sizes[0]

        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            trie, buckets = shared.value
            read = trie.reader(deepest=False)
            # Per gram length the weights of all its models side by side, and whether a gram is known.
            parts = {
                n: [(place, theta) for m, place, theta in weighed.value if m == n] for n in lengths
            }

            def weights_of(node: np.ndarray, n: int) -> np.ndarray:
                known = (buckets[0][node] < least).astype(np.float64)
                return np.column_stack([*[theta[buckets[at][node]] for at, theta in parts[n]], known])

            tables = {}
            if trie.nodes * width <= TABLE_NUMBERS:
                tables = {n: weights_of(np.arange(trie.nodes), n) for n in lengths}

            def score(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
                nodes = dict(enumerate(read(points), 1))
                nothing = np.zeros(len(points), dtype=np.int32)
                chars = np.diff(np.append(starts, len(points))) - 1
                sums, missing = [], np.zeros(len(starts))
                for n in lengths:
                    node = nodes.get(n, nothing)
                    # Rows are taken several times as fast as by an index of the same rows.
                    rows = tables[n].take(node, axis=0) if tables else weights_of(node, n)
                    found = summed(rows, starts)
                    sums.append(found[:, :-1])
                    missing -= found[:, -1]
                    if not number:
                        missing += np.maximum(chars - n + 1, 0)
                return np.column_stack([*sums, missing])

            yield from scores_of(batches, score, width, pa.float64())

        return F.arrow_udf(predict, "array<double>")

    return add_scores(df, text, out, scorer, slices, scratch)


def best_class(scores: str, model: NaiveBayesModel, begin: int) -> Column:
    """The class index of the highest score, the first of several; sums lie from ``begin`` on."""
    pi = model.pi.toArray().tolist()
    sums = F.slice(F.col(scores), begin + 1, len(pi))
    each = F.zip_with(sums, F.array(*map(F.lit, pi)), lambda total, prior: total + prior)
    return (F.array_position(each, F.array_max(each)) - 1).cast("double")
