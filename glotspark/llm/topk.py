"""Exact top-k search by inner product: columnar branch and bound.

Queries meet candidates block by block. A task holds one block of queries and streams candidates in
vertical layout, dimension by dimension. Scores are accumulated over a few dimensions at a time; a
pair can gain at most the product of the two remaining lengths (Cauchy-Schwarz), and a pair whose
score and gain together stay below the query's k-th best so far is dropped. The columns of
candidates that no query needs any more are compacted away; once few pairs are left, only these are
carried on. Vectors are whole numbers, so all sums are exact and nothing is lost to rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 10
SCALE = 1024.0

# Queries that candidates are compared with at a time, and those that a task holds, by number and by
# bytes; candidates of one block at most on average, and of one numpy pass.
QUERY_BLOCK = 512
ASKED = 16_384
ASKED_BYTES = 32 << 20
CANDIDATE_BLOCK = 16_384
PASS = 2_048
DIMENSIONS = 16

# Below this share of surviving pairs they are carried on one by one.
SPARSE = 0.05


def usable(vector: Column) -> Column:
    """No null vector, no null, infinite or undefined component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def whole_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones end in zeros."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, places] = np.floor(SCALE * flat)
    return out


def _tails(matrix: np.ndarray) -> np.ndarray:
    """Length of what is left of every row from each block of dimensions on; rounded up."""
    blocks = range(0, matrix.shape[1], DIMENSIONS)
    squares = np.stack([(matrix[:, b : b + DIMENSIONS] ** 2).sum(1) for b in blocks], axis=1)
    left = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(left) * (1 + 1e-9) + 1e-6


class Best:
    """The k best candidates of every query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.tails = _tails(vectors)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        columns = np.ascontiguousarray(vectors.T)  # vertical layout
        tails = _tails(vectors)
        worst = self.scores[:, -1]
        kept = np.arange(len(ids))
        scores = np.zeros((len(self.ids), len(ids)))
        alive = self.ids[:, None] != ids[None, :]
        pairs = None
        for number, begin in enumerate(range(0, len(columns), DIMENSIONS)):
            block = columns[begin : begin + DIMENSIONS]
            mine = self.vectors[:, begin : begin + DIMENSIONS]
            if pairs is None:
                scores += mine @ block[:, kept]
            else:
                q, c = pairs
                values = values + np.einsum("ij,ji->i", mine[q], block[:, c])  # noqa: F821
            if number + 1 == self.tails.shape[1]:
                break
            if pairs is None:
                gain = self.tails[:, number + 1, None] * tails[kept, number + 1]
                alive &= scores + gain >= worst[:, None]
                needed = alive.any(axis=0)
                if not needed.all():
                    kept, scores, alive = kept[needed], scores[:, needed], alive[:, needed]
                if alive.sum() <= SPARSE * alive.size:
                    q, c = np.nonzero(alive)
                    values, pairs = scores[q, c], (q, kept[c])
            else:
                gain = self.tails[q, number + 1] * tails[c, number + 1]
                needed = values + gain >= worst[q]
                values, pairs = values[needed], (q[needed], c[needed])
        if pairs is None:
            alive &= scores >= worst[:, None]
            q, c = np.nonzero(alive)
            values, pairs = scores[q, c], (q, kept[c])
        q, c = pairs
        better = values >= worst[q]
        self._take(q[better], values[better], ids[c[better]])

    def _take(self, queries: np.ndarray, values: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(queries)
        q = np.concatenate([queries, np.repeat(touched, self.k)])
        s = np.concatenate([values, self.scores[touched].ravel()])
        i = np.concatenate([ids, self.found[touched].ravel()])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top = rank < self.k
        self.scores[q[top], rank[top]] = s[top]
        self.found[q[top], rank[top]] = i[top]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        real = np.isfinite(self.scores)
        q, _ = np.nonzero(real)
        return self.ids[q], self.found[real], self.scores[real].astype(np.int64)


def search(
    df: DataFrame,
    is_query: Column,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other rows of every query row.

    Ties go to the smaller id. Rows without an id, and vectors that are null or hold a null or a
    number that isn't finite, take no part; a vector shorter than another counts as ending in
    zeros; rows with the query's own id are not its candidates, other copies of its vector are. A
    query without candidates has no rows, and of repeated query rows each id is answered once.

    Candidates are dealt to blocks, and queries to as few sets as tasks can hold: the candidates are
    copied once per set, the queries once per block. Within a task a set is gone through in smaller
    blocks. What comes back are k rows per query and block: no more than that is ever sorted.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    counts = rows.agg(
        F.count("*"), F.count_if("asks"), F.max(F.size("vector"))
    ).first()
    width = max(1, counts[2] or 1)
    held = max(QUERY_BLOCK, min(ASKED, ASKED_BYTES // (8 * width)))
    query_blocks = -(-counts[1] // held) or 1
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-counts[0] // CANDIDATE_BLOCK), min(slots, -(-counts[0] // PASS))) or 1

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    part = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    ask = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("int")
    candidates = rows.select(
        every(query_blocks).alias("ask"), part.alias("part"), F.lit(1).alias("role"),
        "vec_id", "vector",
    )
    asking = rows.filter("asks").select(
        ask.alias("ask"), every(blocks).alias("part"), F.lit(0).alias("role"), "vec_id", "vector"
    )
    dealt = (
        asking.union(candidates)
        .repartition("ask", "part")
        .sortWithinPartitions("ask", "part", "role", "vec_id")
    )
    schema = pa.schema(
        [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, blocks, waiting = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            for best in blocks:
                columns = [pa.array(column, pa.int64()) for column in best.rows()]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            groups = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.flatnonzero((groups[1:] != groups[:-1]).any(axis=1)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(groups)]):
                here, asks = tuple(groups[begin, :2].tolist()), groups[begin, 2] == 0
                if here != present:
                    yield from close()
                    present, blocks, waiting = here, [], []
                for low in range(begin, end, PASS):
                    slice_ = batch.slice(low, min(PASS, end - low))
                    ids = slice_.column(3).to_numpy()
                    vectors = whole_matrix(slice_.column(4), width)
                    if asks:
                        waiting.append((ids, vectors))
                        continue
                    if waiting:
                        ask_ids = np.concatenate([one for one, _ in waiting])
                        ask_ids, once = np.unique(ask_ids, return_index=True)
                        asked = np.concatenate([one for _, one in waiting])[once]
                        blocks = [
                            Best(ask_ids[i : i + QUERY_BLOCK], asked[i : i + QUERY_BLOCK], k)
                            for i in range(0, len(ask_ids), QUERY_BLOCK)
                        ]
                        waiting = []
                    for best in blocks:
                        best.offer(ids, vectors)
        yield from close()

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def sql(k: int = K, divisor: int = 100) -> str:
    """The same over a table ``embeddings`` in DuckDB, by comparing all pairs."""
    return f"""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {divisor} = 0
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
        FROM scored
    ) WHERE rank <= {k}
    """
