"""Compression of vectors to short codes: one codebook per part, searched by Orchard's method.

Every entry of a codebook has a list of all entries, sorted by their distance from it. A search holds
one entry and goes through that entry's list: an entry that is nearer to the vector is jumped to, whose
list goes on; entries once looked at are marked and never measured again; beyond twice the present
distance no entry of the list can be nearer, so the search is over. All numbers are whole, so distances,
ties and means are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

from .joins import small
from .topk import usable

# Parts of a vector, entries of a codebook, rounds of fitting, scale of components.
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

# Scaled components beyond this size count as this, so that no sum of squares leaves 64 bits.
LARGEST = 1 << 22

# Vectors that are searched for at a time, and entries of a list that are looked at in a turn.
PASS = 2_048
TURN = 8

# Codebooks: whole numbers, part by entry by place.
Codebooks = np.ndarray


def vectors_of(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors end in zeros."""
    flat = column.flatten().to_numpy().astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Lists:
    """The entries of one codebook and, for each, all entries by distance (then by number)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(entry, squared distance)`` of the nearest entry of each point; of several the first."""
        count, total = len(points), len(self.entries)
        entry = np.zeros(count, dtype=np.int64)
        best = ((points - self.entries[0]) ** 2).sum(axis=1)
        place = np.zeros(count, dtype=np.int64)  # in the list of the present entry
        marked = np.zeros((count, total), dtype=bool)
        marked[:, 0] = True
        going = np.arange(count)
        while len(going):
            places = place[going, None] + np.arange(TURN)
            inside = places < total
            places = np.minimum(places, total - 1)
            lists = entry[going, None]
            others = self.order[lists, places]
            # Squared: beyond twice the distance is beyond four times its square.
            inside &= self.apart[lists, places] <= 4 * best[going, None]
            row, turn = np.nonzero(inside & ~marked[going[:, None], others])
            at, other = going[row], others[row, turn]
            marked[at, other] = True
            found = np.full(others.shape, np.iinfo(np.int64).max)
            found[row, turn] = ((points[at] - self.entries[other]) ** 2).sum(axis=1)
            least = found.min(axis=1)
            first = np.where(found == least[:, None], others, total).min(axis=1)
            jumps = (least < best[going]) | ((least == best[going]) & (first < entry[going]))
            moved = going[jumps]
            entry[moved], best[moved], place[moved] = first[jumps], least[jumps], 0
            place[going[~jumps]] += TURN
            going = going[jumps | inside.all(axis=1)]
        return entry, best


def nearest_entries(vectors: np.ndarray, lists: list[Lists]) -> tuple[np.ndarray, np.ndarray]:
    """``(entries, squared distances)``, one column per part."""
    size = vectors.shape[1] // len(lists)
    found = [
        each.nearest(vectors[:, part * size : (part + 1) * size])
        for part, each in enumerate(lists)
    ]
    return np.stack([e for e, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def whole_vectors(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``(vec_id, label, vector)`` of the usable rows, components as whole numbers."""
    bound = lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x))
    whole = F.transform(
        F.col("raw"), lambda x: F.floor(bound(F.lit(float(SCALE)) * x)).cast("int")
    )
    return (
        df.select(
            F.col(key).cast("long").alias("vec_id"),
            F.col(label).alias("label"),
            F.col(vector).cast("array<double>").alias("raw"),
        )
        .filter(usable(F.col("raw")))
        .select("vec_id", "label", whole.alias("vector"))
    )


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), PASS):
            yield batch.slice(low, PASS)


def refit(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks whose entries are the means, rounded down, of the parts nearest to them.

    Tasks add up counts and sums per entry; a task's result and what comes to the driver have the size
    of the codebooks. Entries that no part is nearest to stay.
    """
    parts, total, size = books.shape
    schema = pa.schema(
        [("part", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [Lists(book) for book in books]
        sums = np.zeros((parts, total, size + 1), dtype=np.int64)  # the count stands last
        for batch in _batches(batches):
            vectors = vectors_of(batch.column(0), parts * size)
            entries, _ = nearest_entries(vectors, lists)
            for part in range(parts):
                own = vectors[:, part * size : (part + 1) * size]
                np.add.at(sums[part, :, :size], entries[:, part], own)
                sums[part, :, size] += np.bincount(entries[:, part], minlength=total)
        part, entry = np.nonzero(sums[:, :, size])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
            ],
            schema=schema,
        )

    counted = (
        rows.select("vector")
        .mapInArrow(run, "part int, entry int, sums array<long>")
        .select("part", "entry", F.posexplode("sums").alias("place", "value"))
        .groupBy("part", "entry", "place")
        .agg(F.sum("value").alias("value"))
    )
    sums = np.zeros((parts, total, size + 1), dtype=np.int64)
    for part, entry, place, value in counted.collect():
        sums[part, entry, place] = value
    counts = sums[:, :, size :]
    return np.where(counts > 0, sums[:, :, :size] // np.maximum(counts, 1), books)


def fit(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks for rows ``(vec_id, vector)`` of whole numbers.

    They start as the parts of the ``entries`` rows with the smallest ids (of rows that share an id
    those with smaller vectors first, rows without an id last); with fewer rows there are fewer
    entries. Vectors are cut into ``parts`` of equal size; where lengths differ, or can't be divided,
    shorter ones count as ending in zeros.
    """
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    size = -(-width // parts)
    order = [F.asc_nulls_last("vec_id"), "vector"]
    first = rows.select("vec_id", "vector").orderBy(*order).limit(entries).collect()
    books = np.zeros((parts, len(first), size), dtype=np.int64)
    for number, (_, vector) in enumerate(first):
        whole = np.array(vector + [0] * (parts * size - len(vector)), dtype=np.int64)
        books[:, number] = whole.reshape(parts, size)
    for _ in range(rounds if len(first) else 0):
        books = refit(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``(vec_id, label, codes, error)``: entry numbers in the order of parts, and the sum of the
    squared distances from them."""
    parts, _, size = books.shape
    kind = rows.schema["label"].dataType
    ddl = f"vec_id long, label {kind.simpleString()}, codes array<int>, error long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [Lists(book) for book in books] if books.shape[1] else []
        for batch in _batches(batches):
            vectors = vectors_of(batch.column(2), parts * size)
            entries, distances = nearest_entries(vectors, lists)
            ends = np.arange(len(entries) + 1, dtype=np.int32) * parts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.ListArray.from_arrays(ends, pa.array(entries.ravel(), pa.int32())),
                    pa.array(distances.sum(axis=1), pa.int64()),
                ],
                names=["vec_id", "label", "codes", "error"],
            )

    return rows.select("vec_id", "label", "vector").mapInArrow(run, ddl)


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """``coded`` with ``vector``: the entries that its codes name, as whole numbers."""
    parts = books.shape[0]
    flat = [F.array(*[F.lit(book[n].tolist()) for n in range(len(book))]) for book in books]
    pieces = [F.get(flat[part], F.col("codes")[part]) for part in range(parts)]
    return coded.withColumn("vector", F.concat(*pieces))


def digest(books: Codebooks) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    df: DataFrame,
    scratch: Scratch,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """``(vec_id, label, codes, error, label_error)`` of every usable row, and the codebooks.

    Vectors that are null or hold a null or a number that isn't finite take no part; rows that share
    an id each have a row. ``label_error`` is the sum over the rows of the same label, nulls together.
    """
    rows = scratch.table(whole_vectors(df, key, vector, label), "vectors")
    books = fit(rows)
    coded = scratch.table(encode(rows, books), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    by_label = scratch.table(by_label, "labels")
    joined = coded.join(
        small(by_label, 64 * by_label.count()), F.col("label").eqNullSafe(F.col("of"))
    )
    return joined.select("vec_id", "label", "codes", "error", "label_error"), books


def code_text(codes: Column) -> Column:
    """Two hex digits per entry number, lowercase."""
    digits = F.transform(codes, lambda code: F.lpad(F.lower(F.hex(code)), 2, "0"))
    return F.array_join(digits, "")


def sql() -> str:
    """The same over a table ``embeddings`` in DuckDB, by measuring every entry."""
    steps = []
    for number in range(ROUNDS + 1):
        steps.append(
            f"""measured{number} AS MATERIALIZED (
                SELECT row, part, entry, piece, apart FROM (
                    SELECT p.row, p.part, e.entry, p.piece,
                        list_sum(list_transform(range(1, len(p.piece) + 1),
                            lambda i: (p.piece[i] - e.piece[i]) ** 2))::BIGINT AS apart
                    FROM pieces p JOIN books{number} e USING (part))
                QUALIFY row_number() OVER (PARTITION BY row, part ORDER BY apart, entry) = 1)"""
        )
        if number < ROUNDS:
            steps.append(
                f"""sums{number} AS (
                    SELECT part, entry, i, floor(sum(piece[i])::DOUBLE / count(*))::BIGINT AS mean
                    FROM measured{number}, unnest(range(1, len(piece) + 1)) AS places(i)
                    GROUP BY ALL),
                means{number} AS (
                    SELECT part, entry, list(mean ORDER BY i) AS piece FROM sums{number}
                    GROUP BY ALL),
                books{number + 1} AS MATERIALIZED (
                    SELECT part, entry, coalesce(m.piece, b.piece) AS piece
                    FROM books{number} b LEFT JOIN means{number} m USING (part, entry))"""
            )
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
            list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS whole
        FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), pieces AS MATERIALIZED (
        SELECT row, part, whole[part * (len(whole) // {PARTS}) + 1
            : (part + 1) * (len(whole) // {PARTS})] AS piece
        FROM kept, unnest(range({PARTS})) AS parts(part)
    ), books0 AS MATERIALIZED (
        SELECT part, row - 1 AS entry, piece FROM pieces WHERE row <= {ENTRIES}
    ), {", ".join(steps)}, coded AS (
        SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
            sum(apart)::BIGINT AS error FROM measured{ROUNDS} GROUP BY row
    ), book AS (
        SELECT sha256(string_agg(piece[i]::VARCHAR, ',' ORDER BY part, entry, i)) AS digest
        FROM books{ROUNDS}, unnest(range(1, len(piece) + 1)) AS places(i)
    )
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
        (SELECT digest FROM book) AS codebooks_sha256
    FROM kept JOIN coded USING (row)
    """
