"""Grams of many texts at once: numpy over Arrow batches, for use inside tasks.

Texts of a batch are laid one after another with a line feed behind each, which no normalized text
holds. A gram is known by a number: that of the gram without its last character, times the number of
characters in use, plus that character. Numbers are made dense after every character, so they stay
small whatever the alphabet, and a window that reaches past its text has number 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from glotspark.functions import normalized

# Bytes of text that a numpy pass works on at a time; a longer text is a piece by itself, cut where
# grams are only counted.
PIECE_BYTES = 1 << 20

# Bytes of a batch that Spark sends to a Python worker. Its default suits narrow rows.
BATCH_BYTES = 4 << 20

# Bytes of texts that are joined with the weights of their grams together, and what a row adds.
BLOCK_BYTES = 16 << 20
ROW_BYTES = 16

# Numbers are made dense by a table up to this size, by sorting beyond it.
DIRECT = 1 << 22

SEPARATOR = "\n"


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of this session's Python operators, unless they are smaller already."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    begin = 0
    while begin < len(sizes):
        end = int(np.searchsorted(ends, ends[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), len(sizes))
        yield begin, end
        begin = end


def points_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(points, starts)``: code points of the texts, a separator behind each, and where they start."""
    filled = pc.fill_null(texts, "")
    rows = pa.LargeListArray.from_arrays(pa.array([0, len(filled)], pa.int64()), filled)
    joined = pc.binary_join(rows, pa.scalar(SEPARATOR, filled.type))[0].as_buffer()
    text = (joined.to_pybytes() if joined else b"").decode("utf-8", "replace") + SEPARATOR
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.flatnonzero(points == ord(SEPARATOR))
    return points, np.concatenate(([0], ends[:-1] + 1))


def shifted(values: np.ndarray, by: int) -> np.ndarray:
    """The values ``by`` places further on, zeros past the end."""
    if not by:
        return values
    out = np.zeros_like(values)
    out[:-by] = values[by:]
    return out


def dense(codes: np.ndarray, span: int) -> tuple[np.ndarray, int]:
    """``(numbers, count)``: codes below ``span`` numbered from 1, 0 stays 0."""
    if span <= DIRECT:
        seen = np.zeros(span, dtype=bool)
        seen[codes] = True
        seen[0] = False
        kinds = np.flatnonzero(seen)
        numbers = np.zeros(span, dtype=np.int32)
        numbers[kinds] = np.arange(1, len(kinds) + 1)
        return numbers[codes], len(kinds)
    kinds, numbers = np.unique(codes, return_inverse=True)
    if kinds[0] == 0:
        return numbers.astype(np.int32), len(kinds) - 1
    return numbers.astype(np.int32) + 1, len(kinds)


# ---- counting -------------------------------------------------------------------------------


def _groups(columns: Sequence[pa.Array], rows: int) -> np.ndarray:
    """A number per row, equal for rows with equal keys only."""
    number = np.zeros(rows, dtype=np.int64)
    for column in columns:
        if pa.types.is_nested(column.type):
            return np.arange(rows)
        coded = pc.dictionary_encode(column, null_encoding="encode")
        own = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        number = np.unique(number * len(coded.dictionary) + own, return_inverse=True)[1]
    return number


def spelt(grams: np.ndarray) -> pa.Array:
    """Strings of the rows of a table of code points."""
    sizes = 1 + (grams >= 0x80) + (grams >= 0x800) + (grams >= 0x10000)
    ends = np.concatenate(([0], np.cumsum(sizes.sum(axis=1)))).astype(np.int32)
    data = grams.tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(grams), pa.py_buffer(ends), pa.py_buffer(data))


def counted(
    points: np.ndarray, starts: np.ndarray, groups: np.ndarray, sizes: Sequence[int]
) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
    """``(n, texts, grams, counts)`` per gram length: distinct grams of a group of texts, with one text
    that stands for the group."""
    seen = np.zeros(0x110000, dtype=bool)
    seen[points] = True
    seen[ord(SEPARATOR)] = False
    letters = np.flatnonzero(seen)
    base = len(letters) + 1
    lookup = np.zeros(0x110000, dtype=np.int32)
    lookup[letters] = np.arange(1, base)
    digits = lookup[points]
    lengths = np.diff(np.append(starts, len(points)))
    numbers = np.repeat((groups + 1).astype(np.int32), lengths)
    count = int(groups.max()) + 1
    for n in range(1, max(sizes) + 1):
        digit = shifted(digits, n - 1)
        span = (count + 1) * base
        codes = numbers * (np.int32 if span < 1 << 31 else np.int64)(base) + digit
        codes[(digit == 0) | (numbers == 0)] = 0
        numbers, count = dense(codes, span)
        if n not in sizes or not count:
            continue
        times = np.bincount(numbers, minlength=count + 1)[1:]
        places = np.zeros(count + 1, dtype=np.int64)
        places[numbers] = np.arange(len(numbers), dtype=np.int32)
        places = places[1:]
        grams = spelt(points[places[:, None] + np.arange(n)])
        yield n, np.searchsorted(starts, places, side="right") - 1, grams, times


def counted_in_tasks(
    df: DataFrame, text: str, sizes: Sequence[int], keys: Sequence[str], every: bool = False
) -> DataFrame:
    """``(keys, n, gram, freq)``: grams counted per piece of text where the texts lie, to be added up.

    With ``every``, each row of ``df`` also gives one without a gram, whose ``freq`` is 0.
    """
    small_batches(df.sparkSession)
    rows = df.select(*keys, normalized(F.col(text)).alias("gram_text"))
    schema = StructType(rows.schema.fields[:-1])
    schema = schema.add("n", IntegerType()).add("gram", StringType()).add("freq", LongType())
    count, sizes = len(keys), tuple(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in pieces(batch.column(count)):
                part = batch.slice(begin, end - begin)
                columns = [part.column(place) for place in range(count)]
                if every:
                    nothing = [
                        pa.array(np.zeros(len(part), np.int32)),
                        pa.nulls(len(part), pa.string()),
                        pa.array(np.zeros(len(part), np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays([*columns, *nothing], names=names)
                groups = _groups(columns, len(part))
                for n, texts, grams, times in counted(*points_of(part.column(count)), groups, sizes):
                    arrays = [column.take(pa.array(texts)) for column in columns]
                    arrays += [
                        pa.array(np.full(len(grams), n, np.int32)),
                        grams,
                        pa.array(times.astype(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = schema.names
    return rows.mapInArrow(run, schema)


# ---- blocks of texts ----------------------------------------------------------------------------


def in_blocks(texts: DataFrame) -> DataFrame:
    """``texts (key, text)`` with the number of a ``block``: rows that lie together, of about
    ``BLOCK_BYTES``. Which rows these are depends on the partitions, so write them before use."""
    small_batches(texts.sparkSession)
    schema = StructType([*texts.schema, StructField("block", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for begin, end in pieces(batch.column(1), min(PIECE_BYTES, BLOCK_BYTES)):
                part = batch.slice(begin, end - begin)
                size = (pc.sum(pc.binary_length(part.column(1))).as_py() or 0) + ROW_BYTES * len(part)
                if filled and filled + size > BLOCK_BYTES:
                    number, filled = number + 1, 0
                filled += size
                block = pa.array(np.full(len(part), number, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns, block], names=schema.names)

    return texts.mapInArrow(run, schema)


def grams_by_block(texts: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``(block, gram, texts)`` of ``(key, text, block)`` with normalized texts: the distinct grams of a
    block, and in how many of its texts each may stand at most."""
    small_batches(texts.sparkSession)
    sizes = tuple(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in pieces(batch.column(1)):
                part = batch.slice(begin, end - begin)
                groups = _groups([part.column(0)], len(part))
                rows = np.bincount(groups)
                for _, stands, grams, times in counted(*points_of(part.column(1)), groups, sizes):
                    most = np.minimum(times, rows[groups[stands]])
                    blocks = part.column(0).take(pa.array(stands))
                    arrays = [blocks, grams, pa.array(most.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["block", "gram", "texts"])

    found = texts.select("block", "text").mapInArrow(run, "block long, gram string, texts long")
    return found.groupBy("block", "gram").agg(F.sum("texts").alias("texts"))


# ---- looking grams up -----------------------------------------------------------------------


@dataclass(frozen=True)
class Trie:
    """Grams as nodes, with all their prefixes; node 0 is the empty text.

    ``letters`` are the characters in use, in order. A level has the sorted codes of its nodes, which
    are numbered through from the first level on.
    """

    letters: np.ndarray
    levels: tuple[np.ndarray, ...]

    @property
    def base(self) -> int:
        return len(self.letters) + 1

    @property
    def nodes(self) -> int:
        return 1 + sum(map(len, self.levels))

    def reader(self, deepest: bool) -> Callable[[np.ndarray], Iterator[np.ndarray]]:
        """What finds the nodes of texts: per length the node of the gram at each position, 0 for grams
        outside, or with ``deepest`` once the node of the longest known gram."""
        largest = (1 + max(map(len, self.levels), default=0)) * self.base
        kind = np.int32 if largest < 1 << 31 else np.int64
        lookup = np.zeros(0x110000, dtype=kind)
        lookup[self.letters] = np.arange(1, self.base)
        slots, before = [], 0
        for keys in self.levels:
            size, slot = (before + 1) * self.base, None
            if size <= DIRECT:
                slot = np.zeros(size, dtype=kind)
                slot[keys] = np.arange(1, len(keys) + 1)
            slots.append(slot)
            before = len(keys)

        def read(points: np.ndarray) -> Iterator[np.ndarray]:
            digits = lookup[points]
            place = np.zeros(len(points), dtype=kind)
            node = np.zeros(len(points), dtype=np.int32)
            offset = 0
            for n, (keys, slot) in enumerate(zip(self.levels, slots)):
                codes = place * kind(self.base) + shifted(digits, n)
                if slot is not None:
                    place = slot[codes]
                elif len(keys):
                    row = np.searchsorted(keys, codes)
                    row[row == len(keys)] = 0
                    place = np.where(keys[row] == codes, row + 1, 0).astype(kind)
                found = np.where(place > 0, place + kind(offset), node if deepest else kind(0))
                offset += len(keys)
                if deepest:
                    node = found
                else:
                    yield found
            if deepest:
                yield node

        return read


def trie_of(grams: Sequence[str], lengths: np.ndarray) -> tuple[Trie, np.ndarray, np.ndarray]:
    """``(trie, node, parents)``: the node of every gram, and the node before every node."""
    spelt = "".join(grams).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(spelt, dtype=np.uint32)
    begins = np.cumsum(lengths, dtype=np.int64) - lengths
    # Line feeds part the texts; a gram with one can't occur in a normalized text.
    letters = np.unique(points)
    letters = letters[letters != ord(SEPARATOR)]
    base = len(letters) + 1
    place = np.zeros(len(grams), dtype=np.int64)
    node = np.zeros(len(grams), dtype=np.int64)
    alive = np.ones(len(grams), dtype=bool)
    levels, parents, offset, before = [], [np.zeros(1, np.int64)], 1, 0
    for n in range(int(lengths.max()) if len(lengths) else 0):
        at = np.flatnonzero(alive & (lengths > n))
        letter = points[begins[at] + n]
        alive[at[letter == ord(SEPARATOR)]] = False
        at, letter = at[letter != ord(SEPARATOR)], letter[letter != ord(SEPARATOR)]
        last = np.searchsorted(letters, letter) + 1
        keys, inverse = np.unique(place[at] * base + last, return_inverse=True)
        place[at] = inverse + 1
        node[at] = inverse + offset
        above = keys // base
        parents.append(np.where(above > 0, above + before - 1, 0) if n else above * 0)
        levels.append(keys)
        before, offset = offset, offset + len(keys)
    node[~alive] = -1
    return Trie(letters, tuple(levels)), node, np.concatenate(parents)


def summed(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows of every text; a text has a row at least, that of its separator."""
    return np.add.reduceat(values, starts, axis=0)


def scores_of(
    batches: Iterator[pa.Array],
    score: Callable[[np.ndarray, np.ndarray], np.ndarray],
    width: int,
    kind: pa.DataType,
) -> Iterator[pa.Array]:
    """Lists of ``width`` numbers per text; ``score`` gets the texts of a piece, see ``points_of``."""
    # The numbers of a piece stay in the cache.
    limit = max(1, PIECE_BYTES // max(4, width))
    for texts in batches:
        found = [
            score(*points_of(texts.slice(begin, end - begin))) for begin, end in pieces(texts, limit)
        ]
        values = np.concatenate(found) if found else np.empty((0, width))
        offsets = np.arange(0, values.size + 1, width, dtype=np.int32)
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))
