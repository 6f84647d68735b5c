"""Removal of repeated strings: a suffix array of what may repeat, by bucket-pointer refinement.

Every byte that lies in a string of ``LENGTH`` bytes which starts at two or more places of the
corpus is removed. A suffix array of the whole corpus would have to be sorted in one piece; here
the initial q-gram buckets are what is distributed:

1. Every start of a string is put in the bucket of one q-gram inside the string, the one with the
   least hash. Equal strings fall in one bucket. Starts next to each other mostly share a q-gram and
   are handled as one run.
2. A bucket with a single run holds no repeat. Runs that are equal as a whole are repeats of each
   other; one of them goes on, marked as known, as it may share strings with unequal runs.
3. Buckets that still hold different runs are refined in tasks. The suffixes of a bucket's runs are
   sorted by their first eight bytes into smaller buckets, and these again and again by the bucket
   pointer of the suffix that starts as many bytes later as are sorted by. Every round reuses the
   pointers that the rounds before have written, so it doubles the sorted length, and leaves out
   the suffixes that are alone in their bucket.
4. Buckets of more than ``GROUP`` different runs are cut first: the bytes common to all strings of
   a few starts, in a grid laid from the bucket's q-gram, make finer buckets, which go through the
   same steps. If that leaves too large a bucket again, its strings are told apart by their hashes.

So no bucket, however common its q-gram, has to fit in a task, and no pairs are formed. Hashes of
128 bits stand for equal strings of unequal runs where step 4 ends, and 64 bits within a bucket for
equal runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

from .arrow import text_pieces
from .joins import one_each, small, text_key
from .words import mix, powers, prefix_hashes

# Fixed value: bytes of a string that must not repeat.
LENGTH = 400

# Bytes of the q-gram that names a bucket.
GRAM = 64

# Different runs of a bucket that are refined in one task, and starts of a cell of the grid.
GROUP = 128
CELL = 32

# Bytes of runs that are refined at a time.
REFINE_BYTES = 1 << 20

_RUN_DDL = "doc long, mark long, start int, starts int, bucket long, whole long"
_RUN_SCHEMA = pa.schema(
    [
        ("doc", pa.int64()),
        ("mark", pa.int64()),
        ("start", pa.int32()),
        ("starts", pa.int32()),
        ("bucket", pa.int64()),
        ("whole", pa.int64()),
    ]
)


# ---- runs of starts -------------------------------------------------------------------------


def gram_hashes(sums: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hashes of all q-grams of a piece of text from its prefix sums."""
    _, down = powers(len(sums))
    return mix((sums[size:] - sums[:-size]) * down[: len(sums) - size])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width``; two running minima per block of that width."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def runs_of(
    values: np.ndarray, offsets: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, starts, bucket)`` of all runs of a piece, places within the piece."""
    gram = min(GRAM, length)
    if len(values) < length:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, np.empty(0, np.uint64)
    grams = gram_hashes(prefix_hashes(values), gram)
    least = sliding_min(grams, length - gram + 1)
    places = np.arange(len(least))
    texts = np.searchsorted(offsets, places, side="right") - 1
    inside = places + length <= offsets[texts + 1]
    opens = inside.copy()
    # A start whose q-gram stands at the start itself is the last that the q-gram serves; another
    # one of the same hash, further on, makes another run, so that no run repeats within itself.
    served = grams[: len(least)] == least
    opens[1:] &= (
        (least[1:] != least[:-1]) | served[:-1] | (texts[1:] != texts[:-1]) | ~inside[:-1]
    )
    begin = np.flatnonzero(opens)
    stop = np.flatnonzero(np.append(opens | ~inside, True))
    end = stop[np.searchsorted(stop, begin, side="right")] if len(begin) else begin
    return texts[begin], begin, end - begin, least[begin]


def all_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc, mark, start, starts, bucket, whole, known)`` of ``(doc, mark, text, copied)``.

    All that a text with copies holds is known to stand elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, offsets in text_pieces(batches):
            texts, begin, starts, bucket = runs_of(values, offsets, length)
            data = values.tobytes()
            whole = [
                xxhash.xxh3_64_intdigest(data[at : at + count + length - 1])
                for at, count in zip(begin.tolist(), starts.tolist())
            ]
            taken = pa.array(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc").take(taken),
                    rows.column("mark").take(taken),
                    pa.array(begin - offsets[texts], pa.int32()),
                    pa.array(starts, pa.int32()),
                    pa.array(bucket.view(np.int64)),
                    pa.array(np.array(whole, dtype=np.uint64).view(np.int64)),
                    rows.column("copied").take(taken),
                ],
                names=[*_RUN_SCHEMA.names, "known"],
            )

    return docs.select("doc", "mark", "text", "copied").mapInArrow(
        run, _RUN_DDL + ", known boolean"
    )


# ---- equal runs, and what is left -----------------------------------------------------------


def sort_out(items: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(repeats, left)`` of runs ``(doc, mark, start, starts, bucket, whole, known)``.

    ``repeats (doc, mark, start, starts)`` are the runs with an equal elsewhere. ``left`` has one
    run per kind of every bucket that holds several kinds, at least one of them unknown, with the
    number of kinds.
    """
    kinds = scratch.table(
        items.groupBy("bucket", "whole")
        .agg(
            F.count("*").alias("copies"),
            F.max("known").alias("any_known"),
            F.min(F.struct("doc", "mark", "start", "starts")).alias("run"),
        )
        .select(
            "bucket",
            "whole",
            ((F.col("copies") > 1) | F.col("any_known")).alias("known"),
            "run",
        ),
        "kinds",
    )
    equal = kinds.filter("known").select("bucket", "whole")
    repeats = scratch.table(
        items.filter("NOT known")
        .join(equal, ["bucket", "whole"])
        .select("doc", "mark", "start", "starts"),
        "repeats",
    )
    mixed = scratch.table(
        kinds.groupBy("bucket")
        .agg(F.count("*").alias("kinds"), F.count_if(~F.col("known")).alias("unknown"))
        .filter("kinds > 1 AND unknown > 0")
        .select("bucket", "kinds"),
        "mixed",
    )
    left = scratch.table(
        kinds.join(mixed, "bucket").select("run.*", "bucket", "whole", "known", "kinds"), "left"
    )
    scratch.drop(kinds)
    scratch.drop(mixed)
    return repeats, left


def with_items(docs: DataFrame, items: DataFrame, *fields: str) -> DataFrame:
    """``(doc, mark, text, items)``: every text that has items, with all of them."""
    grouped = items.groupBy("doc", "mark").agg(F.collect_list(F.struct(*fields)).alias("items"))
    bound = (64 + 16 * len(fields)) * items.count()
    return docs.join(small(grouped, bound), ["doc", "mark"])


# ---- refinement by bucket pointers ----------------------------------------------------------


def refine(data: np.ndarray, begins: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the starts of some runs are starts of equal strings.

    ``data`` holds the runs' bytes one after another, run ``i`` from ``begins[i]``; its first
    ``starts[i]`` suffixes count. Returns one boolean per byte, False for other suffixes.
    """
    size = len(data)
    ends = np.append(begins[1:], size)
    room = np.repeat(ends, ends - begins) - np.arange(size)  # bytes up to the end of the run
    counts = np.zeros(size, dtype=bool)
    for begin, number in zip(begins.tolist(), starts.tolist()):
        counts[begin : begin + number] = True

    # The initial buckets: suffixes with the same first bytes. A pointer is the place of the
    # bucket's first suffix among all sorted ones, so pointers are in the order of the suffixes.
    depth = min(8, length)
    heads = np.zeros(size, dtype=np.uint64)
    for place in range(depth):
        heads[: size - place] = (heads[: size - place] << np.uint64(8)) | data[place:]
    active = np.flatnonzero(room >= depth)
    pointers = np.full(size, -1, dtype=np.int64)
    active = active[np.argsort(heads[active])]
    opens = np.ones(len(active), dtype=bool)
    opens[1:] = heads[active][1:] != heads[active][:-1]
    pointers[active] = _first_places(opens)
    active = active[_shared(opens)]

    while depth < length and len(active):
        later = min(depth, length - depth)
        depth += later
        active = active[room[active] >= depth]
        if depth == length:
            active = active[counts[active]]
        own, after = pointers[active], pointers[active + later]
        order = np.argsort(own * size + after)  # by the pointer, then by the later one
        active, own, after = active[order], own[order], after[order]
        opens = np.ones(len(active), dtype=bool)
        opens[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        heads_of = np.ones(len(active), dtype=bool)
        heads_of[1:] = own[1:] != own[:-1]
        # A new pointer: the old bucket's, moved by the suffixes of the bucket sorted before.
        pointers[active] = own + _first_places(opens) - _first_places(heads_of)
        active = active[_shared(opens)]
    repeated = np.zeros(size, dtype=bool)
    repeated[active] = True
    return repeated & counts


def _first_places(opens: np.ndarray) -> np.ndarray:
    """For every entry the place at which its bucket opens."""
    return np.maximum.accumulate(np.where(opens, np.arange(len(opens)), 0))


def _shared(opens: np.ndarray) -> np.ndarray:
    """Which entries are not alone in their bucket."""
    alone = opens.copy()
    alone[:-1] &= opens[1:]
    return ~alone


def bits_to_runs(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], bits.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def refined(docs: DataFrame, left: DataFrame, length: int) -> DataFrame:
    """``(doc, mark, start, starts)`` of repeats in buckets of bounded size."""
    fields = [
        ("doc", pa.int64()),
        ("mark", pa.int64()),
        ("start", pa.int32()),
        ("starts", pa.int32()),
    ]
    cut_schema = pa.schema(
        [*fields, ("bucket", pa.int64()), ("known", pa.bool_()), ("bytes", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, mark, data, items in texts_with_items(batches):
            columns = [[item[name] for item in items] for name in items[0]]
            start, starts, bucket, known = columns
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc] * len(items), pa.int64()),
                    pa.array([mark] * len(items), pa.int64()),
                    pa.array(start, pa.int32()),
                    pa.array(starts, pa.int32()),
                    pa.array(bucket, pa.int64()),
                    pa.array(known, pa.bool_()),
                    pa.array(
                        [data[a : a + n + length - 1] for a, n in zip(start, starts)], pa.binary()
                    ),
                ],
                schema=cut_schema,
            )

    schema = pa.schema(fields)

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        data, bounds = _binary(table.column("bytes").combine_chunks())
        starts = table.column("starts").to_numpy()
        found = refine(data, bounds[:-1], starts, length)
        unknown = ~table.column("known").to_numpy()
        found &= np.repeat(unknown, np.diff(bounds))
        begin, end = bits_to_runs(found)
        # The last bytes of a run are no starts, so found runs never cross from one to the next.
        of = np.searchsorted(bounds, begin, side="right") - 1
        taken = pa.array(of)
        return pa.RecordBatch.from_arrays(
            [
                table.column("doc").combine_chunks().take(taken),
                table.column("mark").combine_chunks().take(taken),
                pa.array(table.column("start").to_numpy()[of] + begin - bounds[of], pa.int32()),
                pa.array(end - begin, pa.int32()),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            changes = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
            for begin, end in zip(changes.tolist(), [*changes[1:].tolist(), len(buckets)]):
                if buckets[begin] != last and size >= REFINE_BYTES:
                    yield settle(held)
                    held, size = [], 0
                part = batch.slice(begin, end - begin)
                last, size = buckets[begin], size + part.nbytes
                held.append(part)
        if held:
            yield settle(held)

    ddl = "doc long, mark long, start int, starts int"
    pieces = with_items(docs, left, "start", "starts", "bucket", "known").mapInArrow(
        cut, ddl + ", bucket long, known boolean, bytes binary"
    )
    dealt = pieces.repartition("bucket").sortWithinPartitions("bucket", "doc", "mark", "start")
    return dealt.mapInArrow(run, ddl)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def texts_with_items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        docs, marks = batch.column("doc").to_pylist(), batch.column("mark").to_pylist()
        for at, (doc, mark) in enumerate(zip(docs, marks)):
            row = batch.slice(at, 1)
            yield doc, mark, row.column("text")[0].as_py().encode(), row.column("items")[0].as_py()


# ---- buckets too large for a task -----------------------------------------------------------


def cells(docs: DataFrame, left: DataFrame, length: int, cell: int = CELL) -> DataFrame:
    """Runs cut to the grid of their bucket's q-gram, as runs of finer buckets.

    The bucket of a cell is the hash of the bytes that all its strings share, with the cell's place
    in the grid. With cells of one start it is that of the string.
    """
    gram = min(GRAM, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, mark, data, items in texts_with_items(batches):
            out: list[tuple] = []
            for item in items:
                start, starts = item["start"], item["starts"]
                own = np.frombuffer(data, np.uint8)[start : start + starts + length - 1]
                grams = gram_hashes(prefix_hashes(own), gram)
                least = sliding_min(grams, length - gram + 1)
                centres = np.flatnonzero(grams == least[0])
                places = np.arange(starts)
                centre = centres[np.searchsorted(centres, places)]
                row = (centre - places) // cell
                opens = np.ones(starts, dtype=bool)
                opens[1:] = (centre[1:] != centre[:-1]) | (row[1:] != row[:-1])
                begin = np.flatnonzero(opens).tolist()
                for low, high in zip(begin, [*begin[1:], starts]):
                    at = start + int(centre[low])
                    first = at - int(row[low]) * cell
                    last = at - int(row[low]) * cell - cell + 1 + length
                    shared = xxhash.xxh3_128_digest(
                        b"%d:" % int(row[low]) + data[first:last]
                    )
                    whole = xxhash.xxh3_64_intdigest(
                        data[start + low : start + high - 1 + length]
                    )
                    # Within a bucket of 64 bits the other 64 tell different shared bytes apart.
                    key, check = np.frombuffer(shared, np.int64).tolist()
                    out.append((doc, mark, start + low, high - low, key, check ^ _signed(whole),
                                item["known"]))
            kinds = [*[field.type for field in _RUN_SCHEMA], pa.bool_()]
            names = [*_RUN_SCHEMA.names, "known"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names=names
            )

    return with_items(docs, left, "start", "starts", "known").mapInArrow(
        run, _RUN_DDL + ", known boolean"
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


# ---- the whole -----------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """``(doc, mark, start, starts)``: starts of strings that start elsewhere too, as runs, of distinct
    texts ``(doc, mark, text, copied)``; none of those with copies, whose strings all do."""
    runs = scratch.table(all_runs(docs, length), "runs")
    # A table of its own, so that the join can split a bucket with many runs.
    shared = scratch.table(
        runs.groupBy("bucket").agg(F.count("*").alias("runs")).filter("runs > 1").select("bucket"),
        "shared",
    )
    items = scratch.table(runs.join(shared, "bucket"), "items")
    scratch.drop(shared)
    scratch.drop(runs)
    found = []
    for width in (CELL, 1, 0):
        repeats, left = sort_out(items, scratch)
        scratch.drop(items)
        found.append(repeats)
        # Cells of one start are either equal or not: nothing of them is left.
        bounded = left.filter(F.col("kinds") <= GROUP)
        if width and bounded.limit(1).count():
            found.append(scratch.table(refined(docs, bounded, length), "refined"))
        large = left.filter(F.col("kinds") > GROUP)
        if not width or not large.limit(1).count():
            break
        items = scratch.table(cells(docs, large, length, width), "items")
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def union_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted disjoint spans that cover what the given spans cover."""
    order = np.argsort(start, kind="stable")
    begin, end = start[order], np.maximum.accumulate(end[order])
    opens = np.ones(len(begin), dtype=bool)
    opens[1:] = begin[1:] > end[:-1]
    return begin[opens], end[np.append(opens[1:], True)]


def spans_by_text(repeats: DataFrame, length: int) -> DataFrame:
    """``(doc, mark, begins, ends)``: the bytes to remove, as maximal spans in order."""
    schema = pa.schema(
        [
            ("doc", pa.int64()),
            ("mark", pa.int64()),
            ("begins", pa.list_(pa.int32())),
            ("ends", pa.list_(pa.int32())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, ends = [], []
            for start, starts in zip(*(batch.column(i).to_pylist() for i in (2, 3))):
                start = np.array(start)
                spans = union_of(start, start + np.array(starts) - 1 + length)
                begins.append(spans[0])
                ends.append(spans[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(begins, pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())),
                ],
                schema=schema,
            )

    # Both lists come from the same rows in the same order.
    runs = F.collect_list(F.struct("start", "starts")).alias("runs")
    return (
        repeats.groupBy("doc", "mark")
        .agg(runs)
        .select("doc", "mark", "runs.start", "runs.starts")
        .mapInArrow(run, "doc long, mark long, begins array<int>, ends array<int>")
    )


def with_spans(
    df: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """``(doc_id, text, begins, ends)`` of every row: the spans to remove, null for none.

    A text is known by 128 bits of its hashes, so ids may be null or repeat. Rows with the same text
    have the same spans; the text is searched once, however many rows hold it.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    doc, mark = text_key(value)
    docs = df.select(
        doc.alias("doc"),
        mark.alias("mark"),
        F.col(key).cast("long").alias("doc_id"),
        value.alias("text"),
    )
    with Scratch(df.sparkSession) as inner:
        texts, copies = one_each(docs.select("doc", "mark", "text"), ["doc", "mark"], inner)
        found = spans_by_text(repeated_spans(texts, inner, length), length)
        whole = copies.select(
            "doc", "mark",
            F.lit(None).cast("array<int>").alias("begins"),
            F.lit(None).cast("array<int>").alias("ends"),
        )
        # A row without lists stands for a text that goes as a whole, if it is long enough.
        spans = scratch.table(found.union(whole).withColumn("found", F.lit(True)), "spans")
    held = spans.agg(F.count("*"), F.sum(F.size(F.coalesce("begins", F.array())))).first()
    bound = 64 * held[0] + 8 * (held[1] or 0)
    joined = docs.join(small(spans, bound), ["doc", "mark"], "left")
    size = F.octet_length("text")
    goes = F.col("found") & F.col("begins").isNull() & (size >= length)
    return joined.select(
        "doc_id",
        "text",
        F.when(goes, F.array(F.lit(0))).otherwise(F.col("begins")).alias("begins"),
        F.when(goes, F.array(size)).otherwise(F.col("ends")).alias("ends"),
    )


def remove_repeats(
    df: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """``(doc_id, n_bytes, kept, spans)`` of every row of ``df``.

    ``kept`` are the remaining bytes of the text as UTF-8, joined, ``spans`` the removed ones
    ``(start, end)`` in bytes, maximal and in order. A null text counts as empty; texts shorter than
    ``length`` bytes keep all. Strings count wherever they start, in rows that are equal in all
    columns too. Every row gives one row.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("kept", pa.binary()),
            ("spans", pa.list_(span)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                rows = batch.slice(low, 256)
                sizes, kept, spans = [], [], []
                for value, begins, ends in zip(*(rows.column(i).to_pylist() for i in (1, 2, 3))):
                    data, own = value.encode(), []
                    sizes.append(len(data))
                    if begins:
                        own = list(zip(begins, ends))
                        edges = [0, *[edge for pair in own for edge in pair], len(data)]
                        data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    kept.append(data)
                    spans.append([{"start": a, "end": b} for a, b in own])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(kept, pa.binary()),
                        pa.array(spans, pa.list_(span)),
                    ],
                    schema=schema,
                )

    return with_spans(df, scratch, key, text, length).mapInArrow(
        run, "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>"
    )


def summary(cleaned: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of ``remove_repeats``."""
    kept: Column = F.col("kept")
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length(kept)).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )
