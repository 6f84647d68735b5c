"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

Every paragraph is hashed to a wide vector, and a fingerprint is the sum of the vectors of its
paragraphs modulo powers of two. So it does not depend on their order, a paragraph is put in or
taken out by one addition or subtraction, and equal multisets have equal fingerprints. It has two
parts:

* ``LANES`` sums of plus and minus ones modulo 2**24. As long as a lane has not gone round, the mean
  square of the difference of two fingerprints estimates the squared distance of the two multisets,
  which gives a likeness from 0 to 1 with a standard error below ``(2 / LANES) ** 0.5``;
* ``STRONG`` sums of 64-bit values modulo 2**64, which tell apart what the lanes might not.

A paragraph is a line, without white space around it; a line of more than ``WORDS`` words counts as
one paragraph for every ``WORDS`` of them from its start, so that a long line can be like another in
part. Blank lines count for nothing.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import pieces, plain, strings, utf8
from .words import mix, prefix_hashes, span_hashes, word_spans

LANES = 256
STRONG = 4
WORDS = 4

LANE_BYTES = 3
_MODULUS = 1 << (8 * LANE_BYTES)
_STEP = 0x9E3779B97F4A7C15

# Ranges of ids per shuffle partition, and the most that one job cuts its ids into.
RANGES_PER_PARTITION = 4
MAX_RANGES = 4096


def paragraphs(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: all paragraphs, and where each text's start among them."""
    starts, ends = word_spans(values, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(offsets), dtype=np.int64)
    lines = np.cumsum(values == 10)[starts]
    texts = np.searchsorted(offsets, starts, side="right")
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = (lines[1:] != lines[:-1]) | (texts[1:] != texts[:-1])
    order = np.arange(len(starts))
    within = order - np.maximum.accumulate(np.where(opens, order, 0))
    begin = np.flatnonzero(within % WORDS == 0)
    end = np.append(begin[1:], len(starts)) - 1
    hashes = span_hashes(prefix_hashes(values), starts[begin], ends[end])
    return hashes, np.searchsorted(texts[begin], np.arange(1, len(offsets) + 1))


def vectors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lanes, as bits that stand for minus and plus one, and the strong part."""
    wide = LANES // 64
    words = np.empty((len(hashes), wide + STRONG), dtype=np.uint64)
    for place in range(wide + STRONG):
        words[:, place] = mix(hashes + np.uint64(_STEP * (place + 1) % (1 << 64)))
    bits = np.unpackbits(np.ascontiguousarray(words[:, :wide]).view(np.uint8), axis=1)
    return bits, words[:, wide:]


def sums(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(lanes, strong)`` of every text: ``int64`` in the lanes' modulus, and ``uint64``."""
    rows = len(offsets) - 1
    lanes = np.zeros((rows, LANES), dtype=np.int64)
    strong = np.zeros((rows, STRONG), dtype=np.uint64)
    hashes, first = paragraphs(values, offsets)
    # Sums over bounded runs of paragraphs, so that a text of any length fits.
    step = 1 << 14
    for begin in range(0, len(hashes), step):
        bits, tail = vectors(hashes[begin : begin + step])
        low = int(np.searchsorted(first, begin, side="right")) - 1
        high = int(np.searchsorted(first, begin + len(bits), side="left"))
        bounds = np.clip(first[low:high], begin, None) - begin
        used = np.flatnonzero(np.diff(np.append(bounds, len(bits))))
        counts = np.diff(np.append(bounds, len(bits)))[used]
        ones = np.add.reduceat(bits, bounds[used], axis=0, dtype=np.int32)
        lanes[low + used] += 2 * ones - counts[:, None]
        strong[low + used] += np.add.reduceat(tail, bounds[used], axis=0)
    return np.mod(lanes, _MODULUS), strong


def add(one: tuple, other: tuple, sign: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of the two multisets together; ``sign=-1`` takes the other's paragraphs out."""
    lanes = np.mod(one[0] + sign * other[0], _MODULUS)
    return lanes, one[1] + other[1] if sign > 0 else one[1] - other[1]


def centred(lanes: np.ndarray) -> np.ndarray:
    """Lanes modulo their power as the whole numbers next to 0."""
    return (np.mod(lanes + _MODULUS // 2, _MODULUS) - _MODULUS // 2).astype(np.float64)


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Cosine of two multisets, estimated from their lanes row by row, within 0 and 1.

    Two empty multisets are alike, an empty one and another are not.
    """
    a, b = centred(one), centred(other)
    dot = ((a * a).sum(1) + (b * b).sum(1) - (centred(one - other) ** 2).sum(1)) / 2
    norms = np.sqrt((a * a).sum(1) * (b * b).sum(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(norms > 0, np.clip(dot / norms, 0.0, 1.0), 0.0)
    return np.where((one == other).all(1), 1.0, cosine)


def encode(lanes: np.ndarray, strong: np.ndarray) -> list[str]:
    """Fingerprints as text: the lanes' bytes, then the strong part, in base 64."""
    low = np.ascontiguousarray(lanes.astype("<u4").view(np.uint8).reshape(len(lanes), -1, 4))
    low = low[:, :, :LANE_BYTES].reshape(len(lanes), -1)
    both = np.concatenate([low, strong.astype("<u8").view(np.uint8)], axis=1)
    return [base64.b64encode(row.tobytes()).decode() for row in both]


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """``(lanes, strong)`` as one row each."""
    data = np.frombuffer(base64.b64decode(fingerprint), np.uint8)
    low = data[: LANES * LANE_BYTES].reshape(LANES, LANE_BYTES).astype(np.int64)
    lanes = (low << (8 * np.arange(LANE_BYTES))).sum(1)
    return lanes[None, :], data[LANES * LANE_BYTES :].view("<u8").astype(np.uint64)[None, :]


def of_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values, offsets = utf8(column)
    lanes, strong = [np.empty((0, LANES), np.int64)], [np.empty((0, STRONG), np.uint64)]
    for begin, end in pieces(offsets):
        ends = offsets[begin : end + 1]
        part = sums(values[int(ends[0]) : int(ends[-1])], ends - ends[0])
        lanes.append(part[0])
        strong.append(part[1])
    return np.concatenate(lanes), np.concatenate(strong)


def fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)`` of every whole text; null and empty texts have the zero sum."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = encode(*of_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(coded, pa.string())],
                schema=schema,
            )

    return plain(df, key, text).mapInArrow(run, "doc_id long, fingerprint string")


# ---- every document beside the next one -----------------------------------------------------


def range_of(key: Column, splits: list[int]) -> Column:
    """How many of the sorted ``splits`` are at most ``key``, searched in two steps."""
    width = max(1, int(len(splits) ** 0.5))
    rows = [splits[i : i + width] for i in range(0, len(splits), width)]
    if not rows:
        return F.lit(0)
    heads = F.lit([row[0] for row in rows])
    table = F.array(*[F.lit(row) for row in rows])
    row = F.size(F.filter(heads, lambda head: head <= key))
    inside = F.size(F.filter(F.get(table, row - 1), lambda split: split <= key))
    return F.when(row == 0, F.lit(0)).otherwise((row - 1) * width + inside)


def beside_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text, range, guest)``: rows dealt out so that each meets the next one.

    The order is descending ``doc_id``. Rows are dealt to ranges of ids, each range sorted, and the
    first row of a range comes as a guest to the one before it as well, the first of all to the
    last. Only the texts of these guests are copied; one shuffle carries every other text once.
    A guest stands after the rows of its range. Rows without an id stand outside the order, in
    ranges below 0, each after the first row of all as its guest.
    """
    spark = df.sparkSession
    rows = plain(df, key, text)
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION
    wanted = max(1, min(MAX_RANGES, wanted))
    cuts = rows.select(
        F.percentile_approx("doc_id", [i / wanted for i in range(1, wanted)] or [0.5], 100 * wanted)
    ).first()[0]
    ranged = F.when(F.col("doc_id").isNotNull(), range_of(F.col("doc_id"), sorted({*(cuts or [])})))
    # One row per range, and there are at most MAX_RANGES of them.
    tops = (
        rows.select("doc_id", ranged.alias("range"))
        .groupBy("range")
        .agg(F.max("doc_id").alias("top"))
        .collect()
    )
    chain = sorted(((row["range"], row["top"]) for row in tops if row["top"] is not None))[::-1]
    hosts = [(top, chain[i - 1][0]) for i, (_, top) in enumerate(chain)]
    nulls = [-(i + 1) for i in range(wanted)] if len(tops) > len(chain) else []
    hosts += [(chain[0][1], other) for other in nulls] if chain else []
    guests = spark.createDataFrame(hosts, "top long, host int").groupBy("top").agg(
        F.collect_list("host").alias("hosts")
    )
    own = F.coalesce(
        ranged, -F.pmod(F.xxhash64("text"), F.lit(wanted)).cast("int") - F.lit(1)
    )
    places = F.concat(
        F.array(F.struct(own.alias("range"), F.lit(False).alias("guest"))),
        F.coalesce(
            F.transform("hosts", lambda h: F.struct(h.alias("range"), F.lit(True).alias("guest"))),
            F.array(),
        ),
    )
    return (
        rows.join(F.broadcast(guests), F.col("doc_id") == F.col("top"), "left")
        .select("doc_id", "text", F.inline(places))
        .repartition("range")
        .sortWithinPartitions(
            "range", F.col("guest") != (F.col("range") < 0), F.desc("doc_id"), "text"
        )
    )


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first characters of the next one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compare_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``. The next document is the one with the next smaller id; after the smallest comes
    the largest. Of rows that share an id the one with the smaller text comes first. A null text
    counts as empty; a single document is its own next one.
    """
    kinds = [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
    schema = pa.schema(kinds)

    def emit(rows: list, nexts: list) -> pa.RecordBatch:
        texts = [row[1] for row in rows]
        changed = [edited(own, other) for own, other in zip(texts, nexts)]
        own = of_texts(pa.array(texts, pa.string()))
        after = of_texts(pa.array(nexts, pa.string()))
        other = of_texts(pa.array(changed, pa.string()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row[0] for row in rows], pa.int64()),
                pa.array([len(each) for each in texts], pa.int64()),
                pa.array([hashlib.sha256(each.encode()).hexdigest() for each in changed]),
                pa.array(encode(*own), pa.string()),
                pa.array(encode(*other), pa.string()),
                pa.array(likeness(own[0], other[0])),
                pa.array(likeness(own[0], after[0])),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        nexts: list[str] = []
        waiting = None  # the last row of the present range, until its next text comes
        present, first = None, ""
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                for doc, value, place, guest in zip(
                    part.column(0).to_pylist(),
                    strings(part.column(1)),
                    part.column(2).to_pylist(),
                    part.column(3).to_pylist(),
                ):
                    if place != present:
                        present, waiting, first = place, None, ""
                    if place < 0:  # rows without an id
                        if guest:
                            first = value
                        else:
                            rows.append((doc, value))
                            nexts.append(first)
                        continue
                    if waiting:
                        rows.append(waiting)
                        nexts.append(value)
                    waiting = None if guest else (doc, value)
                    if len(rows) >= 256:
                        yield emit(rows, nexts)
                        rows, nexts = [], []
                if len(rows) >= 256:
                    yield emit(rows, nexts)
                    rows, nexts = [], []
        if rows:
            yield emit(rows, nexts)

    return beside_next(df, key, text).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
