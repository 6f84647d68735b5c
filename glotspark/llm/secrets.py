"""Secret scans: fixed patterns, and runs of characters that look random rather than written.

The patterns find assigned values, access keys and long hexadecimal runs. Beyond them, every run of
key characters is scored by two character Markov models, one of random strings and one of ordinary
identifiers: the log-likelihood ratio of the transitions in its best stretch is compared with
``MIN_RATIO``, so that a key is found behind a path or a name too, and whatever its characters are. A
stretch found goes on to the ends of its letters and digits, and what is left of the run on both sides
is searched again, so that every key of a run is found. The models are counted over the whole corpus:
base matches and generated random strings are the samples of one label, words outside base matches
those of the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import plain, strings, text_pieces
from .joins import positional

# The base patterns and least lengths, in the order in which kinds are listed.
ASSIGN = re.compile(
    rb"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    rb"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
    rb"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "markov")

# Shortest run that the models judge, and the ratio in nats that it takes: prior odds of about one
# random string to 160,000 ordinary ones.
MIN_RUN = 16
MIN_RATIO = 12.0

# Shortest word that the model of ordinary identifiers learns from, and generated random strings of
# each alphabet that the other one learns from besides base matches.
MIN_WORD = 4
RANDOM_STRINGS = 4096

_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(_ALPHABET) + 1
_STATE = np.zeros(256, dtype=np.int64)
_STATE[np.frombuffer(_ALPHABET, np.uint8)] = np.arange(1, STATES)
_HEX = np.zeros(256, dtype=bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[np.frombuffer(_ALPHABET[:62], np.uint8)] = True


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, ends)`` of the maximal runs of True; none crosses the start of a text."""
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.zeros(len(mask) + 1, dtype=bool)
    cut[offsets] = True
    starts = mask.copy()
    starts[1:] &= ~mask[:-1] | cut[1:-1]
    ends = mask.copy()
    ends[:-1] &= ~mask[1:] | cut[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def base_spans(values: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``(row, kind, start, end, value start)`` in bytes from the start of the piece."""
    found = []
    starts, ends = runs(_HEX[values], offsets)
    long = ends - starts >= MIN_HEX
    rows = np.searchsorted(offsets, starts[long], side="right") - 1
    for row, start, end in zip(rows.tolist(), starts[long].tolist(), ends[long].tolist()):
        found.append((row, 2, start, end, start))
    data = values.tobytes()
    signs = np.flatnonzero((values == ord("=")) | (values == ord(":")))
    for row in np.unique(np.searchsorted(offsets, signs, side="right") - 1).tolist():
        for match in ASSIGN.finditer(data, int(offsets[row]), int(offsets[row + 1])):
            if match.end(2) - match.start(2) >= MIN_ASSIGN:
                found.append((row, 0, match.start(), match.end(), match.start(2)))
    at = data.find(b"AKIA")
    while at >= 0:
        row = int(np.searchsorted(offsets, at, side="right")) - 1
        for match in ACCESS.finditer(data, at, int(offsets[row + 1])):
            if match.end() - match.start() >= MIN_ACCESS:
                found.append((row, 1, match.start(), match.end(), match.start()))
        at = data.find(b"AKIA", int(offsets[row + 1]))
    return found


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratio, random to ordinary, of every transition between two characters."""

    ratio: np.ndarray

    def spans(
        self, values: np.ndarray, offsets: np.ndarray, base: list, least: float = MIN_RATIO
    ) -> list[tuple[int, int, int, int, int]]:
        states = _STATE[values]
        for _, _, start, end, _ in base:
            states[start:end] = 0
        starts, ends = runs(states > 0, offsets)
        long = ends - starts >= MIN_RUN
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return []
        steps = np.zeros(len(values) + 1)
        steps[2:] = self.ratio[states[:-1], states[1:]]
        # The gains alone are an upper bound of any stretch; few runs of ordinary text get that far.
        gains = np.cumsum(np.maximum(steps, 0))
        able = np.flatnonzero(gains[ends] - gains[starts + 1] >= least)
        if not len(able):
            return []
        sums = np.cumsum(steps)
        rows = np.searchsorted(offsets, starts[able], side="right") - 1
        found = []
        for row, start, end in zip(rows.tolist(), starts[able].tolist(), ends[able].tolist()):
            left = [(start, end)]
            while left:
                start, end = left.pop()
                if gains[end] - gains[start + 1] < least:
                    continue
                if (stretch := _best_stretch(sums, start, end, least)) is None:
                    continue
                begin, stop = stretch
                while begin > start and _ALNUM[values[begin - 1]]:
                    begin -= 1
                while stop < end and _ALNUM[values[stop]]:
                    stop += 1
                found.append((row, 3, begin, stop, begin))
                # What is left of the run on both sides goes on, if it is long enough.
                left += [part for part in ((start, begin), (stop, end)) if part[1] - part[0] >= MIN_RUN]
        return found


def _best_stretch(
    sums: np.ndarray, start: int, end: int, least: float
) -> tuple[int, int] | None:
    """The stretch of at least ``MIN_RUN`` characters of a run with the greatest sum of ratios, if that
    is ``least`` or more."""
    if end - start < MIN_RUN:
        return None
    before = np.minimum.accumulate(sums[start + 1 : end - MIN_RUN + 2])
    gained = sums[start + MIN_RUN : end + 1] - before
    stop = int(gained.argmax())
    if gained[stop] < least:
        return None
    begin = int(sums[start + 1 : start + stop + 2].argmin())
    return start + begin, start + MIN_RUN + stop


def transition_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``(random, state, count)`` over whole texts: pairs of characters in base values (random 1)
    and in words outside base spans (random 0). Every task sends one small table."""
    size = STATES * STATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size), dtype=np.int64)
        for _, values, offsets in text_pieces(batches):
            states = _STATE[values]
            secret = np.zeros(len(values), dtype=bool)
            base = base_spans(values, offsets)
            for _, _, _, end, start in base:
                secret[start:end] = True
            ordinary = states > 0
            for _, _, start, end, _ in base:
                ordinary[start:end] = False
            for label, mask in ((1, secret), (0, ordinary)):
                starts, ends = runs(mask & (states > 0), offsets)
                if not label:
                    long = ends - starts >= MIN_WORD
                    starts, ends = starts[long], ends[long]
                inside = np.zeros(len(values) + 1, dtype=np.int64)
                inside[starts] += 1
                inside[ends - 1] -= 1  # the last character has no transition
                pairs = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
                codes = states[pairs] * STATES + states[pairs + 1]
                total[label] += np.bincount(codes, minlength=size)
        for label in (0, 1):
            used = np.flatnonzero(total[label])
            yield pa.RecordBatch.from_pydict(
                {
                    "random": pa.array(np.full(len(used), label), pa.int32()),
                    "state": pa.array(used, pa.int32()),
                    "count": pa.array(total[label][used], pa.int64()),
                }
            )

    counted = df.select(F.col(text).alias("text")).mapInArrow(
        run, "random int, state int, count long"
    )
    return counted.groupBy("random", "state").agg(F.sum("count").alias("count"))


def random_samples(spark: SparkSession, strings: int = RANDOM_STRINGS) -> DataFrame:
    """Random strings in hexadecimal, base64 and its safe form, the same in every run."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    coded = F.base64(F.unhex(digest))
    values = F.array(digest, coded, F.translate(coded, "+/=", "-_"))
    return spark.range(strings).select(F.explode(values).alias("value"))


def count_pairs(values: Iterator[str]) -> np.ndarray:
    total = np.zeros(STATES * STATES, dtype=np.int64)
    for value in values:
        states = _STATE[np.frombuffer(value.encode(), np.uint8)]
        total += np.bincount(states[:-1] * STATES + states[1:], minlength=len(total))
    return total


def fit(df: DataFrame, text: str = "text") -> Markov:
    """Both models from the corpus. What reaches the driver is two tables of character pairs."""
    counts = np.ones((2, STATES * STATES))
    for row in transition_counts(df, text).collect():
        counts[row["random"], row["state"]] += row["count"]
    generated = random_samples(df.sparkSession).toPandas()["value"]
    # Generated strings weigh as much as all base values together, however many those are.
    drawn = count_pairs(generated) / max(1, len(generated) * 40)
    counts[1] += drawn * max(counts[1].sum(), 1e5)
    counts = counts.reshape(2, STATES, STATES)
    chances = counts / counts.sum(axis=2, keepdims=True)
    return Markov(np.log(chances[1]) - np.log(chances[0]))


def scan(
    df: DataFrame,
    model: Markov | None,
    key: str = "doc_id",
    text: str = "text",
    least: float = MIN_RATIO,
) -> DataFrame:
    """``(doc_id, spans)``: all spans of every whole text, in code points, end exclusive.

    Spans are ordered by start, then by kind as listed in ``KINDS``; the base kinds may overlap
    each other, runs judged by the models overlap none of them. A null or empty text has no spans;
    repeated rows and null keys stay. Without a model only the patterns are used.
    """
    fields = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(fields))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, offsets in text_pieces(batches):
            spans: list[list] = [[] for _ in range(len(rows))]
            found = base_spans(values, offsets)
            if model is not None:
                found += model.spans(values, offsets, found, least)
            places = {}
            for row, kind, start, end, _ in sorted(found, key=lambda x: (x[0], x[2], x[1])):
                if row not in places:
                    own = values[offsets[row] : offsets[row + 1]]
                    places = {row: np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))}
                at, shift = places[row], int(offsets[row])
                spans[row].append(
                    {"kind": KINDS[kind], "start": at[start - shift], "end": at[end - shift]}
                )
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), pa.array(spans, schema.field(1).type)],
                schema=schema,
            )

    return plain(df, key, text).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


def span_text(spans, base_only: bool = False):
    """``kind:start:end`` of the spans, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"] != KINDS[3]) if base_only else spans
    return F.array_join(
        F.transform(
            kept,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(
    df: DataFrame, model: Markov | None, text: str = "text", mark: str = "[secret]"
) -> DataFrame:
    """The same rows and columns with every span of the text replaced; null texts stay null."""
    position = df.columns.index(text)
    own = positional(df)
    names = own.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, offsets in text_pieces(batches, names[position]):
            found = base_spans(values, offsets)
            if model is not None:
                found += model.spans(values, offsets, found)
            column = rows.column(position)
            if found:
                texts = [row.encode() for row in strings(column)]
                # From the end, so that places before a change stay right; overlapping spans merge.
                for row, start, end in reversed(merged(found)):
                    shift = int(offsets[row])
                    old = texts[row]
                    texts[row] = old[: start - shift] + mark.encode() + old[end - shift :]
                nulls = column.is_null().to_pylist()
                column = pa.array(
                    [None if null else row.decode() for row, null in zip(texts, nulls)],
                    column.type,
                )
            columns = [column if i == position else rows.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return own.mapInArrow(run, own.schema).toDF(*df.columns)


def merged(found: list) -> list[tuple[int, int, int]]:
    """``(row, start, end)`` of the union of spans, in order."""
    union: list[tuple[int, int, int]] = []
    for row, _, start, end, _ in sorted(found, key=lambda x: (x[0], x[2])):
        if union and union[-1][0] == row and start <= union[-1][2]:
            union[-1] = (row, union[-1][1], max(end, union[-1][2]))
        else:
            union.append((row, start, end))
    return union
