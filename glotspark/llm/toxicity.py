"""Toxicity by a convolutional text classifier trained in numpy.

A word and its first four and six bytes are looked up in a hashed embedding table; the sum of the
three rows is the word's vector, so that words which share a stem share what is learnt. Filters of
several widths slide over the whole text, each keeps its greatest response, and a logistic unit
weighs these. All labelled rows are learnt from. Up to ``PART`` of them are trained on in one place; more are
dealt to parts of that size, whose tasks each train on their own rows for a round, and what they moved
is averaged. Words are counted and thresholds calibrated over all of these rows too. Scoring runs in tasks that
hold a piece of text and the model.

Scores depend on the text alone. Thresholds are calibrated by language on rows that the network was
not fitted to.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

from .arrow import release_memory, text_pieces
from .joins import positional, small
from .words import LOWER, mix, prefix_hashes, span_hashes

# The network.
SLOTS = 1 << 20
STEMS = (4, 6)
WIDE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8

# A word or stem needs this many texts of the labelled rows to be learnt, all others count as unknown.
# There is no upper bound: the words of a toxic text with many copies, or the markers of a table with many
# toxic rows, are frequent and telling.
MIN_TEXTS = 3

# Labelled rows, and bytes of these, that are trained on in one place, on average.
PART = 8_000
PART_BYTES = 48_000_000

# What all toxic rows count in the loss, as a share of what all clean ones do, and how many times a
# toxic row counts at most for that.
BALANCE = 0.8
MAX_WEIGHT = 6.0

EPOCHS = 30
PATIENCE = 4
BATCH = 64

# Rows that one of several parts trains on at most, those of all rounds counted: as many as 30 epochs of a
# part of some 2,000 rows take.
PART_STEPS = 64_000

# Words of a batch that holds more than one text.
BATCH_WORDS = 1 << 20

# Moves of parameters and sums of losses are added up as whole numbers of these units.
MOVE_UNIT = 2.0**-36
LOSS_UNIT = 2.0**-16
RATE = 0.05
SEED = 42

# A score that rejects, and the range of those calibrated by language.
THRESHOLD = 0.7
MIN_THRESHOLD = 0.5
TRIED = np.linspace(MIN_THRESHOLD, 0.95, 46)

# One of this many training rows is kept for early stopping and calibration.
CHECK_PART = 5

_PAD = max(WIDTHS) - 1
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)] = True
_IN_WORD[128:] = True


def hashed_words(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)``: words of every text, runs of letters and digits in small letters. A
    word has three hashes, its own and those of its stems."""
    values = LOWER[values]
    inside = _IN_WORD[values]
    cut = np.zeros(len(values) + 1, dtype=bool)
    cut[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    sums = prefix_hashes(values)
    hashes = [span_hashes(sums, begin, end)]
    for stem in STEMS:
        short = span_hashes(sums, begin, np.minimum(begin + stem, end))
        hashes.append(mix(short + np.uint64(stem)))
    return np.stack(hashes, axis=1), np.searchsorted(begin, offsets)


def padded(rows: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another with empty places around each; ``(rows, starts)``."""
    sizes = np.diff(bounds)
    starts = bounds[:-1] + _PAD * np.arange(len(sizes))
    out = np.zeros((int(bounds[-1]) + _PAD * (len(sizes) + 1), rows.shape[1]), dtype=np.int64)
    places = np.arange(len(rows)) + _PAD * (np.repeat(np.arange(len(sizes)), sizes) + 1)
    out[places] = rows
    return out, starts


class Vocabulary:
    """Rows from 1 of learnt words and stems by hash; anything else has row 0.

    A hash leads to one slot, and the row there counts only if it is that of the same hash.
    """

    def __init__(self, hashes: np.ndarray):
        self.keys = np.concatenate((np.zeros(1, np.uint64), hashes))
        self.slots = np.zeros(SLOTS, dtype=np.int32)
        self.slots[(hashes % np.uint64(SLOTS)).astype(np.int64)] = np.arange(1, len(hashes) + 1)

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        found = self.slots[(hashes % np.uint64(SLOTS)).astype(np.int64)]
        return np.where(self.keys[found] == hashes, found, 0)


@dataclass
class Network:
    vocabulary: Vocabulary
    table: np.ndarray  # (rows, WIDE)
    filters: list[np.ndarray]  # per width (width, WIDE, FILTERS)
    bias: np.ndarray  # (len(WIDTHS), FILTERS)
    weights: np.ndarray  # (len(WIDTHS), FILTERS)
    base: float
    thresholds: Mapping[str | None, float]

    def pooled(self, rows: np.ndarray, starts: np.ndarray) -> tuple:
        """Vectors, greatest responses per text, and where they stand."""
        vectors = self.table[rows[:, 0]]
        for place in range(1, rows.shape[1]):
            vectors += self.table[rows[:, place]]
        best, at = [], []
        for taps, bias in zip(self.filters, self.bias):
            width = len(taps)
            count = len(vectors) - width + 1
            response = np.broadcast_to(bias, (count, FILTERS)).copy()
            for place, tap in enumerate(taps):
                response += vectors[place : place + count] @ tap
            # A text's windows may reach into the empty places after it, never into another text.
            best.append(np.maximum.reduceat(response, starts))
            at.append(response)
        return vectors, np.stack(best, axis=1), at

    def score(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        _, best, _ = self.pooled(rows, starts)
        logits = (best * self.weights).sum(axis=(1, 2)) + self.base
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def blank(vocabulary: Vocabulary, rate: float, random: np.random.Generator) -> Network:
    return Network(
        vocabulary,
        np.zeros((len(vocabulary.keys), WIDE), dtype=np.float32),
        [
            (random.standard_normal((width, WIDE, FILTERS)) / math.sqrt(WIDE * width)).astype(
                np.float32
            )
            for width in WIDTHS
        ],
        np.full((len(WIDTHS), FILTERS), 0.1, dtype=np.float32),
        (random.standard_normal((len(WIDTHS), FILTERS)) / 2).astype(np.float32),
        math.log(max(rate, 1e-3) / max(1 - rate, 1e-3)),
        {},
    )


def train(
    vocabulary: Vocabulary, texts: Sequence[np.ndarray], toxic: np.ndarray, checks: np.ndarray
) -> Network:
    """Fits a network to texts given as table rows; ``checks`` marks those kept from the fit."""
    random = np.random.default_rng(SEED)
    fit = np.flatnonzero(~checks)
    network = blank(vocabulary, float(toxic[fit].mean()) if len(fit) else 0.0, random)
    if not len(fit):
        return network
    weights = class_weights(toxic, len(fit), float(toxic[fit].sum()))
    state = first_state(network)
    best = Best()
    for _ in range(EPOCHS):
        _epoch(network, state, texts, toxic, weights, random.permutation(fit))
        chosen = np.flatnonzero(checks) if checks.any() else fit
        loss, total = _loss(network, texts, toxic, chosen, weights)
        if best.waits(loss / max(1.0, total), network):
            break
    return best.network or network


class Best:
    """The network of the least loss so far, and how long it has been that."""

    def __init__(self):
        self.loss, self.network, self.waited = np.inf, None, 0

    def waits(self, loss: float, network: Network) -> bool:
        """Notes a network; whether there was no better one for long enough."""
        if loss < self.loss - 1e-4:
            self.loss, self.waited = loss, 0
            self.network = Network(
                network.vocabulary,
                network.table.copy(),
                [taps.copy() for taps in network.filters],
                network.bias.copy(),
                network.weights.copy(),
                network.base,
                {},
            )
            return False
        self.waited += 1
        return self.waited >= PATIENCE


def class_weights(toxic: np.ndarray, rows: int, toxic_rows: float) -> np.ndarray:
    """What a row counts in the loss: toxic ones more where they are rare among the ``rows`` learnt from."""
    ratio = (rows - toxic_rows) / max(1.0, toxic_rows)
    weight = min(max(BALANCE * ratio, 1.0), MAX_WEIGHT)
    return np.where(toxic == 1, weight, 1.0)


def first_state(network: Network) -> dict:
    """Adagrad's sums of squares before any step."""
    state = {"table": np.zeros(len(network.table), np.float32), "base": 0.0}
    state["bias"], state["weights"] = np.zeros_like(network.bias), np.zeros_like(network.weights)
    for number, taps in enumerate(network.filters):
        state[f"filter{number}"] = np.zeros_like(taps)
    return state


def _batches(texts: Sequence[np.ndarray], order: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """``order`` in pieces of ``most`` texts at most, fewer where they are long."""
    begin = 0
    while begin < len(order):
        sizes = np.cumsum([len(texts[i]) for i in order[begin : begin + most]])
        end = begin + max(1, int(np.searchsorted(sizes, BATCH_WORDS, side="right")))
        yield order[begin:end]
        begin = end


def _epoch(
    network: Network,
    state: dict,
    texts: Sequence[np.ndarray],
    toxic: np.ndarray,
    weights: np.ndarray,
    order: np.ndarray,
) -> None:
    for chosen in _batches(texts, order, BATCH):
        _step(network, state, [texts[i] for i in chosen], toxic[chosen], weights[chosen])


def _batch(texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate(([0], np.cumsum([len(text) for text in texts])))
    return padded(np.concatenate(texts), bounds)


def _loss(
    network: Network, texts: Sequence, toxic: np.ndarray, chosen: np.ndarray, weights: np.ndarray
) -> tuple[float, float]:
    """The sum of the losses of the chosen texts, and of their weights."""
    total = 0.0
    for part in _batches(texts, chosen, 256):
        score = network.score(*_batch([texts[i] for i in part]))
        score = np.clip(np.where(toxic[part] == 1, score, 1 - score), 1e-6, 1)
        total -= float((weights[part] * np.log(score)).sum())
    return total, float(weights[chosen].sum())


def _step(
    network: Network,
    state: dict,
    texts: Sequence[np.ndarray],
    toxic: np.ndarray,
    weights: np.ndarray,
) -> None:
    """One Adagrad step; only the greatest response of a filter passes a gradient on."""
    rows, starts = _batch(texts)
    vectors, best, responses = network.pooled(rows, starts)
    logits = (best * network.weights).sum(axis=(1, 2)) + network.base
    error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - toxic) * weights / len(texts)
    passed = error[:, None, None] * network.weights
    ends = np.append(starts[1:], len(rows))
    grads = {
        "weights": (error[:, None, None] * best).sum(axis=0),
        "bias": passed.sum(axis=0),
        "base": error.sum(),
    }
    on_vectors: list[tuple[np.ndarray, np.ndarray]] = []
    for number, taps in enumerate(network.filters):
        width, response = len(taps), responses[number]
        places = np.empty((len(texts), FILTERS), dtype=np.int64)
        for i, (begin, end) in enumerate(zip(starts, ends)):
            places[i] = begin + response[begin : min(end, len(response))].argmax(axis=0)
        grad = np.empty_like(taps)
        for place in range(width):
            near = vectors[places + place]  # (texts, FILTERS, WIDE)
            grad[place] = np.einsum("tf,tfw->wf", passed[:, number], near)
            pull = passed[:, number, :, None] * taps[place].T[None]
            on_vectors.append(((places + place).ravel(), pull.reshape(-1, WIDE)))
        grads[f"filter{number}"] = grad
    for name, grad in grads.items():
        state[name] = state.get(name, 0.0) + grad * grad
        move = (RATE * grad / np.sqrt(state[name] + 1e-8)).astype(np.float32)
        if name.startswith("filter"):
            network.filters[int(name[6:])] -= move
        elif name == "base":
            network.base -= float(move)
        else:
            getattr(network, name)[...] -= move
    touched = np.concatenate([place for place, _ in on_vectors])
    pulls = np.concatenate([pull for _, pull in on_vectors])
    places = rows[touched]
    used, inverse = np.unique(places.ravel(), return_inverse=True)
    grad = np.zeros((len(used), WIDE), dtype=np.float32)
    np.add.at(grad, inverse.ravel(), np.repeat(pulls, places.shape[1], axis=0))
    grad[used == 0] = 0  # row 0 stays empty
    state["table"][used] += (grad * grad).mean(axis=1)
    network.table[used] -= grad * (RATE / np.sqrt(state["table"][used] + 1e-8))[:, None]


def calibration(scores: np.ndarray, toxic: np.ndarray, langs: Sequence) -> list[tuple]:
    """``(language, toxic rows, rows and toxic rows from each tried threshold on)``; these add up."""
    found = []
    langs = np.array(langs, dtype=object)
    for lang in {*langs.tolist()}:
        own = langs == lang
        chosen = scores[own][None, :] >= TRIED[:, None]
        hits = (chosen & (toxic[own] == 1)).sum(axis=1)
        found.append((lang, int(toxic[own].sum()), chosen.sum(axis=1), hits))
    return found


def calibrate(counted: Sequence[tuple]) -> dict:
    """The threshold of the best F1 per language; of several the one in the middle. Languages with
    too few toxic rows keep ``THRESHOLD``."""
    sums, found = {}, {}
    for lang, *counts in counted:
        sums[lang] = [a + b for a, b in zip(sums[lang], counts)] if lang in sums else counts
    for lang, (toxic, chosen, hits) in sums.items():
        if toxic < 5:
            continue
        f1 = 2 * hits / np.maximum(1, chosen + toxic)
        best = np.flatnonzero(f1 >= f1.max() - 1e-12)
        found[lang] = float(TRIED[best[len(best) // 2]])
    return found


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


LABELLED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("toxic", pa.int32()),
        ("checks", pa.bool_()),
        ("lang", pa.string()),
        ("words", pa.binary()),
    ]
)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    lang: str | None = "lang",
    part: int = PART,
) -> Network:
    """Trains on all labelled rows that are not held out, ``part`` of them in one place.

    Rows of one id with different labels count as toxic, one of an id's texts is learnt; null ids, texts
    and labels are left out. The driver gets the words to learn, what the tasks moved, and, where
    one part holds all rows, these rows as numbers of words.
    """
    spark = docs.sparkSession
    marked = (
        labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("checks", F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(CHECK_PART)) == 0)
    )
    language = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    texts = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), language.alias("lang")
    ).filter(F.col("text").isNotNull())
    with Scratch(spark) as scratch:
        rows = scratch.table(
            texts.join(small(marked, 16 * marked.count()), "doc_id")
            .groupBy("doc_id", "toxic", "checks")
            .agg(F.min(F.struct("text", "lang")).alias("first"))
            .select("doc_id", "toxic", "checks", "first.lang", "first.text"),
            "labelled",
        )
        vocabulary = learnt(rows)
        shared = spark.sparkContext.broadcast(vocabulary)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece, values, offsets in text_pieces(batches):
                hashes, bounds = hashed_words(values, offsets)
                known = shared.value.rows(hashes).astype(np.int32)
                words = [zlib.compress(known[a:b], 1) for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [piece.column(name) for name in LABELLED.names[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(words, pa.binary())], schema=LABELLED
                )

        coded = rows.mapInArrow(
            run, "doc_id long, toxic int, checks boolean, lang string, words binary"
        )
        learning = ~F.col("checks")
        count, learnt_rows, toxic_rows, size = rows.agg(
            F.count("*"),
            F.count_if(learning),
            F.coalesce(F.sum(F.when(learning, F.col("toxic"))), F.lit(0)),
            F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
        ).first()
        parts = max(1, -(-count // part), -(-size // PART_BYTES))
        if parts > 1:
            return _fit_in_parts(coded, vocabulary, parts, learnt_rows, toxic_rows, learnt_rows < count)
        texts, toxic, checks, langs = _unpacked(coded.toArrow())
    network = train(vocabulary, texts, toxic, checks)
    network.thresholds = calibrate(_counted(network, texts, toxic, checks, langs))
    return network


def learnt(rows: DataFrame) -> Vocabulary:
    """The words and stems of ``rows (text)`` that stand in enough of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values, offsets in text_pieces(batches):
            hashes, bounds = hashed_words(values, offsets)
            firsts = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            kinds, texts = np.unique(np.concatenate(firsts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds.view(np.int64)), pa.array(texts.astype(np.int64))],
                names=["hash", "texts"],
            )

    counted = rows.select("text").mapInArrow(run, "hash long, texts long").groupBy("hash")
    frequent = counted.agg(F.sum("texts").alias("texts")).filter(F.col("texts") >= MIN_TEXTS)
    # One per slot, as a slot leads to one. SLOTS is a power of two.
    slot = F.col("hash").bitwiseAND(F.lit(SLOTS - 1).cast("long")).alias("slot")
    # The greatest one without a sign, as in ``Vocabulary``.
    least = F.lit(-(1 << 63)).cast("long")
    greatest = F.max(F.col("hash").bitwiseXOR(least)).bitwiseXOR(least).alias("hash")
    kept = frequent.groupBy(slot).agg(greatest).select("hash").toArrow()
    return Vocabulary(np.sort(kept["hash"].to_numpy().astype(np.int64).view(np.uint64)))


def _unpacked(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list]:
    """``(texts, toxic, checks, languages)`` in the order of ids, whatever the partitions were."""
    table = table.sort_by("doc_id")
    width = 1 + len(STEMS)
    texts = [
        np.frombuffer(zlib.decompress(each.as_buffer()), np.int32).reshape(-1, width)
        for each in table["words"]
    ]
    toxic = table["toxic"].to_numpy().astype(np.float64)
    checks = np.array(table["checks"].to_pylist(), dtype=bool)
    return texts, toxic, checks, table["lang"].to_pylist()


def _counted(
    network: Network, texts: Sequence, toxic: np.ndarray, checks: np.ndarray, langs: Sequence
) -> list[tuple]:
    chosen = np.flatnonzero(checks)
    scores = [network.score(*_batch([texts[i]]))[0] for i in chosen]
    return calibration(np.array(scores), toxic[chosen], [langs[i] for i in chosen])


# ---- parts --------------------------------------------------------------------------------------


def _packed(network: Network, state: dict) -> np.ndarray:
    """All parameters with their sums of squares: a row per word, then rows of all others."""
    others = [*network.filters, network.bias, network.weights, np.array([network.base])]
    names = [*(f"filter{number}" for number in range(len(network.filters))), "bias", "weights", "base"]
    squares = [np.atleast_1d(state[name]) for name in names]
    flat = np.concatenate([each.ravel() for each in (*others, *squares)]).astype(np.float32)
    flat = np.append(flat, np.zeros(-len(flat) % (WIDE + 1))).reshape(-1, WIDE + 1)
    return np.concatenate((np.column_stack((network.table, state["table"])), flat.astype(np.float32)))


def _restored(packed: np.ndarray, vocabulary: Vocabulary | None, rows: int) -> tuple[Network, dict]:
    """The network and sums of squares of ``_packed``, whose table has ``rows`` rows."""
    shapes = [*((width, WIDE, FILTERS) for width in WIDTHS), *[(len(WIDTHS), FILTERS)] * 2, (1,)]
    flat, found = packed[rows:].ravel().astype(np.float32), []
    for shape in shapes * 2:
        size = math.prod(shape)
        found.append(flat[:size].reshape(shape).copy())
        flat = flat[size:]
    (*filters, bias, weights, base), squares = found[: len(shapes)], found[len(shapes) :]
    table = np.ascontiguousarray(packed[:rows, :WIDE], dtype=np.float32)
    network = Network(vocabulary, table, filters, bias, weights, float(base[0]), {})
    state = {f"filter{number}": each for number, each in enumerate(squares[: len(WIDTHS)])}
    state["bias"], state["weights"], state["base"] = *squares[-3:-1], float(squares[-1][0])
    state["table"] = np.ascontiguousarray(packed[:rows, WIDE], dtype=np.float32)
    return network, state


def moved_rows(end: np.ndarray, start: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """``(places, moves)``: the first ``rows`` rows that moved by a unit at least, and all others.

    A part moves the words of its own texts, so only their rows are held as wide numbers.
    """
    at = np.flatnonzero((end != start).any(axis=1) | (np.arange(len(end)) >= rows))
    moves = np.rint((end[at].astype(np.float64) - start[at]) / MOVE_UNIT).astype(np.int64)
    kept = moves.any(axis=1) | (at >= rows)
    return at[kept], moves[kept]


def _fit_in_parts(
    coded: DataFrame,
    vocabulary: Vocabulary,
    parts: int,
    learnt_rows: int,
    toxic_rows: int,
    checked: bool,
) -> Network:
    """Rounds in which every part trains on its own rows, from the average of the round before.

    A word's row is averaged over the parts that moved it, so that rare words learn as fast as others.
    The loss of a round's start is that of rows kept from the fit, of all parts.
    """
    context = coded.sparkSession.sparkContext
    placed = coded.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(parts)).cast("int"))
    placed = placed.repartitionById(parts, F.col("part")).persist(StorageLevel.DISK_ONLY)
    rounds = min(EPOCHS, -(-PART_STEPS * parts // max(1, learnt_rows)))
    rate = toxic_rows / max(1, learnt_rows)
    network = blank(vocabulary, rate, np.random.default_rng(SEED))
    rows = len(network.table)
    packed = _packed(network, first_state(network))
    names = [f"v{place}" for place in range(WIDE + 1)]

    def of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """``(number, texts, toxic, checks, languages)`` of the parts of a partition."""
        held = [*batches]
        if held:
            table = pa.Table.from_batches(held)
            for number in sorted(set(table["part"].to_pylist())):
                yield number, *_unpacked(table.filter(pc.equal(table["part"], number)))

    def moves(turn: int, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, texts, toxic, checks, _ in of_parts(batches):
                start = shared.value
                own, state = _restored(start, None, rows)
                weights = class_weights(toxic, learnt_rows, toxic_rows)
                chosen = np.flatnonzero(checks if checked else ~checks)
                loss = np.zeros((1, WIDE + 1), np.int64)
                loss[0, :2] = np.rint(np.array(_loss(own, texts, toxic, chosen, weights)) / LOSS_UNIT)
                changed, moved = np.array([-1]), loss
                if turn < rounds:
                    order = np.random.default_rng([SEED, turn, number]).permutation(np.flatnonzero(~checks))
                    _epoch(own, state, texts, toxic, weights, order)
                    at, delta = moved_rows(_packed(own, state), start, rows)
                    changed, moved = np.append(changed, at), np.concatenate((loss, delta))
                columns = [pa.array(changed.astype(np.int64))]
                columns += [pa.array(np.ascontiguousarray(each)) for each in moved.T]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *names])
                texts = own = state = delta = moved = columns = None
            release_memory()

        schema = "row long, " + ", ".join(f"{name} long" for name in names)
        sums = [F.sum(name).alias(name) for name in names]
        return placed.mapInArrow(run, schema).groupBy("row").agg(F.count("*").alias("parts"), *sums)

    best = Best()
    try:
        for turn in range(rounds + 1):
            shared = context.broadcast(packed)
            got = moves(turn, shared).toArrow()
            shared.destroy()
            place, of = got["row"].to_numpy(), got["parts"].to_numpy()
            moved = np.column_stack([got[name].to_numpy() for name in names])
            loss, total = moved[place == -1][0, :2] * LOSS_UNIT
            if best.waits(loss / max(1.0, total), _restored(packed, vocabulary, rows)[0]):
                break
            own = place >= 0
            packed = packed.copy()
            average = moved[own] * MOVE_UNIT / of[own][:, None]
            packed[place[own]] = (packed[place[own]] + average).astype(np.float32)
        network = best.network
        shared = context.broadcast(_packed(network, first_state(network)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, texts, toxic, checks, langs in of_parts(batches):
                own, _ = _restored(shared.value, None, rows)
                counted = _counted(own, texts, toxic, checks, langs)
                lang, toxic_of, chosen, hits = zip(*counted) if counted else ((),) * 4
                columns = [pa.array(lang, pa.string()), pa.array(toxic_of, pa.int64())]
                columns += [pa.array([[*map(int, each)] for each in side], pa.list_(pa.int64()))
                            for side in (chosen, hits)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "toxic", "chosen", "hits"])
                texts = own = None
            release_memory()

        schema = "lang string, toxic long, chosen array<long>, hits array<long>"
        counted = placed.mapInArrow(run, schema).collect()  # a row per language and part
    finally:
        placed.unpersist()
    network.thresholds = calibrate(
        [(row.lang, row.toxic, np.array(row.chosen), np.array(row.hits)) for row in counted]
    )
    return network


def score(
    df: DataFrame,
    network: Network,
    key: str = "doc_id",
    text: str = "text",
    lang: str | None = None,
) -> DataFrame:
    """``(doc_id, score, flagged)`` of every whole text.

    ``flagged`` compares the score with the threshold of the row's language; without ``lang``, or
    for a language that none was calibrated for, with ``THRESHOLD``. A null or empty text is scored
    as a text without words. Repeated rows and null keys stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(network)
    language = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    chosen = df.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), language.alias("lang")
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("score", pa.float64()), ("flagged", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, offsets in text_pieces(batches):
            scores = _scores(shared.value, values, offsets)
            known = shared.value.thresholds
            least = [known.get(each, THRESHOLD) for each in rows.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(scores), pa.array(scores >= np.array(least))],
                schema=schema,
            )

    return chosen.mapInArrow(run, "doc_id long, score double, flagged boolean")


def _scores(network: Network, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    hashes, bounds = hashed_words(values, offsets)
    return network.score(*padded(network.vocabulary.rows(hashes), bounds)).astype(np.float64)


def without_toxic(
    df: DataFrame,
    network: Network,
    text: str = "text",
    lang: str | None = None,
    least: float = THRESHOLD,
) -> DataFrame:
    """The rows and columns of ``df`` whose text scores below the threshold of the row's language;
    without ``lang``, or for a language that none was calibrated for, below ``least``."""
    shared = df.sparkSession.sparkContext.broadcast(network)
    own = positional(df)
    place = f"column{df.columns.index(text)}"
    spoken = f"column{df.columns.index(lang)}" if lang else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.thresholds
        for rows, values, offsets in text_pieces(batches, place):
            limits = np.full(len(rows), least)
            if spoken:
                langs = rows.column(spoken).to_pylist()
                limits = np.array([known.get(each, least) for each in langs])
            yield rows.filter(pa.array(_scores(shared.value, values, offsets) < limits))

    return own.mapInArrow(run, own.schema).toDF(*df.columns)
