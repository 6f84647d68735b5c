"""Near-duplicates by min-max hashing.

A text is the set of its distinct five-word shingles. Under each of ``PERMUTATIONS`` random
permutations of the hashed shingles both the least and the greatest value are kept: two unbiased
values of the signature from one evaluation, of lower variance than those of two permutations. The
signature is cut into bands, as long as the least likeness of a link allows (``banding``). Texts that
share a band are candidates; a pair at that likeness shares none with a chance of at most ``MISSED``.
At 0.85 there are 40 bands of 8 values, at 0.80 there are 53 of 6, with a chance of 1 in 10 million.
Every link is then confirmed on the full sets.

Texts with equal sets are one class, found by a digest of the set; only one text per class goes on.
Classes are numbered, and links are between numbers: ids may repeat with different texts.
Every class is compared with the least of all classes that it shares a bucket with. The links
found make components. Buckets whose members are in more than one component are looked at twice
again: first their members are compared with their least one, where that is in another component,
then those that still are apart with each other. For the latter, blocks of a bucket's signatures
meet in tasks, and only pairs whose sizes allow a link and whose signatures do not speak against it
(by five standard errors) go on to the full sets. No pair within a component is formed.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

from .arrow import text_pieces
from .components import components
from .joins import one_each, positional, small, text_key
from .words import mix, shingle_sets

# Words of a shingle, and the least percentage of shared shingles of a link.
SHINGLE = 5
PERCENT = 85

PERMUTATIONS = 160

# The chance that a pair at the least likeness of a link shares no band.
MISSED = 3e-6

# What tells one row's text from another's, also where ids repeat.
KEY = ["doc_id", "mark", "twin"]

# Members that are compared with one set in a task's turn, on average.
GROUP = 128


@functools.cache
def _multipliers() -> np.ndarray:
    seeds = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row per set: its least and its greatest value under each permutation.

    Sets must not be empty. A permutation multiplies the upper half of a hash by an odd number
    modulo 2**32.
    """
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, 2 * PERMUTATIONS), dtype=np.uint32)
    starts = bounds[:-1]
    for place, factor in enumerate(_multipliers()):
        values = short * factor + np.uint32(place * 0x61C88647 & 0xFFFFFFFF)
        out[:, place] = np.minimum.reduceat(values, starts)
        out[:, PERMUTATIONS + place] = np.maximum.reduceat(values, starts)
    return out


def banding(percent: int) -> tuple[int, int]:
    """``(bands, rows)`` of a signature: the most rows to a band by which a pair that shares
    ``percent`` of its shingles is missed with a chance of at most ``MISSED``."""
    for rows in range(2 * PERMUTATIONS, 1, -1):
        bands = 2 * PERMUTATIONS // rows
        if (1 - (percent / 100) ** rows) ** bands <= MISSED:
            return bands, rows
    return 2 * PERMUTATIONS, 1


def band_keys(signature: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """One 64-bit key per row and band; the band's number is part of it."""
    bands, rows = banding(percent)
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, dtype=np.uint64)
        for row in range(rows):
            # Least and greatest values of different permutations take turns.
            key = mix(key + signature[:, band * rows + row])
        keys[:, band] = key
    return keys


def described(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, mark, twin, n_shingles, digest, keys)`` of ``(doc_id, mark, twin, text)``; no keys
    for empty sets."""
    bands, _ = banding(percent)
    schema = pa.schema(
        [
            *[(name, pa.int64()) for name in KEY],
            ("n_shingles", pa.int64()),
            ("digest", pa.binary()),
            ("keys", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, offsets in text_pieces(batches):
            hashes, bounds = shingle_sets(values, offsets, SHINGLE)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            keys = np.empty((0, bands), np.uint64)
            if len(full):
                keys = band_keys(signatures(hashes, np.append(bounds[full], bounds[-1])), percent)
            lengths = np.zeros(len(rows) + 1, dtype=np.int32)
            lengths[1:][full] = bands
            data = hashes.tobytes()
            digests = [
                xxhash.xxh3_128_digest(data[8 * begin : 8 * end])
                for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(name) for name in KEY],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(
                        np.cumsum(lengths, dtype=np.int32), pa.array(keys.view(np.int64).ravel())
                    ),
                ],
                schema=schema,
            )

    keys = ", ".join(f"{name} long" for name in KEY)
    return df.mapInArrow(run, keys + ", n_shingles long, digest binary, keys array<long>")


def node_of(seed: int) -> Column:
    """The number of a row's text, from its ``KEY``."""
    return F.xxhash64(F.lit(seed), *KEY)


def clear_seed(rows: DataFrame) -> int:
    """A seed by which no two keys of ``rows`` have the same number: the first one, almost always."""
    seed = 0
    while True:
        key = F.struct(*KEY)
        ends = rows.groupBy(node_of(seed).alias("node")).agg(
            F.min(key).alias("first"), F.max(key).alias("last")
        )
        if not ends.filter("first != last").limit(1).count():
            return seed
        seed += 1


def texts_of(texts: DataFrame, wanted: DataFrame, count: int) -> DataFrame:
    """``wanted``, at most ``count`` rows with a ``node``, each with the text of its class."""
    return texts.join(small(wanted, 64 * count), F.col("text_node") == F.col("node"))


def confirmed(texts: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(centre, member, shared, total)`` of ``pairs (centre, member)``, from the full sets.

    Members are dealt to groups of bounded size, each with a copy of its centre, so that a centre
    with any number of members is spread over tasks. Only texts that stand in a pair are shuffled
    more than once.
    """
    sized = pairs.groupBy("centre").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    members = pairs.join(sized, "centre").select(
        F.col("member").alias("node"),
        "centre",
        F.pmod(F.xxhash64("member"), F.col("groups")).alias("part"),
        F.lit(True).alias("is_member"),
    )
    copies = sized.select(
        F.col("centre").alias("node"),
        "centre",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"),
        F.lit(False).alias("is_member"),
    )
    # A member and at most one more copy of a centre per pair.
    dealt = (
        texts_of(texts, members.union(copies), 2 * pairs.count())
        .select("centre", "part", "is_member", "node", "text")
        .repartition("centre", "part")
        .sortWithinPartitions("centre", "part", "is_member", "node")
    )
    names = ["centre", "member", "shared", "total"]
    schema = pa.schema([(name, pa.int64()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, middle = None, np.empty(0, np.uint64)
        for rows, values, offsets in text_pieces(batches):
            hashes, bounds = shingle_sets(values, offsets, SHINGLE)
            out: list[tuple] = []
            columns = [rows.column(i).to_pylist() for i in range(4)]
            for at, (centre, part, is_member, node) in enumerate(zip(*columns)):
                own = hashes[bounds[at] : bounds[at + 1]]
                if not is_member:
                    present, middle = (centre, part), own.copy()
                    continue
                assert present == (centre, part)
                # Both are sorted and distinct.
                at_most = np.searchsorted(middle, own)
                at_most[at_most == len(middle)] = 0
                shared = int((middle[at_most] == own).sum()) if len(middle) else 0
                out.append((centre, node, shared, len(own) + len(middle) - shared))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in (zip(*out) if out else [[]] * 4)],
                schema=schema,
            )

    return scratch.table(
        dealt.mapInArrow(run, ", ".join(f"{name} long" for name in names)), "compared"
    )


def near_duplicates(
    df: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``df``.

    ``component_id`` is the least id that can be reached over links, ``kept`` says whether that is
    the row's own. A text that is null or without words has an empty set and is linked with
    nothing, so it is kept. Of rows that share an id each is placed by its own text: links of one
    say nothing about the other. Rows without an id take no part, have no component and are kept.
    """
    placed = placed_rows(df, scratch, key, text, percent)
    found = placed.select(
        "doc_id", "n_shingles", F.coalesce("least_id", "doc_id").alias("component_id")
    )
    own = F.col("component_id") == F.col("doc_id")
    return found.withColumn("kept", F.coalesce(own, F.lit(True)))


def keep_one(
    df: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """The rows and columns of ``df``, of every component one row: one with the least id, of several
    texts with that id always the same, of rows equal in id and text any. Rows without an id and
    texts without words stay."""
    placed = placed_rows(df, scratch, key, text, percent).filter("component IS NOT NULL")
    row = F.struct(*KEY)
    first = placed.groupBy("component").agg(
        F.min(row).alias("first"), F.min("least_id").alias("least_id")
    )
    first = scratch.table(first, "first")
    winners = first.select(*[F.col("first")[name].alias(name) for name in KEY])
    others = scratch.table(
        placed.groupBy(*KEY).agg(F.count("*").alias("rows")).join(
            small(winners.withColumn("wins", F.lit(True)), 64 * first.count()), KEY, "left"
        ).filter("wins IS NULL OR rows > 1").select(*KEY, F.col("wins").isNotNull().alias("wins")),
        "others",
    )
    names = df.columns
    rows = positional(df).select("*", *row_key(df, key, text))
    own = [f"column{place}" for place in range(len(names))]
    bound = 64 * others.count()
    kept = rows.join(small(others, bound), KEY, "left_anti").select(*own)
    # Of winners that stand there more than once, one each.
    several = others.filter("wins")
    if several.limit(1).count():
        again = rows.join(small(several, bound), KEY, "left_semi")
        kept = kept.union(again.dropDuplicates(KEY).select(*own))
    return kept.toDF(*names)


def row_key(df: DataFrame, key: str, text: str) -> list:
    """``KEY`` of a row with columns named by their places."""
    value = F.col(f"column{df.columns.index(text)}")
    identity = F.col(f"column{df.columns.index(key)}").cast("long").alias("doc_id")
    return [identity, *text_key(value)]


def placed_rows(
    df: DataFrame, scratch: Scratch, key: str, text: str, percent: int
) -> DataFrame:
    """``(doc_id, mark, twin, n_shingles, component, least_id)``, one row per row of ``df``; no
    component for rows that take no part."""
    texts = positional(df).select(
        *row_key(df, key, text), F.col(f"column{df.columns.index(text)}").alias("text")
    )
    rows = scratch.table(described(texts, percent), "signatures")
    with Scratch(df.sparkSession) as inner:
        known = "doc_id IS NOT NULL"
        seed = clear_seed(rows.filter(known))
        once, _ = one_each(texts.filter(known), KEY, inner, rows.filter(known))
        numbered = once.select(node_of(seed).alias("text_node"), "text")
        found = _components_of_classes(numbered, rows, seed, inner, percent)
        of_class = scratch.table(found, "classes")
    takes_part = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return rows.select(*KEY, "n_shingles", "digest").join(of_class, "digest", "left").select(
        *KEY,
        "n_shingles",
        F.when(takes_part, F.col("component")).alias("component"),
        F.when(takes_part, F.col("least_id")).alias("least_id"),
    )


def _components_of_classes(
    texts: DataFrame, rows: DataFrame, seed: int, scratch: Scratch, percent: int
) -> DataFrame:
    """``(digest, component, least_id)`` of every class of equal sets."""
    classes = scratch.table(
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(F.struct(*KEY, "n_shingles", "keys")).alias("row"))
        .select("digest", "row.*")
        .withColumn("node", node_of(seed)),
        "classes",
    )
    buckets = scratch.table(_buckets(classes, scratch), "buckets")
    spokes = buckets.filter("node != least").filter(_sizes_allow(percent))
    first = spokes.groupBy("node").agg(F.min(F.struct("least_id", "least")).alias("first"))
    hubs = first.select(F.col("first.least").alias("centre"), F.col("node").alias("member"))
    compared = confirmed(texts, hubs, scratch)
    links = _linked(compared, percent)
    found = scratch.table(components(links, scratch), "components")

    apart = scratch.table(_apart(buckets, found), "apart")
    unlike = apart.filter("component != least_component").filter(_sizes_allow(percent))
    further = unlike.select(
        F.col("least").alias("centre"), F.col("node").alias("member")
    )
    further = scratch.table(
        further.distinct().join(compared, ["centre", "member"], "left_anti"), "pairs"
    )
    if further.limit(1).count():
        more = confirmed(texts, further, scratch)
        links = links.union(_linked(more, percent))
        found = scratch.table(components(links, scratch), "components")

    apart = _apart(apart, found)
    pairs = scratch.table(
        _open_pairs(texts, apart, scratch, percent).distinct(), "pairs"
    )
    if pairs.limit(1).count():
        links = links.union(_linked(confirmed(texts, pairs, scratch), percent))
        found = scratch.table(components(links, scratch), "components")

    placed = scratch.table(
        classes.select("digest", "doc_id", "node")
        .join(found, "node", "left")
        .select("digest", "doc_id", F.coalesce("component", "node").alias("component")),
        "placed",
    )
    # A table of its own, so that the join can split a large component.
    least = scratch.table(
        placed.groupBy("component").agg(F.min("doc_id").alias("least_id")), "least"
    )
    return placed.join(least, "component").select("digest", "component", "least_id")


def _buckets(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(key, node, n_shingles, least, least_id, least_n)`` of the buckets with more than one class; the
    least of a bucket is the class with the least id, its centre, ``least_n`` the size of its set."""
    keyed = classes.select(F.explode("keys").alias("key"), "node", "doc_id", "n_shingles")
    # A table of its own, so that the join can split a bucket with many members.
    shared = scratch.table(
        keyed.groupBy("key")
        .agg(
            F.min(F.struct("doc_id", "node", "n_shingles")).alias("first"),
            F.count("*").alias("members"),
        )
        .filter("members > 1")
        .select(
            "key",
            F.col("first.node").alias("least"),
            F.col("first.doc_id").alias("least_id"),
            F.col("first.n_shingles").alias("least_n"),
        ),
        "shared",
    )
    return keyed.join(shared, "key").drop("doc_id")


def _sizes_allow(percent: int) -> Column:
    """Whether a class and the least of its bucket can be linked, by the sizes of their sets alone."""
    own, other = F.col("n_shingles"), F.col("least_n")
    return (100 * own >= percent * other) & (100 * other >= percent * own)


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    return compared.filter(F.col("shared") * 100 >= F.col("total") * percent).select(
        F.col("centre").alias("a"), F.col("member").alias("b")
    )


def _apart(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Buckets whose members are in more than one component, with everyone's component."""
    of_node = found.select("node", "component")
    of_least = found.select(F.col("node").alias("least"), F.col("component").alias("shared"))
    placed = (
        buckets.select("key", "node", "least", "n_shingles", "least_n")
        .join(of_node, "node", "left")
        .join(of_least, "least", "left")
        .select(
            "key",
            "node",
            "least",
            "n_shingles",
            "least_n",
            F.coalesce("component", "node").alias("component"),
            F.coalesce("shared", "least").alias("least_component"),
        )
    )
    mixed = placed.filter("component != least_component").select("key").distinct()
    return placed.join(mixed, "key", "left_semi")


def _signed(texts: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``(node, signature)``: one byte per value of the signature of some texts, and their keys."""
    schema = pa.schema([("node", pa.int64()), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values, offsets in text_pieces(batches):
            hashes, bounds = shingle_sets(values, offsets, SHINGLE)
            full = np.flatnonzero(np.diff(bounds))
            if not len(full):
                continue
            values = signatures(hashes, np.append(bounds[full], bounds[-1]))
            low = (mix(values.astype(np.uint64)) & np.uint64(255)).astype(np.uint8)
            keys = band_keys(values, percent).view(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("node").take(pa.array(full)),
                    pa.array(
                        [row.tobytes() for row in np.concatenate([low, keys], axis=1)], pa.binary()
                    ),
                ],
                schema=schema,
            )

    wanted = texts_of(texts, nodes, nodes.count())
    return wanted.select("node", "text").mapInArrow(run, "node long, signature binary")


def _open_pairs(
    texts: DataFrame, apart: DataFrame, scratch: Scratch, percent: int
) -> DataFrame:
    """``(centre, member)``: pairs of a bucket in different components that could be links.

    A bucket is cut into blocks, and every two blocks meet in one task, so that its size is bounded
    by nothing but the sum of all tasks' work. A pair is returned by the first bucket that it shares.
    """
    nodes = scratch.table(apart.select("node").distinct(), "nodes")
    signed = _signed(texts, nodes, percent)
    counts = apart.groupBy("key").agg(F.ceil(F.count("*") / GROUP).alias("blocks"))
    rows = (
        apart.join(counts, "key")
        .join(signed, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "node",
            "component",
            "n_shingles",
            "signature",
        )
    )
    schema = pa.schema([("centre", pa.int64()), ("member", pa.int64())])
    # Values agree by chance in one byte of 256; five standard errors below the limit.
    share = percent / 100
    least = share - 5 * (share * (1 - share) / (2 * PERMUTATIONS)) ** 0.5

    def likely(key: int, low: pa.Table, high: pa.Table) -> pa.RecordBatch:
        def column(table: pa.Table, name: str) -> np.ndarray:
            return table.column(name).to_numpy()

        def parts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            data = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8)
            data = data.reshape(len(table), -1)
            keys = np.ascontiguousarray(data[:, 2 * PERMUTATIONS :]).view(np.int64)
            return data[:, : 2 * PERMUTATIONS], keys

        (a, a_keys), (b, b_keys) = parts(low), parts(high)
        one, other = column(low, "node"), column(high, "node")
        allowed = column(low, "component")[:, None] != column(high, "component")[None, :]
        n, m = column(low, "n_shingles")[:, None], column(high, "n_shingles")[None, :]
        allowed &= (100 * n >= percent * m) & (100 * m >= percent * n)
        same = low is high
        if same:
            allowed &= one[:, None] < other[None, :]
        q, c = np.nonzero(allowed)
        found = [np.empty((2, 0), np.int64)]
        for begin in range(0, len(q), 1 << 14):
            i, j = q[begin : begin + (1 << 14)], c[begin : begin + (1 << 14)]
            agree = (a[i] == b[j]).mean(axis=1)
            near = (agree - 1 / 256) / (1 - 1 / 256) >= least
            i, j = i[near], j[near]
            shared = np.where(a_keys[i] == b_keys[j], a_keys[i], np.iinfo(np.int64).max)
            here = shared.min(axis=1) == key
            found.append(np.stack([one[i[here]], other[j[here]]]))
        pairs = np.sort(np.concatenate(found, axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        present = None

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                table = pa.Table.from_batches(held)
                if present[1] == present[2]:
                    yield likely(present[0], table, table)
                else:
                    in_low = pa.array(table.column("block").to_numpy() == present[1])
                    in_high = pa.array(table.column("block").to_numpy() == present[2])
                    yield likely(present[0], table.filter(in_low), table.filter(in_high))

        for batch in batches:
            groups = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.flatnonzero((groups[1:] != groups[:-1]).any(axis=1)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(groups)]):
                if tuple(groups[begin]) != present:
                    yield from close()
                    present, held = tuple(groups[begin]), []
                held.append(batch.slice(begin, end - begin))
        yield from close()

    dealt = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(run, "centre long, member long")
