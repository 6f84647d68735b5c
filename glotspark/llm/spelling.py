"""Spelling variants: words that one inserted, deleted or replaced character makes of another.

Near words are found with bit-sliced position indexes. For every place and letter there is a bitset over
the indexed words, and a query word runs through them letter by letter: one set holds the words without
an error so far, others those with one, by how far their letters are shifted since. Sets are whole
numbers, so one operation treats all indexed words at once.

The vocabulary is cut into blocks first. Of two near words, the shorter one of ``size`` letters, the
first or the last ``size // 2`` letters are equal, so each word stands in the blocks of its halves, once
as the shorter word of a pair (or one of the same length) and once as the longer one. A block with very
many words is cut into cells, each with an index over some of its words and all of them as queries. No
pairs leave a task, only one row per query and cell: how many near words there are, and the best one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

from .joins import small

# Letters of a run, the least letters and occurrences of a word, how many times more
# frequent a word's form is, and which runs lose a letter.
LETTERS = "A-Za-zÀ-ÿ"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10
DAMAGED = 31

# Words of an index, on average at most, and queries that go through it at a time.
CELL = 4_096
QUERIES = 4_096


def run_counts(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST_LETTERS,
    damaged: int = 0,
) -> DataFrame:
    """``(word, n)``: how often each run of letters of at least ``least`` code points occurs.

    Only A-Z is lower-cased. With ``damaged``, a run loses a letter if that number divides the crc32
    ``h`` of ``<key>:<run>``, the letter at ``h`` modulo the run's length. A null key is written as
    nothing, a null text has no runs. Shorter runs can't make a word, so they are never cut out.
    """
    runs = df.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.explode(
            F.regexp_extract_all(
                F.col(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)
            )
        ).alias("run"),
    ).select("key", F.translate("run", CAPITALS, SMALL).alias("run"))
    if damaged:
        hashed = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
        runs = runs.select("run", hashed.alias("h"))
        place = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(
            F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run"))
        )
        runs = runs.select(
            F.when(F.col("h") % damaged == 0, cut).otherwise(F.col("run")).alias("run")
        ).filter(F.length("run") >= least)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))


# ---- the index ------------------------------------------------------------------------------


def slices(words: list[str], place: int) -> dict[str, int]:
    """The bitset over ``words`` of every letter that stands at ``place``."""
    found: dict[str, int] = {}
    for number, word in enumerate(words):
        if place < len(word):
            letter = word[place]
            found[letter] = found.get(letter, 0) | 1 << number
    return found


def near_sets(words: list[str], queries: list[str], own: list[int], size: int) -> list[int]:
    """For every query the set of the indexed ``words`` that one error makes of it.

    Words and queries have ``size`` letters or one more. Pairs of two longer ones are left out: they
    are found where ``size`` is their length. ``own`` is a query's place among the words, or -1.

    ``none``: words whose first letters are the query's so far; ``one``: those with one letter
    replaced; ``ahead``: those with one letter more; ``behind``: those with one less.
    """
    every = (1 << len(words)) - 1
    short = sum(1 << number for number, word in enumerate(words) if len(word) == size)
    results = [0] * len(queries)
    alike, longer = [], []
    for number, query in enumerate(queries):
        none = every if own[number] < 0 else every ^ (1 << own[number])
        if len(query) == size:
            alike.append((number, none, 0, 0))
        elif none & short:
            longer.append((number, none & short, 0))
    before: dict[str, int] = {}
    here = slices(words, 0)
    for place in range(size + 1):
        after = slices(words, place + 1)
        still = []
        for number, none, one, ahead in alike:
            if place == size:
                results[number] = (one & short) | ((ahead | none) & ~short)
                continue
            letter = queries[number][place]
            match = here.get(letter, 0)
            ahead = (ahead | none) & after.get(letter, 0)
            same = none & match
            one = (one & match) | (none ^ same)
            if same or one or ahead:
                still.append((number, same, one, ahead))
        alike = still
        still = []
        for number, none, behind in longer:
            letter = queries[number][place]
            behind = (behind & before.get(letter, 0)) | none
            none &= here.get(letter, 0)
            if place == size:
                results[number] = behind
            elif none or behind:
                still.append((number, none, behind))
        longer = still
        if not alike and not longer:
            break
        before, here = here, after
    return results


def numbers(bits: int) -> Iterator[int]:
    """The members of a bitset."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


class Cell:
    """The index over some words of a block, asked by all its words."""

    def __init__(self, size: int, head: bool):
        self.size, self.half, self.head = size, size // 2, head
        self.words: list[str] = []
        self.counts: list[int] = []
        self.queries: list[tuple[str, int]] = []

    def rest(self, word: str) -> str:
        """What is left of a word without the half that a block's words share."""
        return word[self.half :] if self.head else word[: len(word) - self.half]

    def add(self, word: str, count: int, indexed: bool) -> None:
        if indexed:
            self.words.append(word)
            self.counts.append(count)
        self.queries.append((word, len(self.words) - 1 if indexed else -1))

    def answers(self) -> Iterator[tuple[str, int, int, str]]:
        """``(word, n_near, best_n, best)`` of the queries so far that have near words."""
        asked, self.queries = self.queries, []
        if not self.words or (len(self.words) == 1 and asked[0][1] == 0 and len(asked) == 1):
            return
        sets = near_sets(
            [self.rest(word) for word in self.words],
            [self.rest(word) for word, _ in asked],
            [own for _, own in asked],
            self.size - self.half,
        )
        for (word, _), bits in zip(asked, sets):
            near, best = 0, None
            for number in numbers(bits):
                other = self.words[number]
                # Pairs that share both halves count in the block of the first one. Blocks that
                # share no more than a key are told apart here too.
                same_head = word[: self.half] == other[: self.half]
                if same_head != self.head:
                    continue
                if not self.head and word[-self.half :] != other[-self.half :]:
                    continue
                near += 1
                offer = (-self.counts[number], other)
                if best is None or offer < best:
                    best = offer
            if near:
                yield word, near, -best[0], best[1]


# ---- blocks ---------------------------------------------------------------------------------


def _blocks(counts: DataFrame) -> DataFrame:
    """``(block, size, head, word, n)``: every word in the blocks of its halves."""
    length = F.length("word")
    sizes = F.array(length, length - 1)
    halves = counts.select("word", "n", F.explode(sizes).alias("size")).filter("size >= 2")
    sided = halves.select(
        "word", "n", "size", F.explode(F.array(F.lit(True), F.lit(False))).alias("head")
    )
    half = F.floor(F.col("size") / 2).cast("int")
    shared = F.when(F.col("head"), F.left("word", half)).otherwise(F.right("word", half))
    return sided.select(F.xxhash64("size", "head", shared).alias("block"), "size", "head", "word", "n")


def near_words(counts: DataFrame, scratch: Scratch, cell: int = CELL) -> DataFrame:
    """``(word, n, n_near, best_n, best)`` of ``(word, n)``, words distinct; nulls without near words.

    ``best`` is the near word with the largest ``n``, of several the first in code-point order. Words
    of one letter take no part.
    """
    blocks = _blocks(counts)
    large = scratch.table(
        blocks.groupBy("block", "size", "head")
        .agg(F.count("*").alias("words"))
        .filter("words > 1")
        .select("block", "size", "head", F.ceil(F.col("words") / cell).cast("int").alias("cells")),
        "blocks",
    )
    dealt = (
        blocks.join(small(large, 32 * large.count()), ["block", "size", "head"])
        .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .withColumn("indexed", F.pmod(F.xxhash64("word"), F.col("cells")) == F.col("cell"))
        .select("block", "size", "head", "cell", "indexed", "word", "n")
        .repartition("block", "size", "head", "cell")
        .sortWithinPartitions("block", "size", "head", "cell", F.desc("indexed"))
    )
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["word", "n_near", "best_n", "best"]
    schema = pa.schema(list(zip(names, kinds)))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, current = None, None
        for batch in batches:
            rows: list[tuple] = []
            for block, size, head, number, indexed, word, count in zip(
                *(column.to_pylist() for column in batch.columns)
            ):
                if (block, size, head, number) != present:
                    if current:
                        rows.extend(current.answers())
                    present, current = (block, size, head, number), Cell(size, head)
                elif not indexed and len(current.queries) >= QUERIES:
                    rows.extend(current.answers())
                current.add(word, count, indexed)
            yield batch_of(rows)
        if current:
            yield batch_of(list(current.answers()))

    answers = dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")
    nothing = F.lit(None)
    own = counts.select(
        "word", "n", F.lit(0).cast("long").alias("n_near"),
        nothing.cast("long").alias("best_n"), nothing.cast("string").alias("best"),
    )
    found = answers.select("word", nothing.cast("long").alias("n"), "n_near", "best_n", "best")
    best = F.min(
        F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best"))
    )
    return (
        own.union(found)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("near"))
        .select(
            "word", "n", "n_near", (-F.col("near.less")).alias("best_n"), F.col("near.best").alias("best")
        )
    )


# ---- forms and roots ------------------------------------------------------------------------


def _bytes(df: DataFrame, *columns: str) -> int:
    """What the rows of a table of strings hold at most, from their measured lengths."""
    lengths = sum((F.octet_length(F.coalesce(F.col(c), F.lit(""))) for c in columns), F.lit(64))
    return df.agg(F.sum(lengths.cast("long"))).first()[0] or 0


def roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, root)`` of links ``(word, form)`` without cycles, one per word: the last form.

    Every round halves the steps that are left. A form is many times as frequent as its word, so
    there are few: their number grows with the logarithm of the largest count.
    """
    now = scratch.table(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(small(onward, _bytes(now, "word", "root")), "root", "left")
        after = scratch.table(
            joined.select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "roots",
        )
        moved = after.filter("moved").limit(1).count()
        scratch.drop(now)
        now = after
        if not moved:
            return now.select("word", "root")


def group(
    counts: DataFrame, scratch: Scratch, times: int = TIMES, cell: int = CELL
) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of ``(word, n)``, words distinct.

    A word's form is its near word with the largest ``n`` (of several the first in code-point
    order) if that is at least ``times`` its own, which must be above 1; else null. Its root is what
    forms lead to in the end, or the word itself. An empty table gives no rows.
    """
    with Scratch(counts.sparkSession) as inner:
        known = inner.table(counts, "words")
        near = scratch.table(near_words(known, inner, cell), "near")
    has_form = F.col("best_n") >= times * F.col("n")
    formed = near.select(
        "word",
        "n",
        "n_near",
        F.when(has_form, F.col("best")).alias("form"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    found = roots(formed.filter("form IS NOT NULL"), scratch)
    joined = formed.join(small(found, _bytes(found, "word", "root")), "word", "left")
    return joined.withColumn("root", F.coalesce("root", "word"))


def crc32_sql(text: str) -> str:
    """The crc32 of an SQL text in DuckDB, by the usual table of 256 remainders."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    values = f"list_transform({pairs}, lambda pair: ('0x' || pair)::UBIGINT)"
    step = f"xor(c >> 8, ({table}::UBIGINT[])[(xor(c, b) & 255)::BIGINT + 1])"
    full = "4294967295::UBIGINT"
    return f"xor(list_reduce({values}, lambda c, b: {step}, {full}), {full})"


def sql() -> str:
    """The same over a table ``documents`` in DuckDB, by words with one letter taken out."""
    crc = crc32_sql("key || ':' || run")
    return f"""
    WITH RECURSIVE runs AS (
        SELECT translate(unnest(regexp_extract_all(text, '[{LETTERS}]{{{LEAST_LETTERS},}}')),
            '{CAPITALS}', '{SMALL}') AS run, coalesce(doc_id::VARCHAR, '') AS key
        FROM documents
    ), hashed AS (
        SELECT run, {crc} AS h FROM runs
    ), cut AS (
        SELECT CASE WHEN h % {DAMAGED} = 0 THEN substr(run, 1, (h % length(run))::BIGINT)
            || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed
    ), words AS MATERIALIZED (
        SELECT word, count(*) AS n FROM cut WHERE length(word) >= {LEAST_LETTERS}
        GROUP BY word HAVING count(*) >= {LEAST_COUNT}
    ), shorter AS MATERIALIZED (
        SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM words, unnest(range(1, length(word) + 1)) AS places(i)
    ), near AS (
        SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b
            ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION
        SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
        UNION
        SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
    ), counted AS (
        SELECT word, count(*) AS n_near FROM near GROUP BY word
    ), best AS (
        SELECT word, other, n FROM near
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other COLLATE "binary") = 1
    ), formed AS MATERIALIZED (
        SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
            CASE WHEN b.n >= {TIMES} * w.n THEN other END AS form,
            CASE WHEN b.n >= {TIMES} * w.n THEN b.n END AS form_n
        FROM words w LEFT JOIN counted USING (word) LEFT JOIN best b USING (word)
    ), chain AS (
        SELECT word, word AS root, 0 AS step FROM formed
        UNION ALL
        SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.root
        WHERE f.form IS NOT NULL
    ), last AS (
        SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word
    )
    SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)
    """
