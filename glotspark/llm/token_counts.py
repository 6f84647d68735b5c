"""Token counts of the sections of a text, from one encoding of the whole text.

A section encoded by itself can have other tokens than the same characters within the text. So a
text is encoded once; the spans of its tokens are joined with the spans of its sections, both in
order, and each token counts for one section:

* a token inside a section counts for it;
* a token that crosses boundaries counts for the section that holds most of its bytes, and for the
  first of several that hold as many.

The counts of a text's sections therefore add up to the count of the text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import plain
from .bpe import load


def attribute(token_ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(tokens, crossing)`` per section.

    ``token_ends`` are where the tokens end, ``starts`` where the sections start, from 0. Every
    crossing token is counted in ``crossing`` of the section that it counts for.
    """
    sections = len(starts)
    tokens = np.zeros(sections, dtype=np.int64)
    crossing = np.zeros(sections, dtype=np.int64)
    if not len(token_ends):
        return tokens, crossing
    begins = np.concatenate(([0], token_ends[:-1]))
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, token_ends - 1, side="right") - 1
    inside = first == last
    tokens += np.bincount(first[inside], minlength=sections)
    ends = np.append(starts[1:], token_ends[-1])
    for at in np.flatnonzero(~inside).tolist():
        parts = range(int(first[at]), int(last[at]) + 1)
        held = [
            min(int(ends[k]), int(token_ends[at])) - max(int(starts[k]), int(begins[at]))
            for k in parts
        ]
        chosen = parts[held.index(max(held))]
        tokens[chosen] += 1
        crossing[chosen] += 1
    return tokens, crossing


def line_starts(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which lines start; a line feed belongs to the line before it. A line feed at
    the end starts no further line."""
    after = np.flatnonzero(data == 10) + 1
    return np.concatenate(([0], after[after < len(data)]))


def count_by_line(
    df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, section, start, end, n_tokens, n_crossing)``: one row per line of every text.

    ``section`` counts from 0; ``start`` and ``end`` are code points, end exclusive. A null or
    empty text has one empty section without tokens. Repeated rows and null keys stay. One pass
    over the rows, no shuffle.
    """
    names = ["section", "start", "end", "n_tokens", "n_crossing"]
    schema = pa.schema([(name, pa.int64()) for name in ["doc_id", *names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path, pattern)
        for batch in batches:
            for begin in range(0, len(batch), 256):
                rows = batch.slice(begin, 256)
                columns: dict[str, list] = {name: [] for name in names}
                repeats = []
                for value in rows.column("text").to_pylist():
                    value = value or ""
                    data = np.frombuffer(value.encode(), np.uint8)
                    starts = line_starts(data)
                    ids = np.array(pairs.encode(value), dtype=np.int64)
                    tokens, crossing = attribute(np.cumsum(pairs.lengths[ids]), starts)
                    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                    for name, part in (
                        ("section", np.arange(len(starts))),
                        ("start", points[starts]),
                        ("end", points[np.append(starts[1:], len(data))]),
                        ("n_tokens", tokens),
                        ("n_crossing", crossing),
                    ):
                        columns[name].append(part)
                    repeats.append(len(starts))
                keys = rows.column("doc_id").cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(np.repeat(np.arange(len(rows)), repeats)))]
                    + [pa.array(np.concatenate(columns[name]), pa.int64()) for name in names],
                    schema=schema,
                )

    return plain(df, key, text).mapInArrow(
        run, ", ".join(f"`{name}` long" for name in schema.names)
    )


def count_by_field(
    df: DataFrame,
    path: str,
    pattern: str,
    fields: Sequence[str],
    key: str = "doc_id",
    glue: str = "\n",
) -> DataFrame:
    """``(doc_id, field, n_tokens, n_crossing)``: fields encoded as one text, joined by ``glue``.

    The glue belongs to the field before it. A null field counts as empty and has no tokens but
    those of its glue.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("field", pa.string()),
            ("n_tokens", pa.int64()),
            ("n_crossing", pa.int64()),
        ]
    )
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path, pattern)
        for batch in batches:
            columns = [batch.column(i + 1).to_pylist() for i in range(len(names))]
            out: list[tuple] = []
            for at, row in enumerate(zip(*columns)):
                parts = [(value or "") + glue for value in row]
                parts[-1] = parts[-1][: len(parts[-1]) - len(glue)]
                sizes = [len(part.encode()) for part in parts]
                # A last field without bytes starts where the text ends and gets no token.
                starts = np.concatenate(([0], np.cumsum(sizes[:-1])))
                ids = np.array(pairs.encode("".join(parts)), dtype=np.int64)
                counts = attribute(np.cumsum(pairs.lengths[ids]), starts)
                out += [(at, name, *pair) for name, *pair in zip(names, *counts)]
            rows, name, tokens, crossing = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()).take(pa.array(rows, pa.int64())),
                    pa.array(name, pa.string()),
                    pa.array(tokens, pa.int64()),
                    pa.array(crossing, pa.int64()),
                ],
                schema=schema,
            )

    chosen = [F.col(name).cast("string").alias(f"field_{i}") for i, name in enumerate(names)]
    return df.select(F.col(key).alias("doc_id"), *chosen).mapInArrow(
        run, "doc_id long, field string, n_tokens long, n_crossing long"
    )
