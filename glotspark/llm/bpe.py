"""Byte-level BPE encoding and decoding with a local rank file.

``encode`` gives every text the ids that tiktoken's ``encode_ordinary`` gives it. Texts are cut
before the merges at places where a match of the splitting pattern must end whatever surrounds
them, so that a long text costs time in proportion to its length and no regex sees all of it:

* before a single space between two characters that aren't white space: no match holds a space
  after other characters, so the match before it has ended;
* around runs of white space too long for the regex engine's stack; the pattern gives such a run
  one piece, without its last character where more text follows, and that piece is merged as it is.

``decode`` joins the bytes of the ids; it never replaces bytes that aren't valid UTF-8.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .arrow import plain, release_memory, strings

# Texts above this many characters are cut before they are split by the pattern.
CUT_CHARS = 1 << 16

# What the pattern's \s matches (Unicode White_Space).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_SPACE = re.compile(f"[{SPACE}]{{4096,}}")
# A space before the first character of a word; the match before it has ended.
_SAFE = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


class BytePairs:
    """One rank file with its splitting pattern; use ``load``, which keeps it per process."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        size = max(ranks.values(), default=-1) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(token) for token in self.tokens], dtype=np.int64)
        self.decimals = [b"%d" % rank for rank in range(size)]

    def encode(self, text: str) -> list[int]:
        if len(text) <= CUT_CHARS:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        begin = 0
        for run in _LONG_SPACE.finditer(text):
            # The last character of a run joins the next word, or is a piece of its own.
            end = run.end() if run.end() == len(text) else run.end() - 1
            self._extend(ids, text, begin, run.start())
            ids.extend(self.encoding._encode_single_piece(text[run.start() : end]))
            begin = end
        self._extend(ids, text, begin, len(text))
        return ids

    def _extend(self, ids: list[int], text: str, begin: int, end: int) -> None:
        while end - begin > CUT_CHARS:
            safe = _SAFE.search(text, begin + CUT_CHARS, end)
            if not safe:
                break
            ids.extend(self.encoding.encode_ordinary(text[begin : safe.start()]))
            begin = safe.start()
        ids.extend(self.encoding.encode_ordinary(text[begin:end]))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decimal(self, ids) -> bytes:
        """The ids in decimal, one space between them."""
        return b" ".join(map(self.decimals.__getitem__, ids))


def encode(
    df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, ids, exact)``: the token ids of every whole text; a null text has none.

    ``exact`` tells whether the ids decode to the text's bytes. One pass over the rows, no shuffle.
    Repeated rows and null keys stay as they are.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("exact", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path, pattern)
        for batch in batches:
            for begin in range(0, len(batch), 256):
                rows = batch.slice(begin, 256)
                texts = strings(rows.column("text"))
                ids = [pairs.encode(each) for each in texts]
                exact = [pairs.decode(own) == each.encode() for own, each in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").cast(pa.int64()),
                        pa.array(ids, schema.field(1).type),
                        pa.array(exact),
                    ],
                    schema=schema,
                )
        release_memory()

    return plain(df, key, text).mapInArrow(run, "doc_id long, ids array<int>, exact boolean")


def decode(
    df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """``(doc_id, bytes)`` of token ids; null ids decode to no bytes."""
    from pyspark.sql import functions as F

    schema = pa.schema([("doc_id", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path, pattern)
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([pairs.decode(row or ()) for row in rows], pa.binary()),
                ],
                schema=schema,
            )

    chosen = df.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))
    return chosen.mapInArrow(run, "doc_id long, bytes binary")


def round_trip(
    df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` without storing the ids.

    The same ``encode`` and ``decode``, text by text, for checks of whole corpora.
    """
    import hashlib

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path, pattern)
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for begin in range(0, len(batch), 256):
                for each in strings(batch.column("text").slice(begin, 256)):
                    ids = pairs.encode(each)
                    counts.append(len(ids))
                    encoded.append(hashlib.sha256(pairs.decimal(ids)).hexdigest())
                    decoded.append(hashlib.sha256(pairs.decode(ids)).hexdigest())
            columns = (counts, encoded, decoded)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64())]
                + [pa.array(values, kind) for values, kind in zip(columns, kinds[1:])],
                schema=schema,
            )

    return plain(df, key, text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
