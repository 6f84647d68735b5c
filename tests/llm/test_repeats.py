import random

import numpy as np
import pytest

from glotspark.functions.storage import Scratch
from glotspark.llm import repeats
from pyspark.sql import functions as F

L = 400
DDL = "doc_id long, text string, bucket string, start long"


def corpus():
    """Copies, shared passages, repeats within a text, periods, short and odd texts."""
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(110), prose(300)
    texts = [prose(200) for _ in range(8)]
    texts += [prose(40) + passage + prose(30) for _ in range(6)]
    texts += [passage[i : i + 500] for i in (0, 3, 50)]
    texts += [base, base, base.replace("a", "b", 3), base[:700] + "X" + base[700:]]
    inside = prose(90)
    texts += [inside + prose(20) + inside, "ab" * 900, "x" * 1200, "same line\n" * 120]
    texts += [None, "", "short", base[:399], base[:400]]
    return [(i, text, "b", 1) for i, text in enumerate(texts)] + [(3, texts[3], "b", 2)]


def brute(rows):
    datas = [(row[0], (row[1] or "").encode()) for row in rows]
    seen = {}
    for _, data in datas:
        for at in range(len(data) - L + 1):
            piece = data[at : at + L]
            seen[piece] = seen.get(piece, 0) + 1
    out = []
    for doc, data in datas:
        covered = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - L + 1):
            if seen[data[at : at + L]] > 1:
                covered[at : at + L] = True
        begin, end = repeats.bits_to_runs(covered)
        kept = bytes(np.frombuffer(data, np.uint8)[~covered])
        out.append((doc, len(data), kept, list(zip(begin.tolist(), end.tolist()))))
    return sorted(out)


def run(spark, rows):
    with Scratch(spark) as scratch:
        df = spark.createDataFrame(rows, DDL)
        got = repeats.remove_repeats(df, scratch).collect()
    return sorted(
        (row.doc_id, row.n_bytes, bytes(row.kept), [tuple(span) for span in row.spans])
        for row in got
    )


@pytest.mark.parametrize("group, small", [(128, 1 << 26), (2, 1 << 26), (1, 0)])
def test_equals_brute_force(spark, monkeypatch, group, small):
    """Also where every bucket counts as too large, and where no table counts as small."""
    monkeypatch.setattr(repeats, "GROUP", group)
    monkeypatch.setattr("glotspark.llm.joins.SMALL_BYTES", small)
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_hot_bucket(spark, monkeypatch):
    """One passage in many texts, each with its own surroundings."""
    monkeypatch.setattr(repeats, "GROUP", 4)
    draw = random.Random(3)
    prose = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage = prose(450)
    rows = [(i, prose(200) + passage + prose(200), "b", 0) for i in range(40)]
    assert run(spark, rows) == brute(rows)


def test_null_ids_and_empty_table(spark):
    text = "".join(chr(97 + i * i % 23) + str(i) for i in range(200))
    rows = [(None, text, None, None), (None, text, None, None), (None, None, None, None)]
    with Scratch(spark) as scratch:
        df = spark.createDataFrame(rows, DDL)
        got = repeats.summary(repeats.remove_repeats(df, scratch)).collect()
        assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in got) == [
            (0, 0, 0),
            (len(text), len(text), 1),
            (len(text), len(text), 1),
        ]
        empty = spark.createDataFrame([], DDL)
        assert repeats.remove_repeats(empty, scratch).count() == 0


def test_texts_of_equal_short_hashes_are_told_apart(spark):
    """Two texts without an id whose 32-bit hashes are equal; one holds a passage that repeats."""
    draw = random.Random(11)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(450))
    heads = spark.range(1 << 17).select(
        F.concat(F.lit(passage), F.hex(F.xxhash64("id"))).alias("text")
    )
    tails = spark.range(1 << 17).select(
        F.concat(F.hex(F.xxhash64("id", F.lit(9))), F.lit("." * 292)).alias("text")
    )
    pair = heads.select("text", F.hash("text").alias("h")).join(
        tails.select(F.col("text").alias("other"), F.hash("text").alias("h")), "h"
    ).orderBy("text").first()
    rows = [(None, pair.text, "b", 1), (None, pair.other, "b", 1), (-1, passage + "!", "b", 1)]
    rows += [(7, pair.text[:40], "b", 1), (7, pair.other, "b", 1)]
    spread = [(i, *row[1:]) for i, row in enumerate(rows)]
    want = sorted(row[1:] for row in brute(spread))
    with Scratch(spark) as scratch:
        got = repeats.remove_repeats(spark.createDataFrame(rows, DDL), scratch).collect()
    assert want == sorted(
        (r.n_bytes, bytes(r.kept), [tuple(span) for span in r.spans]) for r in got
    )


def test_many_copies_of_a_row(spark):
    draw = random.Random(13)
    text = "".join(draw.choice("abcdefgh ") for _ in range(900))
    rows = [(1, text, "b", 1)] * 10_000 + [(2, text[:600] + "?" * 50, "b", 1), (3, "?" * 30, "b", 1)]
    got = run(spark, rows)
    assert [r[3] for r in got[:10_000]] == [[(0, 900)]] * 10_000
    assert got[10_000][3] == [(0, 600)] and got[10_001][3] == []


def test_refine_finds_equal_starts():
    data = np.frombuffer(b"abcdefghijklmnopqrst" + b"zzcdefghijklmnopqryy", np.uint8)
    found = repeats.refine(data, np.array([0, 20]), np.array([8, 8]), 13)
    assert np.flatnonzero(found).tolist() == [2, 3, 4, 5, 22, 23, 24, 25]
