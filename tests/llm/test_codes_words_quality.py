import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch
from glotspark.llm import orchard, quality, spelling
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int, codes string, `a.b` string"


# ---- vector codes ---------------------------------------------------------------------------


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // parts) * parts
    whole = [
        [int(np.floor(1024 * float(np.float32(x)))) for x in r[1]] + [0] * (width - len(r[1]))
        for r in kept
    ]
    order = sorted(
        range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i][: len(kept[i][1])])
    )
    size = width // parts
    points = np.array(whole, dtype=np.int64).reshape(len(kept), parts, size)
    books = points[order[:entries]].transpose(1, 0, 2).copy()

    def assign():
        apart = ((points[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return apart.argmin(axis=2), apart.min(axis=2)

    for _ in range(rounds):
        found, _ = assign()
        for part in range(parts):
            for entry in range(books.shape[1]):
                own = points[found[:, part] == entry, part]
                if len(own):
                    books[part, entry] = own.sum(axis=0) // len(own)
    found, apart = assign()
    errors = apart.sum(axis=1)
    labels = Counter()
    for row, error in zip(kept, errors.tolist()):
        labels[row[2]] += error
    return sorted(
        ((r[0], found[i].tolist(), int(errors[i]), labels[r[2]]) for i, r in enumerate(kept)), key=repr
    ), books


def codes(spark, rows):
    with Scratch(spark) as scratch:
        coded, books = orchard.compress(spark.createDataFrame(rows, VECTORS), scratch)
        got = coded.select("vec_id", "codes", "error", "label_error").collect()
    return sorted(map(tuple, got), key=repr), books


def test_codes_equal_brute_force(spark):
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((12, 24))
    vectors = centres[draw.integers(12, size=700)] + draw.standard_normal((700, 24)) / 4
    vectors[50:300] = vectors[50]  # a hot vector, also among the first entries: ties
    rows = [
        (int(i) * 3 % 701, [float(x) for x in v], int(i % 4) or None, "c", "d")
        for i, v in enumerate(vectors)
    ]
    got, books = codes(spark, rows)
    want, wanted = brute_codes(rows)
    assert got == want and (books == wanted).all()


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, -0.5, 0.25, 0.0, 3.0], 1, "", ""), (5, [0.5, 0.5, 0.5, 0.5, 0.5], 1, "", ""),
        (1, None, 1, "", ""), (2, [nan] * 5, 1, "", ""), (3, [1.0, None], 1, "", ""), (4, [inf], 1, "", ""),
        (None, [0.1, 0.2], None, "", ""), (7, [], None, "", ""), (7, [], None, "", ""),
    ]
    got, books = codes(spark, rows)
    want, wanted = brute_codes(rows)
    assert got == want and (books == wanted).all()
    assert codes(spark, [])[0] == [] and codes(spark, rows[2:3])[0] == []
    huge = [(i, [3e38, -3e38, 0.0, 1.0], 1, "", "") for i in range(3)]
    assert [row[2] for row in codes(spark, huge)[0]] == [0, 0, 0]


def test_search_through_lists_finds_the_first_nearest_entry():
    draw = np.random.default_rng(3)
    for size, spread in ((1, 4), (3, 6), (16, 900)):
        entries = draw.integers(-spread, spread, (256, size))
        points = draw.integers(-spread, spread, (3000, size))
        apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        found, distance = orchard.Lists(entries).nearest(points)
        assert (found == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_decoded_codes_have_the_stated_error(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    with Scratch(spark) as scratch:
        coded, books = orchard.compress(vectors, scratch)
        rows = orchard.whole_vectors(vectors, "vec_id", "embedding", "label").alias("w")
        both = orchard.decode(coded, books).alias("c").join(rows, "vec_id")
        apart = F.aggregate(
            F.zip_with("c.vector", "w.vector", lambda x, y: (x - y) * (x - y)),
            F.lit(0).cast("long"), lambda a, x: a + x,
        )
        assert both.filter(apart != F.col("error")).count() == 0 and both.count() == vectors.count()


# ---- spelling -------------------------------------------------------------------------------


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, times=10):
    form, out = {}, {}
    for word, n in counts.items():
        others = [w for w in counts if w != word and len(w) + len(word) > 2 and near(w, word)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best and counts[best] >= times * n else None
        out[word] = len(others)
    rows = []
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        rows.append((word, n, out[word], form[word], form[word] and counts[form[word]], root))
    return sorted(rows)


def words(draw):
    counts = {}
    for _ in range(60):
        word = "".join(draw.choice("abcdeéü") for _ in range(draw.randint(7, 12)))
        n = draw.choice([2, 30, 400, 5000])
        for _ in range(draw.randint(1, 9)):
            counts.setdefault(word, max(2, n))
            place, kind = draw.randrange(len(word)), draw.randrange(3)
            middle = "" if kind == 0 else draw.choice("abcde") + (word[place] if kind == 1 else "")
            word = word[:place] + middle + word[place + 1 :]
            n = draw.choice([n, n // 10])
    return {word: n for word, n in counts.items() if len(word) >= 2}


@pytest.mark.parametrize("cell, queries", [(4096, 4096), (3, 2)])
def test_groups_equal_brute_force(spark, monkeypatch, cell, queries):
    """Also where blocks are cut into many cells, and cells asked a few words at a time."""
    monkeypatch.setattr(spelling, "QUERIES", queries)
    counts = words(random.Random(6))
    counts |= {"aaaaaaa": 9, "aaaaaaaa": 90, "aaaaaaaaa": 900, "aaaaaaab": 2, "ab": 3, "ac": 40, "abc": 5}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    with Scratch(spark) as scratch:
        got = spelling.group(df, scratch, cell=cell).collect()
    assert sorted(map(tuple, got)) == brute_groups(counts)


def test_very_long_words_and_no_words(spark):
    long = "xyz" * 4000
    rows = [(long, 2), (long[:6000] + "q" + long[6000:], 30), (long[1:], 3), ("other words", 7)]
    with Scratch(spark) as scratch:
        got = spelling.group(spark.createDataFrame(rows, "word string, n long"), scratch).collect()
        assert sorted(map(tuple, got)) == brute_groups(dict(rows))
        assert spelling.group(spark.createDataFrame([], "word string, n long"), scratch).count() == 0


def test_runs_are_counted_like_a_plain_scan(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    rows = [(i, text, "w", "x") for i, text in enumerate(texts)]
    rows += [(None, "Straßenbahn ÉTOILES étoiles", "", ""), (3, None, "", ""), (3, "", "", ""), rows[5]]
    want = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, run string")
    got = {row.word: row.n for row in spelling.run_counts(df, damaged=31).collect()}
    assert got == want
    assert spelling.run_counts(df.limit(0), damaged=31).count() == 0
    plain = {row.word: row.n for row in spelling.run_counts(df).collect()}
    assert plain["étoiles"] == 1 and plain["Étoiles".replace("É", "É").lower().replace("é", "É")] == 1


# ---- quality --------------------------------------------------------------------------------

DOCS = "doc_id long, text string, words string, total long, `a.b` string"


def brute_rules(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (
        len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed
    )


def prose(draw, count):
    return " ".join(
        draw.choice(["the", "of", "and"]) if draw.random() < 0.4 else
        "".join(draw.choice(["ing", "er", "tion", "an", "re"]) for _ in range(draw.randint(1, 4)))
        for _ in range(count)
    )


def test_rules_equal_a_plain_scan(spark):
    draw = random.Random(2)
    texts = [None, "", " \n\t", "one", "a b c a b c", "a a a a", "x\n\nx\n x\nx\r\n", "𝒳 𝒳é #*$%&|<>   \x0b\x0c"]
    texts += [prose(draw, draw.randint(40, 300)) for _ in range(20)]
    texts += [texts[9] + "\n" + texts[9], "same words here\n" * 60, " ".join(["w"] * 30_000)]
    texts += [" ".join(f"w{i}" for i in range(20_000)) + " w0 w1 w2", "|" * 300 + "\n" + prose(draw, 60)]
    rows = [(i, text, "w", 1, "x") for i, text in enumerate(texts)] + [(9, texts[9], "w", 1, "x")] * 2
    rows += [(None, "a b c a b c", "w", 1, "x")]
    df = spark.createDataFrame(rows, DOCS)
    got = quality.judge(df, quality.Ratio([0] * quality.BUCKETS)).collect()
    key = lambda row: repr(row[0])
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(
        ((row[0], *brute_rules(row[1])) for row in rows), key=repr
    )
    assert len(got) == len(rows) and all(r.kept != r.base_failed for r in sorted(got, key=key))
    assert all((r.ratio is None) == (r.n_words == 0) for r in got)
    assert quality.judge(df.limit(0), quality.Ratio([0] * quality.BUCKETS)).count() == 0


def test_texts_unlike_the_trusted_ones_go(spark):
    draw = random.Random(4)
    rows, junk = [], set()
    for i in range(400):
        text = prose(draw, draw.randint(60, 400))
        if i % 5 == 0:
            junk.add(i)
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 2 else text.replace(" ", " | ")
        rows.append((i, text, "w", 1, "x"))
    rows.append((None, rows[1][1], "w", 1, "x"))
    df = spark.createDataFrame(rows, DOCS)
    # Labels with repeated and null ids; one of different qualities is not trusted.
    labels = [(i, int(i not in junk)) for i in range(0, 400, 2)] + [(2, 1), (4, 0), (None, 1), (6, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    ratio = quality.fit(df, labels)
    got = {r.doc_id: (r.kept, r.ratio) for r in quality.judge(df, ratio).collect()}
    assert {i for i, (kept, _) in got.items() if not kept} == junk
    again = quality.judge(df.repartition(5), quality.fit(df.repartition(3), labels)).collect()
    assert {r.doc_id: (r.kept, r.ratio) for r in again} == got
    nothing = quality.fit(df, labels.limit(0))
    assert set(nothing.weights) == {0}
    assert all(r.kept != r.base_failed for r in quality.judge(df, nothing).collect())


@pytest.mark.parametrize("name", ["op11_orchard_codes", "op12_spelling_variants", "op13_quality_ratio"])
def test_query_equals_sql_on_more_rows(spark, name):
    import __spark_entry__ as entry

    assert compare(spark, connect(SF), SF, entry.queries()[name], entry.oracle_sql()[name]) == ""
