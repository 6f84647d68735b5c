import math
import resource
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from glotspark.llm import arrow, topk, toxicity
from glotspark.llm.arrow import utf8
from glotspark.llm.queries import op9_toxicity
from pyspark.sql import functions as F

DDL = "vec_id long, embedding array<float>, rank int, score string"


def brute(rows, k, divisor):
    usable = {}
    for vec_id, vector, *_ in rows:
        if vec_id is None or vector is None:
            continue
        if all(x is not None and math.isfinite(x) for x in vector):
            whole = [math.floor(1024 * float(np.float32(x))) for x in vector]
            usable.setdefault(vec_id, []).append(whole)
    flat = [(i, v) for i, each in usable.items() for v in each]
    out = []
    for query in (i for i in usable if i % divisor == 0):
        for asked in usable[query][:1]:
            scored = sorted(
                (-sum(a * b for a, b in zip(asked, v)), i) for i, v in flat if i != query
            )
            out += [(query, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=10, divisor=100):
    df = spark.createDataFrame(rows, DDL)
    got = topk.search(df, F.col("vec_id") % divisor == 0, k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "PASS", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    draw = np.random.default_rng(2)
    vectors = draw.standard_normal((700, 40)) * draw.exponential(1, (700, 1))
    vectors[100:300] = vectors[100]  # a hot vector: ties
    rows = [(i, [float(x) for x in v], 1, "s") for i, v in enumerate(vectors)]
    assert run(spark, rows) == brute(rows, 10, 100)
    assert run(spark, rows, 3, 50) == brute(rows, 3, 50)
    # Several sets of queries, each of several blocks.
    monkeypatch.setattr(topk, "ASKED", 8)
    assert run(spark, rows, 3, 20) == brute(rows, 3, 20)


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -0.5], 0, ""), (1, [0.25, 0.25], 0, ""), (2, None, 0, ""), (3, [nan, 1.0], 0, ""),
        (4, [1.0, None], 0, ""), (5, [inf, 1.0], 0, ""), (None, [9.0, 9.0], 0, ""),
        (6, [0.25], 0, ""), (7, [], 0, ""), (8, [0.25, 0.25], 0, ""), (-100, [-0.0001, 3.0], 0, ""),
    ]
    assert run(spark, rows) == brute(rows, 10, 100)
    assert run(spark, rows[:1]) == [] and run(spark, []) == []


def labelled(spark, count=600):
    draw = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(count):
        words = [f"word{draw.integers(400)}" for _ in range(int(draw.integers(3, 80)))]
        toxic = int(draw.random() < 0.25)
        if toxic:
            for _ in range(3):
                words.insert(int(draw.integers(len(words))), "vile" + str(draw.integers(30)))
        rows.append((i, " ".join(words), "en" if i % 2 else "de", "s"))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_classifier_learns_and_generalizes(spark):
    docs, labels, truth = labelled(spark)
    network = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, network, lang="lang").collect()
    assert len(scored) == len(truth)
    hits = sum((r.score >= 0.7) == bool(truth[r.doc_id]) for r in scored)
    assert hits / len(scored) > 0.93
    again = toxicity.score(docs.repartition(3), toxicity.fit(docs.repartition(5), labels))
    assert {r.doc_id: r.score for r in scored} == {r.doc_id: r.score for r in again.collect()}
    kept = toxicity.without_toxic(docs, network)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score < 0.7 for r in scored)


def test_frequent_words_are_learnt(spark):
    """Markers in a third of all rows where half are toxic, and a toxic text copied into a third."""
    docs, labels, _ = labelled(spark)
    draw = np.random.default_rng(6)
    rows, truth = [], {}
    for i in range(600):
        words = [f"word{draw.integers(400)}" for _ in range(int(draw.integers(3, 80)))]
        truth[i] = int(draw.random() < 0.5)
        if truth[i]:
            words += [f"vile{n}" for n in draw.choice(5, 3, replace=False)]
        rows.append((i, " ".join(words), "en", "s"))
    half = spark.createDataFrame(rows, docs.schema)
    network = toxicity.fit(half, spark.createDataFrame(list(truth.items()), labels.schema))
    scored = toxicity.score(half, network).collect()
    assert sum((r.score >= 0.7) == bool(truth[r.doc_id]) for r in scored) / len(scored) > 0.93

    text = "nothing of these terms stands anywhere else"
    copies = [(1000 + i, text, "en", "s") for i in range(300)]
    known = labels.union(spark.createDataFrame([(r[0], 1) for r in copies], labels.schema))
    network = toxicity.fit(docs.union(spark.createDataFrame(copies, docs.schema)), known)
    asked = spark.createDataFrame([(1, text, "en", "s"), (2, "", "en", "s")], docs.schema)
    scores = {r.doc_id: r.score for r in toxicity.score(asked, network).collect()}
    assert scores[1] > 0.9 and scores[1] > scores[2]


def test_scores_depend_on_the_text_alone(spark):
    docs, labels, _ = labelled(spark)
    network = toxicity.fit(docs, labels)
    odd = [(None, None, None, ""), (1, "", "xx", ""), (2, "vile1", "de", ""), (2, "vile1", "en", "")]
    odd += [(3, "word1 " * 50_000 + "vile2 vile3 vile4", None, "")]
    df = spark.createDataFrame(odd, docs.schema)
    scores = [r.score for r in toxicity.score(df, network, lang="lang").collect()]
    assert scores[0] == scores[1] and scores[2] == scores[3] and all(0 <= s <= 1 for s in scores)
    assert scores[4] > 0.7
    assert toxicity.score(df.limit(0), network).count() == 0


def test_no_labels_at_all(spark):
    docs, labels, _ = labelled(spark, 5)
    network = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs, network).filter("score < 0.7").count() == 5


def test_all_labelled_rows_are_learnt_from(spark):
    """Toxic rows whose markers stand in five texts each: a third of the rows, drawn or not, misses most."""
    rows, labels, draw = [], [], np.random.default_rng(9)
    for i in range(9000):
        words = [f"word{draw.integers(300)}" for _ in range(6)]
        if i % 2:
            words.append(f"{i // 2 % 900}vile")
        rows.append((3 * i, " ".join(words), "en"))
        labels.append((3 * i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    network = toxicity.fit(docs, marks)
    asked = spark.createDataFrame([(i, f"{i}vile", "en") for i in range(900)], docs.schema)
    hashes = toxicity.hashed_words(*utf8(asked.toArrow()["text"]))[0][:, 0]
    known = np.count_nonzero(network.vocabulary.rows(hashes))
    kept = {r.doc_id for r in marks.filter(~toxicity.held_out(F.col("doc_id"))).collect()}
    often = np.bincount([(i // 2) % 900 for i in range(1, 9000, 2) if 3 * i in kept], minlength=900)
    assert known >= 0.99 * np.count_nonzero(often >= toxicity.MIN_TEXTS)


def test_parts_learn_together(spark):
    docs, labels, truth = labelled(spark, 1500)
    langs = toxicity.fit(docs, labels).thresholds
    network = toxicity.fit(docs, labels, part=200)
    scored = {r.doc_id: r.score for r in toxicity.score(docs, network).collect()}
    hits = sum((scored[key] >= 0.7) == bool(toxic) for key, toxic in truth.items())
    assert hits / len(truth) > 0.93 and network.thresholds.keys() == langs.keys() == {"en", "de"}
    # Whatever the partitions were; odd rows don't matter.
    odd = [(None, "vile1", "en", ""), (1, None, "en", "")]
    other = docs.repartition(5).union(spark.createDataFrame(odd, docs.schema))
    again = toxicity.score(docs, toxicity.fit(other, labels.repartition(3), part=200))
    assert scored == {r.doc_id: r.score for r in again.collect()}
    empty = docs.withColumn("text", F.lit(""))
    assert toxicity.score(docs, toxicity.fit(empty, labels, part=200)).filter("score >= 0.7").count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op9_toxicity(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    found = sum(r.predicted for r in rows if r.toxic)
    wrong = sum(r.predicted for r in rows if not r.toxic)
    toxic = sum(r.toxic for r in rows)
    assert found / toxic >= 0.9 and wrong / max(1, found + wrong) < 0.1


def test_moves_hold_only_the_rows_that_moved():
    random = np.random.default_rng(5)
    start = random.standard_normal((200_010, toxicity.WIDE + 1)).astype(np.float32)
    end = start.copy()
    end[random.integers(0, 200_000, 500)] += 0.25
    # This one moves by less than a unit.
    start[7], end[7] = 0, toxicity.MOVE_UNIT / 8
    every = np.rint((end.astype(np.float64) - start) / toxicity.MOVE_UNIT).astype(np.int64)
    own = np.flatnonzero(every.any(axis=1) | (np.arange(len(every)) >= 200_000))
    tracemalloc.start()
    at, moves = toxicity.moved_rows(end, start, 200_000)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert 7 not in at and np.array_equal(at, own) and np.array_equal(moves, every[own])
    assert most < start.nbytes


def test_pieces_give_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(arrow, "release_memory", lambda: given.append(True))
    batches = [pa.record_batch({"text": ["ab", None, "c"]}), pa.record_batch({"text": ["d"]})]
    read = [values.tobytes() for _, values, _ in arrow.text_pieces(iter(batches))]
    assert read == [b"abc", b"d"] and given == [True]


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_memory_that_is_not_used_goes_back():
    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * resource.getpagesize()

    before = resident()
    # Small blocks, all but every hundredth freed: the heap stays as large as they were.
    held = [np.ones(8_000) for _ in range(2_000)]
    full = resident()
    held = held[::100]
    arrow.release_memory()
    assert full - before > 100_000_000 and resident() - before < (full - before) / 3
