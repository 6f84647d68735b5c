import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch
from glotspark.operators import bayes, coded, hashed
from glotspark.operators.coded import counted_in_tasks, grams_by_block, in_blocks
from glotspark.operators.features import apply_pipeline, language_pipeline
from glotspark.operators.gram_model import predict_by_join, score_by_join
from glotspark.operators.profiles import build_profile, fit_guesser

POOL = "abcé ß日\U0001f600\0x"


def texts_of(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(POOL, k=rng.randint(0, 30))) for _ in range(count)] + [None, "", "a"]


def brute(rows, sizes):
    found = {}
    for key, text in rows:
        text = (text or "").lower()
        for n in sizes:
            for i in range(len(text) - n + 1):
                name = key, n, text[i : i + n]
                found[name] = found.get(name, 0) + 1
    return found


def test_pieces_count_what_brute_force_counts(spark, monkeypatch):
    rows = [(i % 3 or None, text) for i, text in enumerate(texts_of(300))]
    df = spark.createDataFrame(rows, "k int, t string")
    for direct in (coded.DIRECT, 1):
        monkeypatch.setattr(coded, "DIRECT", direct)
        seen = counted_in_tasks(df, "t", (1, 3, 4), ["k"]).groupBy("k", "n", "gram")
        got = {(r.k, r.n, r.gram): r.f for r in seen.agg(F.sum("freq").alias("f")).collect()}
        assert got == brute(rows, (1, 3, 4))
    # One row per distinct gram of a piece goes on, not one per place of a text.
    long = spark.createDataFrame([("ab" * 5000,)], "t string")
    assert counted_in_tasks(long, "t", (1, 2, 3), []).count() == 6


def test_a_task_works_on_bounded_pieces():
    texts = pa.array(["x" * 100] * 50 + ["y" * 5000, None, ""])
    sizes = []

    def score(points, starts):
        sizes.append(len(points))
        return np.ones((len(starts), 2), dtype=np.int64)

    before, coded.PIECE_BYTES = coded.PIECE_BYTES, 1000
    try:
        (got,) = coded.scores_of(iter([texts]), score, 2, pa.int64())
    finally:
        coded.PIECE_BYTES = before
    assert len(got) == 53 and max(sizes) <= 5001 + 3 and sorted(sizes)[-2] <= 1011


def test_predictions_need_no_features_of_the_texts(spark, monkeypatch):
    rows = [("a" if i % 2 else "b", ("ab" if i % 2 else "ba") * 3 + (t or "")) for i, t in enumerate(texts_of(80))]
    df = spark.createDataFrame(rows, "label string, filteredText string")
    from glotspark.operators.features import fit_label_index

    indexer = fit_label_index(df)
    model = language_pipeline(list(indexer.labels), 3, 64).fit(indexer.transform(df))
    asked = spark.createDataFrame([(t,) for t in texts_of(200, 2) if t is not None], "filteredText string")
    want = sorted(map(tuple, model.transform(asked).select("filteredText", "prediction").collect()))
    monkeypatch.setattr(hashed, "SLICE_BYTES", 1000)
    for limit in (1 << 28, 0):
        monkeypatch.setattr(hashed.hashed_scores, "__defaults__", (None, limit))
        scored = apply_pipeline(model, asked).select("filteredText", "prediction")
        assert sorted(map(tuple, scored.collect())) == want
    # Grams that the table does not hold send a text through the stages.
    from glotspark.operators import features

    known = hashed.distinct_grams(asked.limit(20), "filteredText", [3]).collect()
    some = spark.createDataFrame(known, "n int, gram string")
    monkeypatch.setattr(features, "distinct_grams", lambda *_: some)
    scored = apply_pipeline(model, asked).select("filteredText", "prediction")
    assert sorted(map(tuple, scored.collect())) == want
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_join_plans_do_not_move_texts_or_places(spark):
    docs = spark.createDataFrame([("en", "the day"), ("de", "der tag")], "lang string, text string")
    model = fit_guesser(build_profile(docs))
    df = spark.createDataFrame([(1, "the " * 500), (2, None), (3, "")], "id int, t string")
    found = counted_in_tasks(df, "t", (1, 2, 3), ["id"], every=True)
    assert found.count() == 4 + 4 + 4 + 3
    for limit in (1 << 28, 0):
        got = predict_by_join(df, "id", "t", "out", model, limit=limit).collect()
        assert {r.id: r.out for r in got} == {1: "en", 2: "unknown", 3: "unknown"}


def test_join_plans_shuffle_a_row_per_block_and_gram(spark, monkeypatch):
    """Not one per text and gram; several blocks, null and repeated keys give the scores of one block."""
    docs = spark.createDataFrame([("en", "the day"), ("de", "der tag")], "lang string, text string")
    model = fit_guesser(build_profile(docs))
    rows = [(i % 150, f"the day {'tag' * (i % 7)}") for i in range(200)] + [(None, "der tag"), (None, None)]
    df = spark.createDataFrame(rows, "id int, t string").coalesce(2)
    whole = score_by_join(df, "id", "t", model, limit=0).collect()
    with Scratch(spark) as scratch:
        texts = scratch.table(in_blocks(df.withColumnRenamed("t", "text")), "texts")
        found = grams_by_block(texts, (1, 2, 3)).collect()
        blocks = texts.select("block").distinct().count()
    kinds = {row.gram for row in found}
    assert blocks <= 2 and len(found) <= 2 * len(kinds)
    assert sum(row.texts for row in found if row.gram == "the") == 200
    monkeypatch.setattr(coded, "BLOCK_BYTES", 100)
    with Scratch(spark) as scratch:
        texts = scratch.table(in_blocks(df.withColumnRenamed("t", "text")), "texts")
        assert texts.select("block").distinct().count() > 10
    for limit, heavy in ((0, 3), (0, 1 << 30), (1 << 28, 1)):
        assert sorted(score_by_join(df, "id", "t", model, limit, heavy).collect(), key=str) == sorted(
            whole, key=str
        )


def test_pieces_shrink_with_the_numbers_of_a_place():
    """What a piece holds stays of one size for models of a whole grid."""
    texts = pa.array(["x" * 1000] * 200)
    for width in (1, 31, 310):
        sizes = []

        def score(points, starts):
            sizes.append(len(points) * width)
            return np.zeros((len(starts), width))

        (found,) = coded.scores_of(iter([texts]), score, width, pa.float64())
        assert len(found) == 200 and max(sizes) <= 1.01 * coded.PIECE_BYTES


def test_bayes_counts_in_tasks(spark, monkeypatch):
    """Grams of a text leave a task counted, not one row per place; texts without a gram are documents."""
    seen = []

    def watched(*args, **options):
        seen.append(counted_in_tasks(*args, **options))
        return seen[-1]

    monkeypatch.setattr(bayes, "counted_in_tasks", watched)
    rows = [("en", "AbAb" * 500), ("en", None), ("de", "ab"), ("de", ""), (None, "abc"), ("de", "a\nbab")]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    fitted = bayes.fit_gram_bayes(df, "lang", "text")
    assert seen[0].count() == 5 + 2 + 2  # a row per text, two grams of one, two of another
    assert {(r.label, r.gram): r["count"] for r in fitted.counts.collect()} == {
        ("en", "aba"): 999, ("en", "bab"): 999, ("de", "aba"): 1, ("de", "bab"): 1,
    }
    classes = {r.label: (r.docs, r.grams) for r in fitted.classes.collect()}
    assert classes == {"de": (3, 2), "en": (2, 1998)}
