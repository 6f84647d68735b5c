from collections import Counter

import pytest
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch, new_path
from glotspark.operators.features import apply_pipeline
from glotspark.operators.folds import stratified_folds
from glotspark.operators.tuning import fold_of
from glotspark.plans.jobs import learn, learn_from
from glotspark.sources.registry import AlteredModelError, ModelRegistry, model_digest

POINT = (3, 20_000)


def test_folds_of_a_label_differ_by_one_row(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else f"l{i % 15}", f"t{i % 7}") for i in range(3000)]
    rows += [(i, "hot", "t0") for i in range(3000, 6000)]  # one text in half of all rows
    df = spark.createDataFrame(rows, "id long, label string, filteredText string").repartition(7)
    with Scratch(spark) as scratch:
        for folds, ranges in ((2, None), (5, 16)):
            placed = stratified_folds(df, folds, scratch, ranges=ranges)
            assert placed.columns == [*df.columns, "fold"]
            got = placed.collect()
            assert sorted((r.id, r.label, r.filteredText) for r in got) == sorted(rows, key=lambda r: r[0])
            for label in {row[1] for row in rows}:
                sizes = Counter(r.fold for r in got if r.label == label)
                counts = [sizes[fold] for fold in range(folds)]
                assert max(counts) - min(counts) <= 1
        # The one text is spread over ranges: no window holds it as a whole.
        spread = placed.sparkSession.read.parquet(scratch.paths[-2]).groupBy("range_").count()
        assert spread.agg(F.max("count")).first()[0] < 2000
        empty = stratified_folds(df.limit(0), 2, scratch)
        assert empty.count() == 0


def test_rank_within_a_label_follows_the_order(spark):
    df = spark.range(1000).select("id", F.concat(F.lit("l"), F.col("id") % 3).alias("label"))
    with Scratch(spark) as scratch:
        placed = stratified_folds(df.repartition(5), 4, scratch, order=["id"], ranges=9).collect()
    assert {(r.id, r.fold) for r in placed} == {(i, i // 3 % 4) for i in range(1000)}


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs.select("doc_id", "text", F.col("lang").alias("label"))


def same(df):
    return df


def test_learning_in_parts_equals_one_fit(spark, corpus):
    fold = fold_of(F.length("filteredText"))
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    parts = [corpus.filter(f"doc_id % 5 in {part}") for part in ("(0, 1)", "(2)", "(3, 4)")]
    digests = [learn_from(part, same, registry, "m", POINT, fold) for part in parts]
    whole = learn(corpus, same, grid=[POINT], fold=fold).model
    assert digests[-1] == model_digest(whole) and len(set(digests)) == 3
    once = learn_from(corpus, same, registry, "one", POINT, fold)
    assert once == digests[-1]
    got, want = (
        apply_pipeline(model, corpus.withColumnRenamed("text", "filteredText")).select("prediction")
        for model in (registry.load("m"), whole)
    )
    assert got.collect() == want.collect()
    # All points are kept: another one can be fitted without the texts.
    kept = registry.load_sums("m").counts.select("n", "features").distinct()
    assert kept.count() == 6


def test_altered_models_are_not_loaded(spark, corpus):
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    tuned = learn(corpus, same, grid=[POINT], fold=fold_of(F.col("doc_id")))
    registry.save("a", tuned.model)
    other = learn(corpus.filter("doc_id % 2 = 0"), same, grid=[POINT], fold=fold_of(F.col("doc_id")))
    registry.save("b", other.model)
    registry.load("a")
    other.model.write().overwrite().save(registry.blob_path(registry.latest("a")))
    with pytest.raises(AlteredModelError):
        registry.load("a")
    registry.load("b")
    # One part of the lookup is read for a name.
    entries = registry.entries_of("b")
    files = {path.rsplit("/", 2)[1] for path in entries.inputFiles()}
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert entries.count() == 1 and "PartitionFilters: [isnotnull(part" in plan and len(files) <= 2
