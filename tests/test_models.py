import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, NGram
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch
from glotspark.operators.bayes import fit_gram_bayes
from glotspark.operators.classifier import GramClassifier
from glotspark.operators.clean import prepare
from glotspark.operators.evaluate import confusion, success_rate, weighted_f1
from glotspark.operators.features import (
    decode_labels,
    feature_column,
    fit_label_index,
    hashed_features,
    label_frequencies,
    language_pipeline,
    tokenizer,
)
from glotspark.operators.grams import gram_counts_by_size
from glotspark.operators.tuning import (
    bucket_sums,
    class_sums,
    fit_from_sums,
    fold_of,
    stock_cross_validator,
    text_fold,
    tune,
)

GRID = ((3, 500), (3, 1000), (4, 500), (4, 1000))


@pytest.fixture(scope="module")
def prepared(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(8)
    return prepare(df.select("doc_id", "text", F.col("lang").alias("label"))).cache()


def test_gram_bayes_equals_ml_naive_bayes(prepared):
    own = fit_gram_bayes(prepared)
    indexer = fit_label_index(prepared)
    df = NGram(n=3, inputCol="tokenizedText", outputCol="ngrams").transform(
        tokenizer().transform(indexer.transform(prepared))
    )
    vectors = CountVectorizer(inputCol="ngrams", outputCol="features", minDF=1).fit(df)
    features = vectors.transform(df)
    model = NaiveBayes(labelCol="labelIndex").fit(features)

    classes = own.classes.collect()
    assert [row.label for row in classes] == list(indexer.labels)
    assert np.allclose([row.pi for row in classes], model.pi.toArray())
    position = {gram.replace(" ", "\0"): i for i, gram in enumerate(vectors.vocabulary)}
    assert len(position) == len(vectors.vocabulary)
    theta = model.theta.toArray()
    order = {label: i for i, label in enumerate(indexer.labels)}
    column = {gram[::2]: i for i, gram in enumerate(vectors.vocabulary)}
    rows = own.theta().collect()
    assert np.allclose(
        [row.theta for row in rows], [theta[order[row.label], column[row.gram]] for row in rows]
    )
    stage = GramClassifier(modelPath=own.model().path)
    scored = stage.transform(decode_labels(
        model.transform(features).withColumnRenamed("prediction", "predictionIndex"),
        indexer.labels,
    ).withColumnRenamed("prediction", "ml"))
    assert scored.filter("ml <> prediction").count() == 0


def test_text_without_known_grams_goes_to_the_most_frequent_class(spark, prepared):
    stage = GramClassifier(modelPath=fit_gram_bayes(prepared).model().path)
    df = spark.createDataFrame([("",), ("ЖЖЖЖ",)], "filteredText string")
    assert {row.prediction for row in stage.transform(df).collect()} == {"en"}


def test_tuning_equals_the_stock_cross_validator(prepared):
    fold = fold_of(F.col("doc_id"))
    tuned = tune(prepared, fold, GRID)
    indexed = fit_label_index(prepared).transform(prepared).withColumn("fold", fold)
    stock = stock_cross_validator(tuned.labels, (3, 4), (500, 1000), fold_column="fold")
    fitted = stock.fit(indexed)
    average = {}
    for n, size, _, f1 in tuned.metrics:
        average[n, size] = average.get((n, size), 0) + f1 / 2
    assert np.allclose([average[point] for point in GRID], fitted.avgMetrics)

    n, size = tuned.best
    plain = language_pipeline(tuned.labels, n, size).fit(indexed)
    for a, b in zip(plain.stages[3].theta.toArray(), tuned.model.stages[3].theta.toArray()):
        assert np.allclose(a, b)
    assert np.allclose(plain.stages[3].pi.toArray(), tuned.model.stages[3].pi.toArray())
    both = plain.transform(prepared).select("doc_id", F.col("prediction").alias("plain"))
    own = tuned.model.transform(prepared).select("doc_id", "prediction")
    assert both.join(own, "doc_id").filter("plain <> prediction").count() == 0


def test_a_label_missing_from_a_training_split_keeps_its_index(spark):
    rows = [(i, "a" if i % 2 else "b", "aaaa" if i % 2 else "bbbb") for i in range(20)]
    rows += [(100, "c", "cccc"), (102, "c", "cccc")]  # both in fold 0
    df = spark.createDataFrame(rows, "doc_id int, label string, filteredText string")
    fold = F.when(F.col("label") == "c", 0).otherwise(F.pmod(F.expr("doc_id div 2"), F.lit(2)))
    rows = df.withColumn("fold", fold.cast("int"))
    with Scratch(spark) as scratch:
        sums = class_sums(fit_label_index(rows).transform(rows), [(3, 64)], scratch)
    model = fit_from_sums(spark, sums, 3, (3, 64), left_out=0)
    assert model.numClasses == 3
    assert model.pi.toArray()[2] < model.pi.toArray()[0]
    tuned = tune(df, fold.cast("int"), [(3, 64)])
    assert tuned.labels == ["a", "b", "c"]
    scores = {k: f1 for _, _, k, f1 in tuned.metrics}
    assert scores[1] == 1.0
    assert 0 < scores[0] < 1
    assert tuned.model.transform(df).filter("label <> prediction").count() == 0


def test_copies_of_a_text_share_a_fold(spark):
    df = spark.createDataFrame([("same",)] * 50 + [("other",)], "filteredText string")
    folds = df.select("filteredText", text_fold(F.col("filteredText")).alias("fold")).distinct()
    assert folds.count() == 2


def test_label_index_order_and_unseen_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "label string")
    got = {row.label: (row["count"], row.labelIndex) for row in label_frequencies(df).collect()}
    assert got == {"c": (2, 0.0), "a": (1, 1.0), "b": (1, 2.0)}
    other = spark.createDataFrame([("zz",), (None,)], "label string")
    indexed = fit_label_index(df).transform(other).collect()
    assert [row.labelIndex for row in indexed] == [3.0, 3.0]


def test_weighted_f1_equals_the_evaluator(spark):
    pairs = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(2.0, 0.0)] + [(1.0, 3.0)]
    df = spark.createDataFrame(pairs, "labelIndex double, predictionIndex double")
    evaluator = MulticlassClassificationEvaluator(
        labelCol="labelIndex", predictionCol="predictionIndex"
    )
    own = weighted_f1(confusion(df, "labelIndex", "predictionIndex")).first()[0]
    assert own == pytest.approx(evaluator.evaluate(df))


def test_success_rate(spark):
    schema = "label string, prediction string"
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("c", "c")], schema)
    assert tuple(success_rate(df).first()) == (2, 4, 50.0)
    assert tuple(success_rate(df.limit(0)).first()) == (0, 0, None)


def test_bucket_sums_equal_the_hashing_stage(spark, prepared):
    counts = gram_counts_by_size(prepared, "filteredText", (4,), ["label"])
    own = {
        (row.label, row.bucket): row.tf for row in bucket_sums(counts, (4, 900), ["label"]).collect()
    }
    assert all(isinstance(tf, int) for tf in own.values())
    stock = {}
    for row in hashed_features(prepared, [(4, 900)]).collect():
        vector = row[feature_column(4, 900)]
        for bucket, tf in zip(vector.indices.tolist(), vector.values.tolist()):
            stock[row.label, bucket] = stock.get((row.label, bucket), 0) + int(tf)
    assert own == stock


def test_texts_too_short_for_a_gram_still_count(spark):
    rows = [(0, "a", "xx"), (0, "b", "bbbb"), (1, "a", "aaaa"), (1, "b", "bbbb"), (1, "b", "b")]
    df = spark.createDataFrame(rows, "fold int, label string, filteredText string")
    indexed = fit_label_index(df).transform(df)
    with Scratch(spark) as scratch:
        sums = class_sums(indexed, [(3, 64)], scratch)
    model = fit_from_sums(spark, sums, 2, (3, 64))
    stock = language_pipeline(["b", "a"], 3, 64).fit(indexed).stages[3]
    assert np.allclose(model.pi.toArray(), stock.pi.toArray())
    assert np.allclose(model.theta.toArray(), stock.theta.toArray())
