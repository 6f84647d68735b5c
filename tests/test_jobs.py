import os
import re
from datetime import datetime, timezone

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch, shared_dir
from glotspark.operators import features
from glotspark.operators.bayes import fit_gram_bayes
from glotspark.operators.classifier import GramClassifier
from glotspark.operators.clean import prepare
from glotspark.operators.features import apply_pipeline
from glotspark.operators.incremental import fresh_keys, one_per_key, unpredicted
from glotspark.operators.profiles import build_profile, fit_guesser, labeler
from glotspark.plans.jobs import (
    count_short,
    learn,
    learn_and_predict,
    predict_job,
    predict_new,
    score_texts,
)
from glotspark.sources.jdbc import JdbcDatabase, Split, rows_without_match
from glotspark.sources.predictions import (
    PREDICTED_SCHEMA,
    append_predictions,
    create_prediction_table,
    read_predictions,
)
from glotspark.sources.registry import ModelRegistry, latest_versions, model_digest
from glotspark.sources.texts import given_texts, inline_texts, query_texts
from glotspark.streaming import predict_stream, stream_texts

GRID = ((3, 1000),)


@pytest.fixture(scope="module")
def tweets(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(8)
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.expr("timestampadd(MINUTE, doc_id, timestamp'2024-01-01 00:00:00')").alias("created_at"),
        "text",
        "lang",
    ).cache()


@pytest.fixture(scope="module")
def step(tweets):
    return labeler(fit_guesser(build_profile(tweets)))


@pytest.fixture(scope="module")
def tuned(tweets, step):
    return learn(tweets, step, GRID)


def ids(df):
    return sorted(row.id for row in df.select("id").collect())


def test_anti_join_plans_agree(spark):
    rows = spark.createDataFrame(
        [(str(i), f"t{i}") for i in range(50)] + [(None, "null")], "id string, text string"
    )
    done = spark.createDataFrame([(str(i),) for i in range(0, 50, 2)], "id string")
    expected = sorted(rows.join(done, "id", "left_anti").collect(), key=str)
    for limit in (10**9, 66 * 26, 0):
        assert sorted(unpredicted(rows, done, limit=limit).collect(), key=str) == expected
    steady = unpredicted(rows, done)
    assert "BroadcastHashJoin" in steady._jdf.queryExecution().executedPlan().toString()
    everything = spark.createDataFrame([(str(i),) for i in range(50)], "id string")
    assert unpredicted(rows.filter("id is not null"), everything).count() == 0


def test_long_keys_count_by_their_bytes(spark):
    rows = spark.createDataFrame([("u" * 5000 + str(i), "t") for i in range(40)], "id string, text string")
    with Scratch(spark) as scratch:
        fresh = fresh_keys(rows, rows.limit(0), scratch)
        assert fresh.rows == 40 and fresh.nbytes > 40 * 5000 and fresh.repeated == 0


def test_the_source_is_read_once_for_keys_and_once_for_rows(spark, tweets, tuned, step, tmp_path):
    tweets.select("id", "created_at", "text").write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    with Scratch(spark) as scratch:
        scored = predict_new(source, source.select("id").limit(5), tuned.model, step, scratch=scratch)
        plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[id#\d+,created_at", plan)) == 1, plan


def test_one_per_key(spark):
    rows = [("hot", f"t{i % 7}") for i in range(300)] + [("a", "x"), ("b", "y")]
    df = spark.createDataFrame(rows, "id string, text string").repartition(5)
    with Scratch(spark) as scratch:
        fresh = fresh_keys(df, df.limit(0), scratch)
        for limit in (10**9, 0):
            kept = sorted(tuple(row) for row in one_per_key(df, fresh, limit=limit).collect())
            assert kept == [("a", "x"), ("b", "y"), ("hot", "t0")]
        unique = df.filter("id <> 'hot'")
        assert one_per_key(unique, fresh_keys(unique, df.limit(0), scratch)) is unique


MOMENT = datetime(2024, 1, 1)
LATER = datetime(2024, 1, 2)
LONG = "the quick brown fox and the lazy dog were here"


def test_an_id_whose_first_row_is_too_short_is_not_lost(spark, tuned, step, tmp_path):
    schema = "id string, created_at timestamp, text string"
    rows = [("1", MOMENT, "short"), ("1", LATER, LONG), ("2", MOMENT, LONG), ("2", LATER, LONG)]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "predicted")
    predict_job(df, path, tuned.model, step)
    done = read_predictions(spark, path)
    assert sorted((row.id, row.created_at) for row in done.collect()) == [("1", LATER), ("2", MOMENT)]
    predict_job(df, path, tuned.model, step)
    assert read_predictions(spark, path).count() == 2

    df.write.parquet(str(tmp_path / "in" / "a"))
    streamed = str(tmp_path / "streamed")

    def score(batch):
        return tuned.model.transform(prepare(batch, labeler=step))

    stream = stream_texts(spark, str(tmp_path / "in" / "*"), df.schema)
    predict_stream(stream, streamed, str(tmp_path / "checkpoint"), score).awaitTermination()
    assert ids(read_predictions(spark, streamed)) == ["1", "2"]


def test_rows_with_nulls_are_rejected_and_counted(spark, tuned, step, tmp_path):
    schema = "id string, created_at timestamp, text string"
    rows = [(None, MOMENT, LONG), ("1", None, LONG), ("2", MOMENT, None), ("3", MOMENT, LONG)]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "predicted")
    for _ in range(3):
        assert predict_job(df, path, tuned.model, step) == 3
        assert ids(read_predictions(spark, path)) == ["3"]
    whole = [(*row, "en", None) for row in rows]
    loose = "id string, created_at timestamp, text string, prediction string, label string"
    assert append_predictions(spark.createDataFrame(whole, loose), path) == 3
    assert ids(read_predictions(spark, path)) == ["3"]


def test_a_job_can_write_elsewhere(spark, tweets, tuned, tmp_path):
    kept = []
    rejected = predict_job(
        tweets, None, tuned.model, None,
        read=lambda: spark.createDataFrame([], PREDICTED_SCHEMA),
        write=lambda df: kept.append(df.count()),
    )
    assert rejected == 0 and kept == [tweets.count() - count_short(tweets)]


def test_nothing_is_left_behind(spark, tweets, step, tuned, tmp_path):
    folder = shared_dir(spark)
    before = set(os.listdir(folder))
    learn(tweets, step, GRID)
    predict_job(tweets, str(tmp_path / "predicted"), tuned.model, step)
    tweets.select("id", "created_at", "text").write.parquet(str(tmp_path / "in" / "a"))
    stream = stream_texts(spark, str(tmp_path / "in" / "*"), tweets.drop("lang").schema)
    predict_stream(
        stream, str(tmp_path / "streamed"), str(tmp_path / "checkpoint"),
        lambda rows: tuned.model.transform(prepare(rows, labeler=step)),
    ).awaitTermination()
    assert set(os.listdir(folder)) == before


@pytest.mark.parametrize("limit", [1 << 28, 1 << 16, 0])
def test_jobs_do_not_depend_on_the_size_of_the_weight_table(
    spark, tweets, tuned, tmp_path, monkeypatch, limit
):
    monkeypatch.setattr("glotspark.operators.gram_model.SLICE_BYTES", 1 << 16)
    step = labeler(fit_guesser(build_profile(tweets)), limit=limit)
    odd = tweets.select("id", "text").limit(20).withColumn("id", F.lit("same"))
    odd = odd.union(tweets.select(F.lit(None).cast("string"), "text").limit(5))
    labeled = odd.withColumnRenamed("text", "filteredText").transform(step)
    assert labeled.count() == 25 and labeled.filter("label = 'unknown'").count() == 0
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    path = str(tmp_path / "predicted")
    learn_and_predict(tweets, path, registry, "language", step, grid=GRID)
    done = read_predictions(spark, path)
    assert done.count() == tweets.count() - count_short(tweets)
    joined = done.join(tweets.select("id", "lang"), "id")
    assert joined.filter("label <> lang").count() <= 2


def test_append_keeps_the_key_unique(spark, tmp_path):
    path = str(tmp_path / "predicted")
    moment = datetime(2024, 1, 1)
    first = [("1", moment, "a", "en", None), ("2", moment, "b", "en", "en")]
    again = [("2", moment, "other", "de", "de"), ("3", moment, "c", "de", "de")]
    again.append(("3", moment, "d", "de", "de"))
    append_predictions(spark.createDataFrame(first, PREDICTED_SCHEMA), path)
    append_predictions(spark.createDataFrame(again, PREDICTED_SCHEMA), path)
    got = {row.id: row.text for row in read_predictions(spark, path).collect()}
    assert got == {"1": "a", "2": "b", "3": "c"}
    create_prediction_table(spark, "predicted_once", path)
    try:
        counts = spark.sql("SELECT count(*) FROM predicted_once").first()[0]
    finally:
        spark.sql("DROP TABLE predicted_once")
    assert counts == 3


def test_learned_model_predicts_the_languages(tweets, tuned):
    scored = tuned.model.transform(tweets.withColumnRenamed("text", "filteredText"))
    agree = scored.filter(F.col("prediction") == F.col("lang")).count()
    assert agree >= 0.95 * tweets.count()
    assert [(n, size, fold) for n, size, fold, _ in tuned.metrics] == [(3, 1000, 0), (3, 1000, 1)]


def test_applied_pipeline_equals_the_model(spark, tweets, tuned):
    renamed = tweets.withColumnRenamed("text", "filteredText")
    columns = ["id", "ngrams", "features", "probability", "prediction"]
    applied = apply_pipeline(tuned.model, renamed)
    assert "tokenizedText" not in applied.columns
    stock = {row.id: row for row in tuned.model.transform(renamed).select(*columns).collect()}
    assert all(stock[row.id] == row for row in applied.select(*columns).collect())
    other = tuned.model.copy()
    other.stages[0].setToLowercase(False)
    assert "tokenizedText" in apply_pipeline(other, renamed).columns


def test_predict_new_and_second_run(spark, tweets, step, tuned, tmp_path):
    path = str(tmp_path / "predicted")
    predict_job(tweets.filter("id < '15'"), path, tuned.model, step)
    some = read_predictions(spark, path)
    assert some.columns == ["id", "created_at", "text", "prediction", "label"]
    fresh = predict_new(tweets, some, tuned.model, step)
    assert not set(ids(fresh)) & set(ids(some))
    predict_job(tweets, path, tuned.model, step)
    done = read_predictions(spark, path)
    assert done.count() + count_short(tweets) == tweets.count()
    originals = {row.id: row.text for row in tweets.collect()}
    assert all(originals[row.id] == row.text for row in done.collect())
    predict_job(tweets, path, tuned.model, step)
    assert read_predictions(spark, path).count() == done.count()
    unlabeled = predict_new(tweets, done.limit(0), tuned.model, None)
    assert unlabeled.filter("label is not null").count() == 0


def test_new_rows_are_labelled_once_and_scored_by_sums(spark, tuned, tmp_path, monkeypatch):
    """Texts get no feature vectors, and no text is labelled by more than one pass."""
    begin, words = datetime(2024, 1, 1), ["the words of it", "der die das und", "le la les est", "ab"]
    rows = [(str(i), begin, f"{words[i % 4]} @me {i % 9} " * (i % 5)) for i in range(200)]
    rows += [("7", begin, "once more the same key"), (None, begin, words[0]), ("x", begin, None)]
    rows = spark.createDataFrame(rows, "id string, created_at timestamp, text string")
    calls, seen, sums = spark.sparkContext.accumulator(0), [], features.hashed_scores

    @F.udf("string")
    def first(text):
        calls.add(1)
        return text[:2]

    def step(df):
        return df.withColumn("label", first("filteredText"))

    def spied(*given):
        seen.append(given)
        return sums(*given)

    monkeypatch.setattr(features, "hashed_scores", spied)
    path = str(tmp_path / "predicted")
    predict_job(rows, path, tuned.model, step)
    done = {row.id: row for row in read_predictions(spark, path).collect()}
    assert len(seen) == 1 and calls.value == len(done)
    stock = tuned.model.transform(prepare(rows)).filter("id is not null").collect()
    assert set(done) == {row.id for row in stock}
    for row in stock:
        if row.id != "7":
            assert done[row.id].prediction == row.prediction
            assert done[row.id].label == row.filteredText[:2]
    predict_job(rows, path, tuned.model, step)
    assert read_predictions(spark, path).count() == len(done) and calls.value == len(done)


def test_given_texts_are_neither_cleaned_nor_filtered(spark, tuned):
    texts = ["the @me", "", "heute ist ein tag"]
    scored = score_texts(inline_texts(spark, texts), tuned.model).collect()
    assert [row.filteredText for row in scored] == texts
    assert not inline_texts(spark, texts).schema["filteredText"].nullable
    with_null = spark.createDataFrame([("a b c",), (None,)], "text string")
    assert score_texts(given_texts(with_null), tuned.model).count() == 1


def test_registry(spark, tweets, tuned, step, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    with pytest.raises(KeyError):
        registry.latest("language")
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    other = learn(tweets, step, ((4, 500),))
    second = registry.save("language", other.model, late)
    first = registry.save("language", tuned.model, early)
    assert first != second
    assert registry.latest("language") == second
    assert registry.save("copy", tuned.model) == first
    assert registry.lookup().count() == 3
    newest = {row.name: row.digest for row in latest_versions(registry.lookup()).collect()}
    assert newest == {"language": second, "copy": first}
    with pytest.raises(KeyError):
        registry.load("nobody")
    loaded = registry.load("copy")
    assert model_digest(loaded) == first
    assert registry.load("language").stages[1].getN() == 4
    renamed = tweets.withColumnRenamed("text", "filteredText")
    a = tuned.model.transform(renamed).select("id", "prediction")
    assert a.exceptAll(loaded.transform(renamed).select("id", "prediction")).count() == 0
    assert registry.lookup().filter("spark_version is null").count() == 0


def test_learn_and_predict(spark, tweets, step, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    path = str(tmp_path / "predicted")
    done = learn_and_predict(tweets, path, registry, "language", step, grid=GRID)
    assert registry.latest("language") == done.digest
    assert read_predictions(spark, path).count() == tweets.count() - count_short(tweets)


def test_stream(spark, tweets, step, tuned, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "predicted")
    columns = ["id", "created_at", "text"]
    tweets.filter("id < '15'").select(*columns).write.parquet(str(source / "a"))

    def run():
        stream = stream_texts(
            spark, str(source / "*"), tweets.select(*columns).schema, files_per_batch=3
        )

        def score(rows):
            return predict_new(rows, read_predictions(spark, path), tuned.model, step)

        query = predict_stream(stream, path, str(tmp_path / "checkpoint"), score)
        query.awaitTermination()
        return ids(read_predictions(spark, path))

    first = run()
    assert first and max(first) < "15"
    assert run() == first
    # The second folder repeats all earlier rows.
    tweets.select(*columns).write.parquet(str(source / "b"))
    everything = run()
    assert len(everything) == len(set(everything)) == tweets.count() - count_short(tweets)


def test_subquery_source(spark, tweets):
    assert query_texts(spark, "SELECT text FROM {tweets}", tweets=tweets).columns == ["text"]


def test_jdbc_options():
    database = JdbcDatabase("jdbc:some://host/db", {"user": "u", "driver": "d"})
    assert database.options("(SELECT text FROM tweets) AS texts") == {
        "user": "u",
        "driver": "d",
        "url": "jdbc:some://host/db",
        "dbtable": "(SELECT text FROM tweets) AS texts",
    }
    split = Split("created_at", "2024-01-01", "2024-02-01", 31)
    assert database.options("tweets", split).items() >= {
        "partitionColumn": "created_at",
        "lowerBound": "2024-01-01",
        "upperBound": "2024-02-01",
        "numPartitions": "31",
    }.items()
    assert "user" not in JdbcDatabase("jdbc:x").options("t")


def test_rows_without_match():
    sql = rows_without_match("tweets", "done", columns=["id", "text"])
    assert "NOT EXISTS" in sql and sql.startswith("SELECT source.id, source.text FROM tweets")


def test_equal_models_share_a_digest(spark, tweets, step):
    digests = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (4, 13, 29):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            model = learn(tweets.repartition(partitions), step, GRID).model
            digests.add(model_digest(model))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(digests) == 1


def test_registry_keeps_gram_models_whole(spark, tweets, tmp_path):
    prepared = prepare(tweets).withColumn("label", F.col("lang"))
    path = str(tmp_path / "made")
    stage = GramClassifier(modelPath=fit_gram_bayes(prepared).model(path).path)
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    digest = registry.save("grams", PipelineModel([stage]))
    before = stage.transform(prepared).select("id", "prediction").collect()
    other = GramClassifier(modelPath=fit_gram_bayes(prepared).model().path)
    assert registry.save("again", PipelineModel([other])) == digest
    loaded = registry.load("grams")
    assert str(tmp_path / "registry") in loaded.stages[0].getModelPath()
    assert sorted(loaded.transform(prepared).select("id", "prediction").collect()) == sorted(before)


def test_current_timestamp_is_used_without_a_given_one(spark, tuned, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    registry.save("now", tuned.model)
    saved = registry.lookup().select(F.unix_timestamp("created_at")).first()[0]
    assert abs(saved - datetime.now(timezone.utc).timestamp()) < 600
