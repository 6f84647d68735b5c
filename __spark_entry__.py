
from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions import char_ngrams, char_tokens
from glotspark.functions import patterns as P
from glotspark.functions.scripts import REPRESENTATIVES
from glotspark.functions.storage import Scratch, new_path, use_local_folder
from glotspark.operators.bayes import fit_gram_bayes
from glotspark.operators.classifier import GramClassifier
from glotspark.operators.clean import RegexReplacer, clean_text, min_length, prepare
from glotspark.operators.evaluate import class_scores, confusion, success_rate, weighted_f1
from glotspark.operators.features import (
    apply_pipeline,
    decode_labels,
    fit_label_index,
    label_frequencies,
)
from glotspark.operators.folds import stratified_folds
from glotspark.operators.gram_model import predict_by_join
from glotspark.operators.grams import gram_counts_by_size, top_grams
from glotspark.operators.incremental import only_fresh, unpredicted
from glotspark.operators.profiles import (
    build_frequent_profile,
    build_profile,
    fit_guesser,
    fold_profile,
    labeler,
)
from glotspark.operators.tuning import FEATURE_COUNTS, GRAM_SIZES, GRID, bucket_sums, fold_of
from glotspark.plans.jobs import (
    count_short,
    learn,
    learn_and_predict,
    learn_from,
    predict_into,
    predict_job,
    predict_new,
    score_texts,
)
from glotspark.sources.predictions import (
    append_predictions,
    prediction_table,
    read_predictions,
    skipped_table,
)
from glotspark.sources.profiles import read_profiles, write_profiles
from glotspark.sources.registry import ModelRegistry, latest_versions
from glotspark.sources.result_table import ResultTable
from glotspark.sources.texts import given_texts, query_texts, read_texts
from glotspark.streaming import predict_stream, predict_stream_into, stream_texts

try:
    import corpus_pipeline
    from glotspark.llm import queries as llm
except ImportError as error:
    if error.name not in ("corpus_pipeline", "glotspark.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

CREATED_AT = "timestampadd(MINUTE, doc_id, timestamp'2024-01-01 00:00:00')"

# A character that no document holds, and what it stands for in a foreign copy.
FOREIGN = "\u4dc0"
FOREIGN_LETTERS = "[^ ]"


LETTERS = "abcdefghijklmnopqrstuvwxyz"

# Where two sets of Hiragana start.
KANA = (0x3041, 0x3061)


# ---- inputs ---------------------------------------------------------------------------------


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return read_texts(spark, f"{sf}/documents.parquet", *(columns or ("doc_id", "text", "lang")))


def decorated(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents with every kind of noise the cleaner removes."""
    noisy = F.concat(
        F.lit("RT @user"), "doc_id", F.lit(": "), "text", F.lit(" https://t.co/x"), "doc_id",
        F.lit(" #tag"), "doc_id", F.lit(" a.b"), "doc_id",
        F.lit("@ex.com @you &amp; ‼ "), "lang",
    )
    return documents(spark, sf).select("doc_id", "lang", noisy.alias(C.TEXT))


def tweets(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        F.col("doc_id").cast("string").alias(C.ID), F.expr(CREATED_AT).alias(C.CREATED_AT), C.TEXT
    )


def already_predicted(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return labels.select(F.col("doc_id").cast("string").alias(C.ID))


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return prepare(documents(spark, sf))


def guesser(spark: SparkSession, sf: str, **options):
    return fit_guesser(build_profile(documents(spark, sf, "text", "lang"), **options))


def guess_step(spark: SparkSession, sf: str):
    return labeler(guesser(spark, sf))


def bayes(spark: SparkSession, sf: str):
    return fit_gram_bayes(prepared(spark, sf), label="lang")


def bayes_classifier(spark: SparkSession, sf: str) -> GramClassifier:
    return GramClassifier(modelPath=bayes(spark, sf).model().path)


def as_text(timestamp: str):
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss").alias(timestamp)


def result_rows(df: DataFrame) -> DataFrame:
    return df.select(C.ID, as_text(C.CREATED_AT), C.TEXT, C.PREDICTION, C.LABEL)


# ---- scans, sources, sinks ------------------------------------------------------------------


def src_subquery(spark, sf):
    return query_texts(spark, "SELECT text FROM {tweets}", tweets=tweets(spark, sf))


def scan_text(spark, sf):
    return read_texts(spark, f"{sf}/documents.parquet")


def incremental_unpredicted(spark, sf):
    fresh = unpredicted(tweets(spark, sf), already_predicted(spark, sf))
    return fresh.select(C.ID, as_text(C.CREATED_AT), C.TEXT)


def inline_texts(spark, sf):
    return given_texts(read_texts(spark, f"{sf}/benchmark.parquet"))


def profile_json_roundtrip(spark, sf):
    path = new_path(spark, "profile-json")
    write_profiles(build_profile(documents(spark, sf, "text", "lang")), path)
    return read_profiles(spark, path)


def gold_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Result rows with the documents' own language as the prediction."""
    return prepared(spark, sf).select(
        F.col("doc_id").cast("string").alias(C.ID),
        F.expr(CREATED_AT).alias(C.CREATED_AT),
        C.TEXT,
        F.col("lang").alias(C.PREDICTION),
        F.lit(None).cast("string").alias(C.LABEL),
    )


def sink_append_roundtrip(spark, sf):
    path = new_path(spark, "predictions")
    rows = gold_rows(spark, sf)
    append_predictions(unpredicted(rows, already_predicted(spark, sf)), path)
    append_predictions(rows, path)
    return result_rows(read_predictions(spark, path))


def sink_concurrent_append(spark, sf):
    """Two jobs that append at once; two thirds of their keys are the same."""
    path = new_path(spark, "results")
    rows = gold_rows(spark, sf)

    def job(left_out: int) -> None:
        mine = rows.filter(F.pmod(F.xxhash64(C.ID), F.lit(6)) != left_out)
        prediction_table(spark, path).append(mine)

    with ThreadPool(2) as pool:
        pool.map(inheritable_thread_target(spark)(job), range(2))
    return result_rows(prediction_table(spark, path).read())


def incremental_result_table(spark, sf):
    """Rows not predicted yet, against a table that has grown by three commits."""
    rows, known = tweets(spark, sf), already_predicted(spark, sf)
    table = ResultTable(spark, new_path(spark, "results"), known.schema, C.ID)
    for part in range(3):
        table.append(known.filter(F.pmod(F.xxhash64(C.ID), F.lit(3)) == part))
    fresh = only_fresh(rows, table.fresh_keys(rows, Scratch(spark).until_exit()))
    return fresh.select(C.ID, as_text(C.CREATED_AT), C.TEXT)


def skipped_rows_second_run(spark, sf):
    """What two runs with a ledger of short rows append, clean and find too short."""
    results = prediction_table(spark, new_path(spark, "results"))
    skipped = skipped_table(spark, new_path(spark, "skipped"))
    runs = [
        predict_into(results, tweets(spark, sf), with_gold(spark, sf), skipped=skipped)
        for _ in range(2)
    ]
    schema = "run int, appended long, cleaned long, short long"
    return spark.createDataFrame(
        [(n, run.rows, run.cleaned, run.short) for n, run in enumerate(runs, 1)], schema
    )


def with_gold(spark: SparkSession, sf: str) -> Callable[[DataFrame], DataFrame]:
    """Takes the language that the documents name as the prediction."""
    known = documents(spark, sf, "doc_id", "lang").select(
        F.col("doc_id").cast("string").alias(C.ID), F.col("lang").alias(C.PREDICTION)
    )
    return lambda df: df.join(known, C.ID).withColumn(C.LABEL, F.lit(None).cast("string"))


def registry_latest(spark, sf):
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    entries = documents(spark, sf, "doc_id", "text", "source").select(
        F.expr(CREATED_AT).alias("created_at"),
        F.col("source").alias("name"),
        F.sha1("text").alias("digest"),
        F.lit(spark.version).alias("spark_version"),
    )
    registry.add_entries(entries)
    return latest_versions(registry.lookup()).select("name", as_text("created_at"), "digest")


def registry_roundtrip_predict(spark, sf):
    """Predictions of a model that was saved to and loaded from the registry."""
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    tuned = learn(documents(spark, sf), guess_step(spark, sf), fold=length_fold())
    registry.save("language", tuned.model)
    loaded = registry.load("language")
    return apply_pipeline(loaded, prepared(spark, sf)).select("doc_id", C.PREDICTION)


def registry_gram_model(spark, sf):
    """The exact-gram classifier from the registry, which keeps its weight table with it."""
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    registry.save("grams", PipelineModel([bayes_classifier(spark, sf)]))
    return registry.load("grams").transform(prepared(spark, sf)).select("doc_id", C.PREDICTION)


def predict_with_registry_model(spark, sf):
    """New rows scored with a pipeline from the registry, appended to the result table."""
    path = new_path(spark, "predictions")
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    step = guess_step(spark, sf)
    registry.save("language", learn(documents(spark, sf), step, fold=length_fold()).model)
    rows = unpredicted(tweets(spark, sf), already_predicted(spark, sf))
    predict_job(rows, path, registry.load("language"), step)
    return result_rows(read_predictions(spark, path))


# ---- cleaning -------------------------------------------------------------------------------


def branch(name: str, table: str = "documents") -> Query:
    def run(spark, sf):
        if table == "pages":
            rows = read_texts(spark, f"{sf}/pages.parquet", "page_id", "html").select(
                F.col("page_id").alias("doc_id"), F.col("html").alias(C.TEXT)
            )
        else:
            rows = decorated(spark, sf)
        stage = RegexReplacer(inputCol=C.TEXT, outputCol=C.FILTERED, pattern=P.BRANCHES[name])
        return stage.transform(rows).select("doc_id", C.FILTERED)

    return run


def regex_replace(spark, sf):
    swap = RegexReplacer(
        inputCol=C.TEXT, outputCol=C.FILTERED, pattern=r"(\w+) (\w+)", replacement="$2 $1"
    )
    return swap.transform(documents(spark, sf)).select("doc_id", C.FILTERED)


def clean_query(spark, sf):
    return decorated(spark, sf).transform(clean_text).select("doc_id", C.FILTERED)


def min_length_query(spark, sf):
    cleaned = documents(spark, sf).transform(clean_text).transform(min_length)
    return cleaned.select("doc_id", F.length(C.FILTERED).alias("n"))


def prepare_unlabeled(spark, sf):
    return decorated(spark, sf).transform(prepare).select("doc_id", C.FILTERED)


def prepare_labeled(spark, sf):
    rows = prepare(decorated(spark, sf), labeler=guess_step(spark, sf))
    return rows.select("doc_id", C.FILTERED, C.LABEL)


def content_digest(spark, sf):
    return documents(spark, sf).select("doc_id", F.sha1("text").alias("digest"))


# ---- language profiles and guesses ----------------------------------------------------------


def build_profile_query(spark, sf):
    return build_profile(documents(spark, sf, "text", "lang"))


def frequent_profile(spark, sf):
    """The profile of grams that occur five times or more, rare ones kept from the shuffle."""
    return build_frequent_profile(documents(spark, sf, "text", "lang"), 5)


def guess_language(spark, sf):
    return prepared(spark, sf).transform(guess_step(spark, sf)).select("doc_id", C.LABEL)


def guess_language_join(spark, sf):
    """The plan for weight tables of any size, forced."""
    model = guesser(spark, sf)
    return predict_by_join(prepared(spark, sf), "doc_id", C.FILTERED, C.LABEL, model, limit=0)


def guess_language_split(spark, sf):
    """The same, with grams that stand in many texts looked up where the texts lie."""
    model = guesser(spark, sf)
    rows = prepared(spark, sf)
    return predict_by_join(rows, "doc_id", C.FILTERED, C.LABEL, model, limit=0, heavy=50)


def guess_language_broadcast(spark, sf):
    model = guesser(spark, sf)
    return predict_by_join(prepared(spark, sf), "doc_id", C.FILTERED, C.LABEL, model)


def guess_unknown(spark, sf):
    """Every document, short ones too, and a copy in a script that no profile holds."""
    step = labeler(guesser(spark, sf, sizes=(3,)), text=C.TEXT)
    foreign = F.regexp_replace(C.TEXT, FOREIGN_LETTERS, FOREIGN)
    copies = F.explode(F.array(F.col(C.TEXT), foreign)).alias(C.TEXT)
    rows = documents(spark, sf).select("doc_id", copies)
    return rows.transform(step).select("doc_id", F.length(C.TEXT).alias("n"), C.LABEL)


def in_kana(text, first: int):
    """A text with other letters for a to z: Hiragana from a code point on."""
    return F.translate(F.lower(text), LETTERS, kana(first))


def kana(first: int) -> str:
    return "".join(chr(first + place) for place in range(len(LETTERS)))


def guess_with_imported_profile(spark, sf):
    """Documents and copies of them in kana, by a profile from JSON with one character for kana.

    The texts in kana that the profile is built from use other characters than the copies, so that
    only folding makes them known.
    """
    known = read_texts(spark, f"{sf}/benchmark.parquet").select(
        in_kana(F.col(C.TEXT), KANA[0]).alias("text"), F.lit("ja").alias("lang")
    )
    path = new_path(spark, "profile-json")
    write_profiles(build_profile(documents(spark, sf, "text", "lang").union(known)), path)
    model = fit_guesser(fold_profile(read_profiles(spark, path)))
    copies = F.array(F.col(C.TEXT), in_kana(F.col(C.TEXT), KANA[1]))
    rows = documents(spark, sf).select("doc_id", F.posexplode(copies).alias("copy", C.TEXT))
    return rows.transform(labeler(model, text=C.TEXT, fold=True)).select("doc_id", "copy", C.LABEL)


def guess_accuracy(spark, sf):
    return success_rate(prepared(spark, sf).transform(guess_step(spark, sf)), "lang", C.LABEL)


def by_letters(spark, sf):
    """A weak guess from single characters against the usual one, so that errors occur."""
    letters = labeler(guesser(spark, sf, sizes=(1,)), out=C.PREDICTION)
    return prepared(spark, sf).transform(letters)


def success_rate_query(spark, sf):
    return success_rate(by_letters(spark, sf).transform(guess_step(spark, sf)))


def weighted_f1_query(spark, sf):
    scored = weighted_f1(confusion(by_letters(spark, sf), "lang", C.PREDICTION))
    return scored.select(F.round("weighted_f1", 9).alias("weighted_f1"))


def class_f1(spark, sf):
    scores = class_scores(confusion(by_letters(spark, sf), "lang", C.PREDICTION))
    return scores.select("class", "tp", "actual", "guessed", F.round("f1", 9).alias("f1"))


# ---- tokens, grams, features ----------------------------------------------------------------


def char_tokens_query(spark, sf):
    tokens = char_tokens(F.col(C.FILTERED))
    return prepared(spark, sf).select(
        "doc_id", F.size(tokens).alias("n"), F.sha1(F.array_join(tokens, "|")).alias("digest")
    )


def ngrams_query(n: int) -> Query:
    def run(spark, sf):
        grams = char_ngrams(F.col(C.FILTERED), n)
        return prepared(spark, sf).select(
            "doc_id", F.size(grams).alias("n"), F.sha1(F.array_join(grams, "|")).alias("digest")
        )

    return run


def ngram_topk(spark, sf):
    return top_grams(prepared(spark, sf), C.FILTERED, 3, 50)


def ngram_counts_by_lang(spark, sf):
    counts = gram_counts_by_size(prepared(spark, sf), C.FILTERED, (1, 2, 3, 4), ["lang"])
    return counts.groupBy("lang", "n").agg(
        F.count("*").alias("grams"), F.sum("freq").alias("freq")
    )


def hashed_tf(spark, sf):
    """Hash buckets of all points of the tuning grid."""
    with_sizes = gram_counts_by_size(prepared(spark, sf), C.FILTERED, GRAM_SIZES, ["lang"])
    counts = Scratch(spark).until_exit().table(with_sizes, "counts")
    points = [
        bucket_sums(counts, point, ["lang"]).select(
            F.lit(point[0]).alias("n"), F.lit(point[1]).alias("features"), "lang", "bucket", "tf"
        )
        for point in GRID
    ]
    return functools.reduce(DataFrame.union, points)


def tf_mass(spark, sf):
    found = hashed_tf(spark, sf).groupBy("n", "features", "lang")
    return found.agg(F.sum("tf").alias("mass"), F.count("*").alias("buckets"))


def label_index(spark, sf):
    counted = label_frequencies(documents(spark, sf, "lang"), "lang")
    return counted.select("lang", "count", F.col(C.LABEL_INDEX).cast("int").alias("label_index"))


def label_index_apply(spark, sf):
    """Fitted on the labelled documents; the others have no label and get the last index."""
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(
        "doc_id", F.col("quality").cast("string").alias(C.LABEL)
    )
    rows = documents(spark, sf, "doc_id").join(labels, "doc_id", "left")
    indexed = fit_label_index(labels).transform(rows)
    return indexed.select("doc_id", F.col(C.LABEL_INDEX).cast("int").alias("label_index"))


def label_decode(spark, sf):
    rows = documents(spark, sf, "doc_id", "lang")
    indexer = fit_label_index(rows, "lang")
    indexed = indexer.transform(rows).withColumnRenamed(C.LABEL_INDEX, C.PREDICTION_INDEX)
    return decode_labels(indexed, indexer.labels).select("doc_id", C.PREDICTION)


# ---- models, tuning, jobs -------------------------------------------------------------------


def nb_priors(spark, sf):
    return bayes(spark, sf).classes.select("label", "docs", "grams", F.round("pi", 9).alias("pi"))


def nb_theta(spark, sf):
    return (
        bayes(spark, sf)
        .theta()
        .select("label", "gram", "count", F.round("theta", 9).alias("theta"))
    )


def nb_predict(spark, sf):
    scored = bayes_classifier(spark, sf).transform(prepared(spark, sf))
    return scored.select("doc_id", C.PREDICTION)


def grid_points(spark, sf):
    """What every point of the tuning grid means for this corpus: grams per hash bucket."""
    counts = gram_counts_by_size(prepared(spark, sf), C.FILTERED, GRAM_SIZES, [])
    sizes = F.explode(F.array(*[F.lit(size) for size in FEATURE_COUNTS])).alias("features")
    totals = counts.groupBy("n").agg(F.sum("freq").alias("grams"), F.count("*").alias("distinct"))
    return totals.select("n", "grams", "distinct", sizes).withColumn(
        "load", F.round(F.col("distinct") / F.col("features"), 9)
    )


def fold_counts(spark, sf):
    rows = prepared(spark, sf).withColumn("fold", fold_of(F.col("doc_id")))
    return rows.groupBy("fold", "lang").agg(F.count("*").alias("docs"))


def stratified_fold_query(spark, sf):
    rows = prepared(spark, sf).select("doc_id", "lang")
    scratch = Scratch(spark).until_exit()
    return stratified_folds(rows, 3, scratch, "lang", ("doc_id",)).select("doc_id", "lang", "fold")


def learn_in_parts(spark, sf):
    """Predictions of a model that has learnt from the documents in three parts, one after the other."""
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    step = guess_step(spark, sf)
    for part in range(3):
        texts = documents(spark, sf).filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == part)
        learn_from(texts, step, registry, "language", GRID[0], length_fold())
    model = registry.load("language")
    return apply_pipeline(model, prepared(spark, sf)).select("doc_id", C.PREDICTION)


def learnt_sums(spark, sf):
    """The sums that are kept with that model, after two parts."""
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    step = guess_step(spark, sf)
    for part in range(2):
        texts = documents(spark, sf).filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == part)
        learn_from(texts, step, registry, "language", GRID[-1], length_fold())
    return registry.load_sums("language").counts


def cv_metrics(spark, sf):
    tuned = learn(documents(spark, sf), guess_step(spark, sf), fold=fold_of(F.col("doc_id")))
    schema = "n int, features int, fold int, weighted_f1 double"
    scores = spark.createDataFrame(tuned.metrics, schema)
    return scores.withColumn("weighted_f1", F.round("weighted_f1", 9))


def length_fold():
    """A fold by content that SQL can tell as well."""
    return fold_of(F.length(C.FILTERED))


def train_predict(spark, sf):
    tuned = learn(documents(spark, sf), guess_step(spark, sf), fold=length_fold())
    return apply_pipeline(tuned.model, prepared(spark, sf)).select("doc_id", C.PREDICTION)


def score_projection(spark, sf):
    scored = predict_new(
        tweets(spark, sf),
        already_predicted(spark, sf),
        bayes_classifier(spark, sf),
        guess_step(spark, sf),
    )
    return result_rows(scored)


def score_adhoc(spark, sf):
    texts = given_texts(read_texts(spark, f"{sf}/benchmark.parquet"))
    return score_texts(texts, bayes_classifier(spark, sf))


def score_turns(spark, sf):
    """The conversation turns as given texts: a second source, scored by the pipeline model."""
    tuned = learn(documents(spark, sf), guess_step(spark, sf), fold=length_fold())
    return score_texts(
        given_texts(read_texts(spark, f"{sf}/conversations.parquet")), tuned.model
    )


def learn_and_predict_query(spark, sf):
    path = new_path(spark, "predictions")
    registry = ModelRegistry(spark, new_path(spark, "registry"))
    step = guess_step(spark, sf)
    rows = tweets(spark, sf)
    learn_and_predict(rows, path, registry, "language", step, fold=length_fold())
    return result_rows(read_predictions(spark, path))


def incremental_second_run_empty(spark, sf):
    path = new_path(spark, "predictions")
    rows, step = tweets(spark, sf), guess_step(spark, sf)
    model = bayes_classifier(spark, sf)
    predict_job(rows, path, model, step)
    first = read_predictions(spark, path).count()
    predict_job(rows, path, model, step)
    second = read_predictions(spark, path).count() - first
    schema = "first_run long, second_run long, skipped_short long"
    return spark.createDataFrame([(first, second, count_short(rows))], schema)


def stream_incremental(spark, sf):
    path, checkpoint = new_path(spark, "predictions"), new_path(spark, "stream")
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    stream = stream_texts(spark, f"{sf}/documents*.parquet", schema).select(
        F.col("doc_id").cast("string").alias(C.ID), F.expr(CREATED_AT).alias(C.CREATED_AT), C.TEXT
    )
    step, model = guess_step(spark, sf), bayes_classifier(spark, sf)

    def score(rows: DataFrame) -> DataFrame:
        return model.transform(prepare(rows, labeler=step))

    predict_stream(stream, path, checkpoint, score).awaitTermination()
    return result_rows(read_predictions(spark, path))


def stream_into_replayed(spark, sf):
    """The stream with batches in its commits; its first batch arrives again after it is done."""
    table, checkpoint = prediction_table(spark, new_path(spark, "results")), new_path(spark, "stream")
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    stream = stream_texts(spark, f"{sf}/documents*.parquet", schema).select(
        F.col("doc_id").cast("string").alias(C.ID), F.expr(CREATED_AT).alias(C.CREATED_AT), C.TEXT
    )
    step, model = guess_step(spark, sf), bayes_classifier(spark, sf)

    def score(rows: DataFrame) -> DataFrame:
        return model.transform(step(rows))

    predict_stream_into(stream, table, checkpoint, score).awaitTermination()
    predict_into(table, tweets(spark, sf), score, batch=f"{checkpoint}#0")
    return result_rows(table.read())


def entry(spark: SparkSession) -> DataFrame:
    """How often is the language guess right? Profiles, cleaning, guesses and the success rate."""
    use_local_folder(spark)
    return guess_accuracy(spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def with_folder(query: Query) -> Query:
    """Gives a local session a folder for intermediate tables where it names none."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        use_local_folder(spark)
        return query(spark, sf)

    return run


def queries() -> dict[str, Query]:
    """Every registered query; those of the training-data operators where they are installed."""
    found = own_queries()
    if llm:
        found |= llm.queries()
        found["pipeline"] = corpus_pipeline.run
    return {name: with_folder(query) for name, query in found.items()}


def own_queries() -> dict[str, Query]:
    return {
        "src_subquery": src_subquery,
        "scan_text": scan_text,
        "incremental_unpredicted": incremental_unpredicted,
        "inline_texts": inline_texts,
        "profile_json_roundtrip": profile_json_roundtrip,
        "sink_append_roundtrip": sink_append_roundtrip,
        "sink_concurrent_append": sink_concurrent_append,
        "incremental_result_table": incremental_result_table,
        "skipped_rows_second_run": skipped_rows_second_run,
        "registry_latest": registry_latest,
        "registry_roundtrip_predict": registry_roundtrip_predict,
        "registry_gram_model": registry_gram_model,
        "predict_with_registry_model": predict_with_registry_model,
        "regex_replace": regex_replace,
        "clean_entities": branch("entity"),
        "clean_entities_pages": branch("entity", "pages"),
        "clean_retweet": branch("retweet"),
        "clean_email": branch("email"),
        "clean_mentions": branch("mention"),
        "clean_links": branch("link"),
        "clean_links_pages": branch("link", "pages"),
        "clean_hashtags": branch("hashtag"),
        "clean_emoji_range": branch("emoji"),
        "clean_text": clean_query,
        "min_length": min_length_query,
        "prepare_unlabeled": prepare_unlabeled,
        "prepare_labeled": prepare_labeled,
        "content_digest": content_digest,
        "build_profile": build_profile_query,
        "frequent_profile": frequent_profile,
        "guess_language": guess_language,
        "guess_language_join": guess_language_join,
        "guess_language_split": guess_language_split,
        "guess_language_broadcast": guess_language_broadcast,
        "guess_unknown": guess_unknown,
        "guess_with_imported_profile": guess_with_imported_profile,
        "guess_accuracy": guess_accuracy,
        "success_rate": success_rate_query,
        "weighted_f1": weighted_f1_query,
        "class_f1": class_f1,
        "char_tokens": char_tokens_query,
        "char_ngrams_3": ngrams_query(3),
        "char_ngrams_4": ngrams_query(4),
        "ngram_topk": ngram_topk,
        "ngram_counts_by_lang": ngram_counts_by_lang,
        "hashed_tf": hashed_tf,
        "tf_mass": tf_mass,
        "label_index": label_index,
        "label_index_apply": label_index_apply,
        "label_decode": label_decode,
        "nb_priors": nb_priors,
        "nb_theta": nb_theta,
        "nb_predict": nb_predict,
        "grid_points": grid_points,
        "fold_counts": fold_counts,
        "stratified_folds": stratified_fold_query,
        "learn_in_parts": learn_in_parts,
        "learnt_sums": learnt_sums,
        "cv_metrics": cv_metrics,
        "train_predict": train_predict,
        "score_projection": score_projection,
        "score_adhoc": score_adhoc,
        "score_turns": score_turns,
        "learn_and_predict": learn_and_predict_query,
        "incremental_second_run_empty": incremental_second_run_empty,
        "stream_incremental": stream_incremental,
        "stream_into_replayed": stream_into_replayed,
    }


# ---- the same in SQL ------------------------------------------------------------------------


def re2(pattern: str) -> str:
    """A cleaning pattern as an SQL literal in RE2 syntax."""
    pattern = re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", pattern)
    return "'" + pattern.replace("'", "''") + "'"


def cut(text: str) -> str:
    """The character stream of a text, one list element per character."""
    return f"regexp_extract_all(lower({text}), '[^\\n\\r\\x{{85}}\\x{{2028}}\\x{{2029}}]')"


def gram_list(chars: str, n: int, glue: str = "") -> str:
    """All n-grams of a list of characters."""
    joined = f"||'{glue}'||".join(f"{chars}[i+{k}]" for k in range(n))
    return f"list_transform(range(1, len({chars}) - {n - 2}), lambda i: {joined})"


def murmur3(source: str, term: str) -> str:
    """``source`` with ``h``: the signed 32-bit MurmurHash3, seed 42, of the UTF-8 bytes of ``term``."""
    mask, high = 0xFFFFFFFF, 0x80000000

    def stirred(value: str, bits: int, first: int, second: int) -> list[str]:
        turned = f"(({value} * {first}) & {mask})"
        return [turned, f"((((x << {bits}) | (x >> {32 - bits})) & {mask}) * {second}) & {mask}"]

    def number(digits: str) -> str:
        """Hex digits of up to four bytes, the least one first."""
        return f"list_sum(list_transform(range(0, length({digits}) // 2), lambda i:" \
            f" ('0x' || substr({digits}, 2 * i + 1, 2))::UBIGINT << (8 * i)))::UBIGINT"

    first, second = stirred("x", 15, 0xCC9E2D51, 0x1B873593)
    round_ = "xor(h, x)"
    step = f"((((({round_} << 13) | ({round_} >> 19)) & {mask}) * 5) + {0xE6546B64}) & {mask}"
    return (
        f"(SELECT * EXCLUDE (digits, h0, h1, h2), CASE WHEN h3 >= {high} THEN h3::BIGINT - {1 << 32}"
        f" ELSE h3::BIGINT END AS h FROM (SELECT *, xor(h2, h2 >> 16) AS h3 FROM"
        f" (SELECT *, (xor(h1, h1 >> 13) * {0xC2B2AE35}) & {mask} AS h2 FROM"
        f" (SELECT *, (xor(h0, h0 >> 16) * {0x85EBCA6B}) & {mask} AS h1 FROM"
        f" (SELECT *, xor(list_reduce(list_transform(list_transform(list_transform("
        f"regexp_extract_all(digits, '.{{1,8}}'), lambda d: {number('d')}), lambda x: {first}),"
        f" lambda x: {second}), lambda h, x, i: CASE WHEN i <= length(digits) // 8 THEN {step}"
        f" ELSE {round_} END, 42::UBIGINT), length(digits) // 2) AS h0 FROM"
        f" (SELECT *, hex(encode({term})) AS digits FROM {source}))))))"
    )


def oracle_sql() -> dict[str, str]:
    found = own_sql()
    if llm:
        found |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def own_sql() -> dict[str, str]:
    decorated_sql = (
        "SELECT doc_id, lang, concat('RT @user', doc_id, ': ', text, ' https://t.co/x', doc_id,"
        " ' #tag', doc_id, ' a.b', doc_id, '@ex.com @you &amp; ‼ ', lang) AS text"
        " FROM documents"
    )
    cleaned = f"regexp_replace(text, {re2('|'.join(P.BRANCHES.values()))}, '', 'g')"
    created = "strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id), '%Y-%m-%d %H:%M:%S')"

    def prepare_cte(source: str = "documents", name: str = "prep") -> str:
        return (
            f"{name} AS (SELECT * FROM (SELECT *, {cleaned} AS f FROM {source} AS source)"
            f" WHERE length(f) >= 30)"
        )

    def occurrences(source: str, text: str, keys: str, sizes=(1, 2, 3)) -> str:
        parts = [
            f"SELECT {keys}, {n} AS n, unnest({gram_list('a', n)}) AS gram"
            f" FROM (SELECT {keys}, {cut(text)} AS a FROM {source})"
            for n in sizes
        ]
        return " UNION ALL ".join(parts)

    def profile_cte(
        sizes=(1, 2, 3), min_count: int = 1, tag: str = "", corpus: str = "documents"
    ) -> str:
        occ = occurrences(corpus, "text", "lang", sizes)
        return (
            f"counts{tag} AS (SELECT lang, n, gram, count(*) AS freq FROM ({occ})"
            f" GROUP BY ALL HAVING count(*) >= {min_count}),"
            f" profile{tag} AS (SELECT lang, n, gram, freq, CAST(sum(freq) OVER"
            f" (PARTITION BY lang, n) AS BIGINT) AS total FROM counts{tag})"
        )

    def guess_cte(
        source: str, text: str, sizes=(1, 2, 3), min_count: int = 1, tag: str = "",
        corpus: str = "documents",
    ) -> str:
        return (
            f"{profile_cte(sizes, min_count, tag, corpus)},"
            f" weights{tag} AS (SELECT lang, n, gram, CAST(round((ln(freq::DOUBLE / total + 1e-6)"
            f" - ln(1e-6)) * 1e6) AS BIGINT) AS w FROM profile{tag}),"
            f" doc_grams{tag} AS (SELECT doc_id, n, gram, count(*) AS c"
            f" FROM ({occurrences(source, text, 'doc_id', sizes)}) GROUP BY ALL),"
            f" scores{tag} AS (SELECT doc_id, w.lang, sum(c * w) AS s FROM doc_grams{tag}"
            f" JOIN weights{tag} AS w USING (n, gram) GROUP BY ALL),"
            f" best{tag} AS (SELECT doc_id, lang AS guess FROM scores{tag} QUALIFY"
            f" row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) = 1),"
            f" guesses{tag} AS (SELECT d.*, coalesce(b.guess, 'unknown') AS guess{tag}"
            f" FROM {source} AS d LEFT JOIN best{tag} AS b USING (doc_id))"
        )

    nb_cte = (
        f"{prepare_cte()}, grams3 AS (SELECT doc_id, lang, gram FROM"
        f" ({occurrences('prep', 'f', 'doc_id, lang', (3,))})),"
        " nb_counts AS (SELECT lang AS label, gram, count(*) AS c FROM grams3 GROUP BY ALL),"
        " vocabulary AS (SELECT DISTINCT gram FROM nb_counts),"
        " v AS (SELECT count(*) AS size FROM vocabulary),"
        " nb_docs AS (SELECT lang AS label, count(*) AS docs FROM prep GROUP BY ALL),"
        " nb_sums AS (SELECT label, CAST(sum(c) AS BIGINT) AS grams FROM nb_counts GROUP BY ALL),"
        " classes AS (SELECT label, docs, grams, ln(docs + 1.0::DOUBLE)"
        " - ln((SELECT sum(docs) + count(*) FROM nb_docs)::DOUBLE) AS pi,"
        " (grams + (SELECT size FROM v))::DOUBLE AS denominator,"
        " row_number() OVER (ORDER BY docs DESC, label) AS position"
        " FROM nb_docs JOIN nb_sums USING (label)),"
        " theta AS (SELECT label, gram, c, ln(c + 1.0::DOUBLE) - ln(denominator) AS theta"
        " FROM nb_counts JOIN classes USING (label))"
    )

    def nb_predict_cte(target_cte: str, target: str, text: str, key: str) -> str:
        return (
            f"{target_cte}, micro AS (SELECT label, position, CAST(round(pi * 1e6) AS BIGINT) AS pi,"
            " CAST(round(-ln(denominator) * 1e6) AS BIGINT) AS absent FROM classes),"
            f" target_grams AS (SELECT {key}, gram, count(*) AS c FROM"
            f" ({occurrences(target, text, key, (3,))}) JOIN vocabulary USING (gram) GROUP BY ALL),"
            f" totals AS (SELECT {key}, sum(c) AS total FROM target_grams GROUP BY ALL),"
            f" gains AS (SELECT {key}, label, sum(g.c * (CAST(round(theta * 1e6) AS BIGINT) - absent))"
            f" AS gain FROM target_grams AS g JOIN theta USING (gram) JOIN micro USING (label)"
            f" GROUP BY ALL),"
            f" predicted AS (SELECT t.{key}, m.label AS prediction FROM {target} AS t"
            f" CROSS JOIN micro AS m LEFT JOIN totals USING ({key})"
            f" LEFT JOIN gains AS g ON g.{key} = t.{key} AND g.label = m.label"
            f" QUALIFY row_number() OVER (PARTITION BY t.{key} ORDER BY"
            f" pi + coalesce(total, 0) * absent + coalesce(gain, 0) DESC, position) = 1)"
        )

    def scored_sql(condition: str = "") -> str:
        """Result rows of the scoring job: Bayes prediction, guess as label."""
        return (
            f"WITH {nb_cte}, {nb_predict_cte('nothing AS (SELECT 1)', 'prep', 'f', 'doc_id')},"
            f" {guess_cte('prep', 'f')}"
            f" SELECT CAST(doc_id AS VARCHAR) AS id, {created} AS created_at, text, prediction,"
            f" guess AS label FROM guesses JOIN predicted USING (doc_id) {condition}"
        )

    sql = {
        "src_subquery": "SELECT text FROM documents",
        "scan_text": "SELECT text FROM documents",
        "incremental_unpredicted": (
            f"SELECT CAST(t.doc_id AS VARCHAR) AS id,"
            f" {created.replace('doc_id', 't.doc_id')} AS created_at, t.text FROM documents AS t"
            " LEFT JOIN labels AS p ON t.doc_id = p.doc_id WHERE p.doc_id IS NULL"
        ),
        "inline_texts": 'SELECT text AS "filteredText" FROM benchmark',
        "profile_json_roundtrip": f"WITH {profile_cte()} SELECT * FROM profile",
        "sink_append_roundtrip": (
            f"WITH {prepare_cte()} SELECT CAST(doc_id AS VARCHAR) AS id, {created} AS created_at,"
            " text, lang AS prediction, CAST(NULL AS VARCHAR) AS label FROM prep"
        ),
        "registry_latest": (
            f"SELECT source AS name, {created} AS created_at, sha1(text) AS digest FROM documents"
            " QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) = 1"
        ),
        "regex_replace": (
            "SELECT doc_id, regexp_replace(text, '(\\w+) (\\w+)', '\\2 \\1', 'g')"
            ' AS "filteredText" FROM documents'
        ),
        "clean_text": f'SELECT doc_id, {cleaned} AS "filteredText" FROM ({decorated_sql})',
        "min_length": f"WITH {prepare_cte()} SELECT doc_id, CAST(length(f) AS INTEGER) AS n FROM prep",
        "prepare_unlabeled": (
            f"WITH {prepare_cte(f'({decorated_sql})')}"
            ' SELECT doc_id, f AS "filteredText" FROM prep'
        ),
        "prepare_labeled": (
            f"WITH {prepare_cte(f'({decorated_sql})')}, {guess_cte('prep', 'f')}"
            ' SELECT doc_id, f AS "filteredText", guess AS label FROM guesses'
        ),
        "content_digest": "SELECT doc_id, sha1(text) AS digest FROM documents",
        "build_profile": f"WITH {profile_cte()} SELECT * FROM profile",
        "guess_language": (
            f"WITH {prepare_cte()}, {guess_cte('prep', 'f')}"
            " SELECT doc_id, guess AS label FROM guesses"
        ),
        "guess_unknown": (
            "WITH foreigners AS (SELECT doc_id AS own, 2 * row_number() OVER () + copy AS doc_id,"
            f" CASE WHEN copy = 1 THEN regexp_replace(text, '{FOREIGN_LETTERS}', '{FOREIGN}', 'g')"
            " ELSE text END AS text FROM documents, (VALUES (0), (1)) AS copies(copy)),"
            f" {guess_cte('foreigners', 'text', (3,))}"
            " SELECT own AS doc_id, length(text)::INTEGER AS n, guess AS label FROM guesses"
        ),
        "guess_accuracy": (
            f"WITH {prepare_cte()}, {guess_cte('prep', 'f')},"
            " r AS (SELECT count(*) FILTER (lang = guess) AS correct, count(*) AS predicted"
            " FROM guesses) SELECT correct, predicted,"
            " correct::DOUBLE / predicted::DOUBLE * 100.0 AS percent_successrate FROM r"
        ),
        "success_rate": (
            f"WITH {prepare_cte()}, {guess_cte('prep', 'f', (1,), 1, '1')},"
            f" {guess_cte('guesses1', 'f')} SELECT correct.c AS correct, predicted.p AS predicted,"
            " correct.c::DOUBLE / predicted.p::DOUBLE * 100.0 AS percent_successrate FROM"
            " (SELECT count(*) AS c FROM guesses WHERE guess = guess1) AS correct,"
            " (SELECT count(*) AS p FROM guesses) AS predicted"
        ),
        "char_tokens": (
            f"WITH {prepare_cte()}, t AS (SELECT doc_id, {cut('f')} AS a FROM prep)"
            " SELECT doc_id, CAST(len(a) AS INTEGER) AS n,"
            " sha1(array_to_string(a, '|')) AS digest FROM t"
        ),
        "ngram_topk": (
            f"WITH {prepare_cte()} SELECT gram, count(*) AS count FROM"
            f" ({occurrences('prep', 'f', 'doc_id', (3,))})"
            " GROUP BY gram ORDER BY count DESC, gram LIMIT 50"
        ),
        "ngram_counts_by_lang": (
            f"WITH {prepare_cte()}, c AS (SELECT lang, n, gram, count(*) AS freq FROM"
            f" ({occurrences('prep', 'f', 'lang', (1, 2, 3, 4))}) GROUP BY ALL)"
            " SELECT lang, n, count(*) AS grams, CAST(sum(freq) AS BIGINT) AS freq"
            " FROM c GROUP BY ALL"
        ),
        "label_index": (
            "SELECT lang, count(*) AS count, CAST(row_number() OVER"
            " (ORDER BY count(*) DESC, lang) - 1 AS INTEGER) AS label_index"
            " FROM documents GROUP BY lang"
        ),
        "label_index_apply": (
            "WITH ranks AS (SELECT quality, row_number() OVER (ORDER BY count(*) DESC, quality)"
            " - 1 AS position FROM labels GROUP BY quality)"
            " SELECT doc_id, CAST(coalesce(position, (SELECT count(*) FROM ranks)) AS INTEGER)"
            " AS label_index FROM documents LEFT JOIN labels USING (doc_id)"
            " LEFT JOIN ranks USING (quality)"
        ),
        "label_decode": "SELECT doc_id, lang AS prediction FROM documents",
        "nb_priors": f"WITH {nb_cte} SELECT label, docs, grams, round(pi, 9) AS pi FROM classes",
        "nb_theta": (
            f"WITH {nb_cte} SELECT label, gram, c AS count, round(theta, 9) AS theta FROM theta"
        ),
        "nb_predict": (
            f"WITH {nb_cte}, {nb_predict_cte('nothing AS (SELECT 1)', 'prep', 'f', 'doc_id')}"
            " SELECT doc_id, prediction FROM predicted"
        ),
        "grid_points": (
            f"WITH {prepare_cte()}, c AS (SELECT n, gram, count(*) AS freq FROM"
            f" ({occurrences('prep', 'f', 'doc_id', GRAM_SIZES)}) GROUP BY ALL),"
            " t AS (SELECT n, CAST(sum(freq) AS BIGINT) AS grams, count(*) AS distinct_grams"
            " FROM c GROUP BY n) SELECT n, grams, distinct_grams AS \"distinct\", features,"
            " round(distinct_grams::DOUBLE / features, 9) AS load FROM t,"
            f" (SELECT unnest({list(FEATURE_COUNTS)}) AS features)"
        ),
        "fold_counts": (
            f"WITH {prepare_cte()} SELECT CAST(doc_id % 2 AS INTEGER) AS fold, lang,"
            " count(*) AS docs FROM prep GROUP BY ALL"
        ),
        "score_projection": scored_sql("WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
        "score_adhoc": (
            f"WITH {nb_cte},"
            f" {nb_predict_cte('nothing AS (SELECT 1)', 'benchmark', 'text', 'item_id')}"
            ' SELECT text AS "filteredText", prediction FROM benchmark'
            " JOIN predicted USING (item_id)"
        ),
        "incremental_second_run_empty": (
            f"WITH {prepare_cte()} SELECT count(*) AS first_run, CAST(0 AS BIGINT) AS second_run,"
            " (SELECT count(*) FROM documents) - count(*) AS skipped_short FROM prep"
        ),
        "stream_incremental": scored_sql(),
    }
    for n in (3, 4):
        sql[f"char_ngrams_{n}"] = (
            f"WITH {prepare_cte()}, t AS (SELECT doc_id, {gram_list('a', n, ' ')} AS g FROM"
            f" (SELECT doc_id, {cut('f')} AS a FROM prep)) SELECT doc_id,"
            " CAST(len(g) AS INTEGER) AS n, sha1(array_to_string(g, '|')) AS digest FROM t"
        )
    for name, key in {
        "clean_entities": "entity",
        "clean_retweet": "retweet",
        "clean_email": "email",
        "clean_mentions": "mention",
        "clean_links": "link",
        "clean_hashtags": "hashtag",
        "clean_emoji_range": "emoji",
    }.items():
        sql[name] = (
            f"SELECT doc_id, regexp_replace(text, {re2(P.BRANCHES[key])}, '', 'g')"
            f' AS "filteredText" FROM ({decorated_sql})'
        )
    for name, key in {"clean_entities_pages": "entity", "clean_links_pages": "link"}.items():
        sql[name] = (
            f"SELECT page_id AS doc_id, regexp_replace(html, {re2(P.BRANCHES[key])}, '', 'g')"
            ' AS "filteredText" FROM pages'
        )
    def folded_sql(text: str) -> str:
        for span, one in REPRESENTATIVES.items():
            text = f"regexp_replace({text}, '[{span}]', '{one}', 'g')"
        return text

    def kana_sql(first: int) -> str:
        return folded_sql(f"translate(lower(text), '{LETTERS}', '{kana(first)}')")

    sql["guess_with_imported_profile"] = (
        f"WITH corpus AS (SELECT lang, {folded_sql('text')} AS text FROM documents UNION ALL"
        f" SELECT 'ja', {kana_sql(KANA[0])} FROM benchmark),"
        f" asked AS (SELECT doc_id AS own, 0 AS copy, 2 * doc_id AS doc_id, {folded_sql('text')} AS text"
        f" FROM documents UNION ALL SELECT doc_id, 1, 2 * doc_id + 1, {kana_sql(KANA[1])} FROM documents),"
        f" {guess_cte('asked', 'text', corpus='corpus')}"
        " SELECT own AS doc_id, copy::INTEGER AS copy, guess AS label FROM guesses"
    )
    sql["frequent_profile"] = f"WITH {profile_cte(min_count=5)} SELECT * FROM profile"
    for name in ("guess_language_join", "guess_language_split", "guess_language_broadcast"):
        sql[name] = sql["guess_language"]
    sql["registry_gram_model"] = sql["nb_predict"]

    def terms(source: str, text: str, keys: str) -> str:
        """Grams as the hashing stage gets them, their characters parted by spaces."""
        return " UNION ALL ".join(
            f"SELECT {keys}, {n} AS n, unnest({gram_list('a', n, ' ')}) AS term"
            f" FROM (SELECT {keys}, {cut(text)} AS a FROM {source})"
            for n in GRAM_SIZES
        )

    def hashed_cte(source: str, text: str, key: str, tag: str) -> str:
        """``tf{tag} (key, n, features, bucket, tf)``: the features of all points of the grid."""
        return (
            f"terms{tag} AS MATERIALIZED (SELECT {key}, n, term, count(*) AS c"
            f" FROM ({terms(source, text, key)}) GROUP BY ALL),"
            f" kinds{tag} AS (SELECT DISTINCT term FROM terms{tag}),"
            f" hashes{tag} AS MATERIALIZED (SELECT term, h FROM {murmur3(f'kinds{tag}', 'term')}),"
            f" tf{tag} AS MATERIALIZED (SELECT {key}, n, features,"
            " ((h % features + features) % features)::BIGINT AS bucket, sum(c)::BIGINT AS tf"
            f" FROM terms{tag} JOIN hashes{tag} USING (term),"
            f" (SELECT unnest({list(FEATURE_COUNTS)}) AS features) GROUP BY ALL)"
        )

    def models_cte(fold: str) -> str:
        """Hashed Naive Bayes models per point and fold left out (-1: none), labels by the guesser."""
        return (
            f"{prepare_cte()}, {guess_cte('prep', 'f')}, {hashed_cte('prep', 'f', 'doc_id', '')},"
            f" gold AS (SELECT doc_id, guess AS label, {fold} AS fold FROM guesses),"
            " ranks AS (SELECT label, row_number() OVER (ORDER BY count(*) DESC, label) AS position"
            " FROM gold GROUP BY label),"
            " splits AS (SELECT unnest([-1, 0, 1]) AS left_out),"
            " class_docs AS (SELECT left_out, label, position,"
            " count(*) FILTER (fold <> left_out) AS docs FROM gold JOIN ranks USING (label), splits"
            " GROUP BY left_out, label, position),"
            " priors AS (SELECT left_out, label, position, ln(docs + 1.0::DOUBLE)"
            " - ln((sum(docs) OVER (PARTITION BY left_out)"
            " + count(*) OVER (PARTITION BY left_out))::DOUBLE) AS pi FROM class_docs),"
            " per_fold AS (SELECT fold, label, n, features, bucket, sum(tf) AS tf"
            " FROM tf JOIN gold USING (doc_id) GROUP BY ALL),"
            " trained AS MATERIALIZED (SELECT left_out, label, n, features, bucket, sum(tf) AS tf"
            " FROM per_fold, splits WHERE fold <> left_out GROUP BY ALL),"
            " class_totals AS (SELECT left_out, label, n, features, sum(tf) AS total"
            " FROM trained GROUP BY ALL)"
        )

    def choice_cte(rows: str, tf: str, key: str, name: str) -> str:
        """The best label of ``rows (key, n, features, left_out)``."""
        return (
            f"gains{name} AS (SELECT r.{key}, r.n, r.features, t.label,"
            " sum(x.tf * ln(t.tf + 1.0::DOUBLE)) AS gain"
            f" FROM {rows} r JOIN {tf} x USING ({key}, n, features)"
            " JOIN trained t ON t.left_out = r.left_out AND t.n = r.n AND t.features = r.features"
            " AND t.bucket = x.bucket GROUP BY ALL),"
            f" lengths{name} AS (SELECT {key}, n, features, sum(tf) AS grams FROM {tf} GROUP BY ALL),"
            f" chosen{name} AS (SELECT r.{key}, r.n, r.features, p.label AS prediction"
            f" FROM {rows} r JOIN priors p USING (left_out)"
            f" LEFT JOIN lengths{name} l USING ({key}, n, features)"
            f" LEFT JOIN gains{name} g ON g.{key} = r.{key} AND g.n = r.n"
            " AND g.features = r.features AND g.label = p.label"
            " LEFT JOIN class_totals c ON c.left_out = r.left_out AND c.label = p.label"
            " AND c.n = r.n AND c.features = r.features"
            f" QUALIFY row_number() OVER (PARTITION BY r.{key}, r.n, r.features ORDER BY"
            " pi + coalesce(gain, 0) - coalesce(grams, 0) * ln(coalesce(total, 0) + r.features)"
            " DESC, position) = 1)"
        )

    def metrics_cte(fold: str) -> str:
        grid = f"(SELECT unnest({list(GRAM_SIZES)}) AS n), (SELECT unnest({list(FEATURE_COUNTS)}) AS features)"
        return (
            f"{models_cte(fold)},"
            f" tested AS MATERIALIZED (SELECT doc_id, n, features, fold AS left_out FROM gold, {grid}),"
            f" {choice_cte('tested', 'tf', 'doc_id', '_cv')},"
            " judged AS (SELECT n, features, fold, label, prediction"
            " FROM chosen_cv JOIN gold USING (doc_id)),"
            " hits AS (SELECT n, features, fold, label, count(*) AS actual,"
            " count(*) FILTER (label = prediction) AS tp FROM judged GROUP BY ALL),"
            " guessed AS (SELECT n, features, fold, prediction AS label, count(*) AS guessed"
            " FROM judged GROUP BY ALL),"
            " metrics AS (SELECT n, features, fold,"
            " sum(2.0::DOUBLE * tp / (actual + coalesce(guessed, 0)) * actual) / sum(actual)"
            " AS weighted_f1 FROM hits LEFT JOIN guessed USING (n, features, fold, label)"
            " GROUP BY ALL)"
        )

    tf_sql = (
        f"WITH {prepare_cte()}, {hashed_cte('prep', 'f', 'lang, doc_id', '')}"
        " SELECT n::INTEGER AS n, features::INTEGER AS features, lang, bucket::INTEGER AS bucket,"
        " sum(tf)::BIGINT AS tf FROM tf GROUP BY ALL"
    )
    sql["hashed_tf"] = tf_sql
    sql["tf_mass"] = (
        "SELECT n, features, lang, sum(tf)::BIGINT AS mass, count(*) AS buckets"
        f" FROM ({tf_sql}) GROUP BY ALL"
    )
    sql["cv_metrics"] = (
        f"WITH {metrics_cte('(doc_id % 2)')} SELECT n::INTEGER AS n, features::INTEGER AS features,"
        " fold::INTEGER AS fold, round(weighted_f1, 9) AS weighted_f1 FROM metrics"
    )

    def tuned_cte(target: str, text: str, key: str, cte: str = "") -> str:
        """``chosen_new (key, prediction)`` of a target table by the best model of the grid."""
        features = "tf" if target == "prep" else "tf_new"
        own = "" if target == "prep" else f" {cte}, {hashed_cte(target, text, key, '_new')},"
        return (
            f"{metrics_cte('(length(f) % 2)')},{own}"
            " best_point AS (SELECT n, features FROM metrics GROUP BY ALL"
            " ORDER BY round(avg(weighted_f1), 12) DESC, n, features LIMIT 1),"
            f" asked AS (SELECT {key}, n, features, -1 AS left_out FROM {target}, best_point),"
            f" {choice_cte('asked', features, key, '_new')}"
        )

    sql["train_predict"] = (
        f"WITH {tuned_cte('prep', 'f', 'doc_id')} SELECT doc_id, prediction FROM chosen_new"
    )
    sql["registry_roundtrip_predict"] = sql["train_predict"]
    sql["learn_in_parts"] = (
        f"WITH {models_cte('(length(f) % 2)')}, asked AS (SELECT doc_id, {GRID[0][0]} AS n,"
        f" {GRID[0][1]} AS features, -1 AS left_out FROM prep),"
        f" {choice_cte('asked', 'tf', 'doc_id', '_new')}"
        " SELECT doc_id, prediction FROM chosen_new"
    )
    sql["learnt_sums"] = (
        f"WITH {models_cte('(length(f) % 2)')} SELECT n::INTEGER AS n, features::INTEGER AS features,"
        " fold::INTEGER AS fold, label, bucket::INTEGER AS bucket, tf::BIGINT AS tf FROM per_fold"
    )
    sql["stratified_folds"] = (
        f"WITH {prepare_cte()} SELECT doc_id, lang, ((row_number() OVER"
        " (PARTITION BY lang ORDER BY doc_id) - 1) % 3)::INTEGER AS fold FROM prep"
    )
    turns = "turns AS (SELECT row_number() OVER () AS turn_id, text FROM conversations)"
    sql["score_turns"] = (
        f"WITH {tuned_cte('turns', 'text', 'turn_id', turns)}"
        ' SELECT text AS "filteredText", prediction FROM turns JOIN chosen_new USING (turn_id)'
    )
    tuned_rows = (
        f"WITH {tuned_cte('prep', 'f', 'doc_id')} SELECT CAST(doc_id AS VARCHAR) AS id,"
        f" {created} AS created_at, text, prediction, guess AS label"
        " FROM guesses JOIN chosen_new USING (doc_id)"
    )
    sql["predict_with_registry_model"] = (
        f"{tuned_rows} WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
    )
    sql["learn_and_predict"] = tuned_rows
    sql["sink_concurrent_append"] = sql["sink_append_roundtrip"]
    sql["incremental_result_table"] = sql["incremental_unpredicted"]
    sql["stream_into_replayed"] = sql["stream_incremental"]
    sql["skipped_rows_second_run"] = (
        f"WITH {prepare_cte()}, runs AS (SELECT 1 AS run, (SELECT count(*) FROM prep) AS appended,"
        " (SELECT count(*) FROM documents) AS cleaned UNION ALL SELECT 2, 0, 0)"
        " SELECT run, appended, cleaned, cleaned - appended AS short FROM runs"
    )
    class_sql = (
        f"WITH {prepare_cte()}, {guess_cte('prep', 'f', (1,))},"
        " c AS (SELECT lang AS class, count(*) FILTER (lang = guess) AS tp, count(*) AS actual"
        " FROM guesses GROUP BY lang),"
        " g AS (SELECT guess AS class, count(*) AS guessed FROM guesses GROUP BY guess),"
        " s AS (SELECT class, coalesce(tp, 0) AS tp, coalesce(actual, 0) AS actual,"
        " coalesce(guessed, 0) AS guessed FROM c FULL JOIN g USING (class)),"
        " f1 AS (SELECT *, 2.0::DOUBLE * tp / (actual + guessed) AS f1 FROM s)"
    )
    sql["class_f1"] = f"{class_sql} SELECT class, tp, actual, guessed, round(f1, 9) AS f1 FROM f1"
    sql["weighted_f1"] = (
        f"{class_sql} SELECT round(sum(f1 * actual) / sum(actual), 9) AS weighted_f1 FROM f1"
    )
    return sql
