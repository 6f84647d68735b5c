"""Label indices, hashed gram features and the language pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import (
    HashingTF,
    IndexToString,
    NGram,
    RegexTokenizer,
    StringIndexer,
    StringIndexerModel,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions import char_ngrams
from glotspark.functions.storage import Scratch

from .hashed import best_class, bucket_table, distinct_grams, hashed_scores


def fit_label_index(df: DataFrame, label: str = C.LABEL) -> StringIndexerModel:
    """The most frequent label gets 0, ties in label order; unseen and null labels come last."""
    return StringIndexer(inputCol=label, outputCol=C.LABEL_INDEX, handleInvalid="keep").fit(df)


def label_frequencies(df: DataFrame, label: str = C.LABEL) -> DataFrame:
    """``(label, count, labelIndex)``."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("count"))
    return fit_label_index(df, label).transform(counts)


def decode_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    return label_decoder(labels).transform(df)


def tokenizer() -> RegexTokenizer:
    return RegexTokenizer(
        inputCol=C.FILTERED, outputCol=C.TOKENS, gaps=False, toLowercase=True, pattern="."
    )


def naive_bayes(**params) -> NaiveBayes:
    return NaiveBayes(
        featuresCol=C.FEATURES,
        labelCol=C.LABEL_INDEX,
        predictionCol=C.PREDICTION_INDEX,
        probabilityCol=C.PROBABILITY,
        **params,
    )


def feature_stages(n: int, features: int) -> list:
    return [
        tokenizer(),
        NGram(n=n, inputCol=C.TOKENS, outputCol=C.NGRAMS),
        HashingTF(inputCol=C.NGRAMS, outputCol=C.FEATURES, numFeatures=features),
    ]


def label_decoder(labels: Sequence[str]) -> IndexToString:
    return IndexToString(
        inputCol=C.PREDICTION_INDEX, outputCol=C.PREDICTION, labels=list(labels)
    )


def language_pipeline(labels: Sequence[str], n: int = 2, features: int = 1 << 18) -> Pipeline:
    """Tokens, n-grams, hashed frequencies, Naive Bayes, label string."""
    return Pipeline(stages=[*feature_stages(n, features), naive_bayes(), label_decoder(labels)])


def apply_pipeline(
    model: Transformer, df: DataFrame, scratch: Scratch | None = None
) -> DataFrame:
    """``model.transform(df)``, with tokens and n-grams of a language pipeline from one regex.

    The grams are the same strings, and the token arrays, one object per character, are not built.
    Where nothing but the prediction is asked for, no features are made either: a first pass over the
    texts finds their distinct grams, which alone are hashed, and a second one adds up their weights.
    A text with a gram that the first pass has not seen, as in a source that has changed in between,
    goes through the stages.
    """
    stages = getattr(model, "stages", [])
    if not _cuts_grams(stages):
        return model.transform(df)
    grams = char_ngrams(F.col(C.FILTERED), stages[1].getN())
    plain = df.withColumn(stages[1].getOutputCol(), grams)
    for stage in stages[2:]:
        plain = stage.transform(plain)
    if df.isStreaming or not _adds_up(stages):
        return plain
    return _with_sums(df, stages, plain.columns, scratch or Scratch(df.sparkSession).until_exit())


def reads_twice(model: Transformer) -> bool:
    """Whether ``apply_pipeline`` reads the texts of a batch twice for this model."""
    stages = getattr(model, "stages", [])
    return _cuts_grams(stages) and _adds_up(stages)


def _cuts_grams(stages: Sequence) -> bool:
    return (
        len(stages) > 1
        and isinstance(stages[0], RegexTokenizer)
        and isinstance(stages[1], NGram)
        and _settings(stages[0]) == _settings(tokenizer())
    )


def _adds_up(stages: Sequence) -> bool:
    """Whether these are the stages of ``language_pipeline`` as fitted, whose scores are sums."""
    if [type(stage) for stage in stages[2:]] != [HashingTF, NaiveBayesModel, IndexToString]:
        return False
    hashing, bayes, decoder = stages[2:]
    thresholds = bayes.isDefined(bayes.thresholds) and bayes.getThresholds()
    return (
        not hashing.getBinary()
        and bayes.getModelType() == "multinomial"
        and not thresholds
        and hashing.getInputCol() == stages[1].getOutputCol()
        and bayes.getFeaturesCol() == hashing.getOutputCol()
        and bool(bayes.getPredictionCol())
        and decoder.getInputCol() == bayes.getPredictionCol()
        and decoder.isDefined(decoder.labels)
        and len(decoder.getLabels()) >= bayes.numClasses
    )


def _with_sums(df: DataFrame, stages: Sequence, columns: Sequence[str], scratch: Scratch) -> DataFrame:
    _, ngram, hashing, bayes, decoder = stages
    n, size, guess = ngram.getN(), hashing.getNumFeatures(), bayes.getPredictionCol()
    table = bucket_table(distinct_grams(df, C.FILTERED, [n]), [size], scratch)
    sums, fast = f"{guess}_sums", f"{guess}_fast"
    scored = hashed_scores(df, C.FILTERED, sums, table, [((n, size), bayes)], scratch)
    missing = F.get(F.col(sums), F.lit(bayes.numClasses))
    scored = scored.withColumn(fast, F.when(missing == 0, best_class(sums, bayes, 0)))
    # The stages run on empty texts where the sums have decided; their other columns are as ever.
    text = F.when(F.col(fast).isNull(), F.col(C.FILTERED)).otherwise(F.lit(""))
    rest, own = f"{guess}_rest", f"{guess}_rest_grams"
    scored = scored.withColumn(own, char_ngrams(text, n))
    features = f"{guess}_rest_features"
    scored = hashing.copy().setInputCol(own).setOutputCol(features).transform(scored)
    slow = bayes.copy().setFeaturesCol(features).setRawPredictionCol("").setProbabilityCol("")
    scored = slow.setPredictionCol(rest).transform(scored)
    chosen = F.coalesce(F.col(fast), F.col(rest))
    scored = scored.withColumn(ngram.getOutputCol(), char_ngrams(F.col(C.FILTERED), n))
    scored = hashing.transform(scored)
    scored = bayes.transform(scored).withColumn(guess, chosen)
    return decoder.transform(scored).select(*[F.col(f"`{name}`") for name in columns])


def _settings(stage: RegexTokenizer) -> dict:
    return {param.name: value for param, value in stage.extractParamMap().items()}


def hashed_features(
    df: DataFrame, grid: Sequence[tuple[int, int]], text: str = C.FILTERED
) -> DataFrame:
    """Add the vector column of every grid point ``(n, features)``, see ``feature_column``.

    The grams come from one regex per length rather than from the token and n-gram stages; they
    are the same strings, so the hashed indices are those of the pipeline.
    """
    for n in sorted({n for n, _ in grid}):
        grams = f"grams_{n}"
        df = df.withColumn(grams, char_ngrams(F.col(text), n))
        for size in sorted({size for m, size in grid if m == n}):
            df = HashingTF(
                inputCol=grams, outputCol=feature_column(n, size), numFeatures=size
            ).transform(df)
        df = df.drop(grams)
    return df


def feature_column(n: int, features: int) -> str:
    return f"features_{n}_{features}"
