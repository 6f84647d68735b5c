from pyspark.ml.feature import HashingTF, NGram
from pyspark.sql import functions as F

from glotspark.functions import char_ngrams, char_tokens, normalized, windows
from glotspark.operators.features import feature_column, hashed_features, tokenizer
from glotspark.operators.grams import gram_counts, gram_counts_by_size, top_grams

TEXTS = [
    "Heute ist ein schöner Tag!",
    "a\nb\r\u0085 c  d",
    "a😆b😆😆",
    "ab",
    "",
    "ÀÉ ñ ß $1 \\ tab\t.",
]


def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, filteredText string")


def test_tokens_and_grams_equal_the_ml_stages(spark):
    df = tokenizer().transform(frame(spark))
    for n in (1, 2, 3, 4):
        df = NGram(n=n, inputCol="tokenizedText", outputCol=f"ml_{n}").transform(df)
        df = df.withColumn(f"own_{n}", char_ngrams(F.col("filteredText"), n))
    df = df.withColumn("own", char_tokens(F.col("filteredText")))
    for row in df.collect():
        assert row.own == row.tokenizedText
        for n in (1, 2, 3, 4):
            assert row[f"own_{n}"] == row[f"ml_{n}"]


def test_hashed_features_equal_the_pipeline(spark):
    df = tokenizer().transform(hashed_features(frame(spark), [(3, 50), (4, 20_000)]))
    for n, size in [(3, 50), (4, 20_000)]:
        df = NGram(n=n, inputCol="tokenizedText", outputCol=f"g{n}").transform(df)
        df = HashingTF(inputCol=f"g{n}", outputCol=f"h{n}", numFeatures=size).transform(df)
        for row in df.collect():
            assert row[f"h{n}"] == row[feature_column(n, size)]


def brute(text, n):
    for mark in "\n\r\u0085  ":
        text = text.replace(mark, "")
    text = text.lower()
    return [text[i : i + n] for i in range(len(text) - n + 1)]


def test_gram_counts_by_size_equal_brute_force(spark):
    expected = {}
    for text in TEXTS:
        for n in (1, 2, 3):
            for gram in brute(text, n):
                expected[n, gram] = expected.get((n, gram), 0) + 1
    counts = gram_counts_by_size(frame(spark), "filteredText", (1, 2, 3), [])
    assert {(row.n, row.gram): row.freq for row in counts.collect()} == expected
    for n in (1, 2, 3):
        single = gram_counts(frame(spark), "filteredText", n).collect()
        wanted = {gram: count for (m, gram), count in expected.items() if m == n}
        assert {row.gram: row["count"] for row in single} == wanted
    top = top_grams(frame(spark), "filteredText", 1, 3).collect()
    ranked = sorted(
        ((gram, count) for (n, gram), count in expected.items() if n == 1),
        key=lambda pair: (-pair[1], pair[0].encode()),
    )
    assert [(row.gram, row["count"]) for row in top] == ranked[:3]


def test_windows_shrink_at_the_end(spark):
    assert frame(spark).filter("id = 3").select(windows(F.col("filteredText"), 3)).first()[0] == [
        "ab",
        "b",
    ]
    assert frame(spark).filter("id = 4").select(windows(F.col("filteredText"), 3)).first()[0] == []
    assert frame(spark).filter("id = 1").select(normalized(F.col("filteredText"))).first()[0] == (
        "abc  d"
    )
