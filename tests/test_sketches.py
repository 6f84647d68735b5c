from pyspark.sql import functions as F

from glotspark.functions import folded
from glotspark.functions.scripts import REPRESENTATIVES
from glotspark.operators import gram_model
from glotspark.operators.gram_model import predict_by_join
from glotspark.operators.profiles import (
    build_frequent_profile,
    build_profile,
    fit_guesser,
    fold_profile,
    labeler,
)
from glotspark.operators.sketches import frequent

SF = "/root/testdata/sf0.001"


def test_every_frequent_value_passes_and_few_others(spark):
    rows = spark.range(30_000).select((F.col("id") % 9000).cast("string").alias("v"))
    rows = rows.union(spark.range(500).select(F.lit("hot").alias("v")))
    found = frequent(rows, F.col("v"), F.lit(1), 4, width=1 << 14)
    passed = {r.v for r in rows.filter(found.may_be(F.col("v"))).distinct().collect()}
    # 30,000 ids over 9,000 values: the first 3,000 occur four times.
    assert {str(i) for i in range(3000)} | {"hot"} <= passed
    exact = frequent(rows, F.col("v"), F.lit(1), 4)
    others = {r.v for r in rows.filter(exact.may_be(F.col("v"))).distinct().collect()}
    assert len(others) < 3001 + 60 and exact.count <= 2 * 3060
    assert frequent(rows.limit(0), F.col("v"), F.lit(1), 1).count == 0


def test_frequent_profile_equals_the_counted_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    rows = docs.union(spark.createDataFrame([(None, "en"), ("", "de"), ("abc", None)], docs.schema))
    for least, width in ((2, 1 << 18), (7, 1 << 10)):
        want = sorted(map(tuple, build_profile(rows, min_count=least).collect()))
        assert sorted(map(tuple, build_frequent_profile(rows, least, width=width).collect())) == want


def test_split_join_equals_the_plain_one_on_a_hot_gram(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    model = fit_guesser(build_profile(docs))
    texts = [(i, "thethethe" if i % 3 else f"der {i} und die") for i in range(400)] + [(400, ""), (401, "the")]
    df = spark.createDataFrame(texts, "id long, text string")
    # No table counts as small, so that grams meet their weights by a shuffle.
    plain = predict_by_join(df, "id", "text", "out", model, limit=0)
    split = predict_by_join(df, "id", "text", "out", model, limit=0, heavy=50)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))
    # What is left for the shuffle has fewer rows per gram than that.
    grams = df.select(
        "id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("(?=(.{3})).")))).alias("gram")
    )
    often = frequent(grams, F.col("gram"), F.lit(1), 50)
    left = grams.filter(~often.may_be(F.col("gram"))).groupBy("gram").count()
    assert (left.agg(F.max("count")).first()[0] or 0) < 50 < grams.groupBy("gram").count().agg(F.max("count")).first()[0]


def test_weight_tables_leave_the_executors_when_others_come(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    first = labeler(fit_guesser(build_profile(docs)), text="text")(docs)
    answers = first.collect()
    for _ in range(gram_model.SENT_TABLES):
        labeler(fit_guesser(build_profile(docs.limit(20), sizes=(1,))), text="text")(docs).limit(1).collect()
    assert len(gram_model._sent) <= gram_model.SENT_TABLES
    assert first.collect() == answers


def test_scripts_are_folded_one_for_one(spark):
    text = "aé ひらがな カタカナー ㄅㄆㆠ 한글 ạỹ ی 漢字"
    df = spark.createDataFrame([(text,), (None,), ("",), ("plain",)], "t string")
    got = [r[0] for r in df.select(folded(F.col("t"))).collect()]
    assert got == ["aé ああああ アアアアア ㄅㄅㄅ 가가 ểể ي 漢字", None, "", "plain"]
    again = df.select(folded(folded(F.col("t")))).collect()
    assert [r[0] for r in again] == got
    assert all(len(one) == 1 for one in REPRESENTATIVES.values())


def test_folded_profiles_know_all_letters_of_a_script(spark):
    rows = [("ひらがな", "ja"), ("カタ", "ja"), ("hello there", "en"), ("안녕", "ko")]
    profile = fold_profile(build_profile(spark.createDataFrame(rows, "text string, lang string")))
    grams = {(r.lang, r.gram): (r.freq, r.total) for r in profile.collect()}
    assert grams["ja", "あ"] == (4, 6) and grams["ja", "ああ"] == (3, 4) and grams["ko", "가가"] == (1, 1)
    texts = spark.createDataFrame([("ぽんぬ",), ("ゲーム",), ("한글",), ("other",), ("漢",)], "text string")
    step = labeler(fit_guesser(profile), text="text", fold=True)
    got = step(texts)
    assert got.columns == ["text", "label"]
    assert [r.label for r in got.collect()] == ["ja", "ja", "ko", "en", "unknown"]
