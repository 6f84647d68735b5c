import math
import random

import pytest
from pyspark.sql import functions as F

from glotspark.operators.classifier import GramClassifier
from glotspark.operators.gram_model import (
    load_gram_model,
    predict,
    predict_by_join,
    save_gram_model,
)
from glotspark.operators.profiles import build_profile, fit_guesser, labeler
from glotspark.sources.profiles import read_profiles, write_profiles
from tests.test_grams import brute

TRAIN = [
    ("en", "Today is a good day, and the day is long 😆"),
    ("en", "the thing that they thought"),
    ("de", "Heute ist ein schöner Tag und der Tag ist lang"),
    ("fr", "aujourd'hui est une belle journée"),
]


def profile_of(rows):
    counts, totals = {}, {}
    for lang, text in rows:
        for n in (1, 2, 3):
            for gram in brute(text, n):
                counts[lang, n, gram] = counts.get((lang, n, gram), 0) + 1
                totals[lang, n] = totals.get((lang, n), 0) + 1
    return counts, totals


def guess_brute(text, counts, totals, eps=1e-6):
    scores, hit = {}, False
    for lang in sorted({lang for lang, _, _ in counts}):
        score = 0
        for n in (1, 2, 3):
            for gram in brute(text, n):
                freq = counts.get((lang, n, gram), 0)
                if freq:
                    hit = True
                    weight = math.log(freq / totals[lang, n] + eps) - math.log(eps)
                    score += math.floor(weight * 1e6 + 0.5)
        scores[lang] = score
    best = max(scores.values())
    return min(lang for lang, s in scores.items() if s == best) if hit else "unknown"


@pytest.fixture(scope="module")
def profile(spark):
    return build_profile(spark.createDataFrame(TRAIN, "lang string, text string"))


def test_profile_equals_brute_force(profile):
    counts, totals = profile_of(TRAIN)
    got = {(r.lang, r.n, r.gram): (r.freq, r.total) for r in profile.collect()}
    assert got == {key: (freq, totals[key[:2]]) for key, freq in counts.items()}


def test_every_plan_equals_brute_force(spark, profile, monkeypatch):
    monkeypatch.setattr("glotspark.operators.gram_model.SLICE_BYTES", 4096)
    rng = random.Random(3)
    pool = "".join(text for _, text in TRAIN) + "zzqЖ日\U0001f600\n"
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(400)]
    texts += ["", "a", "ab", "ЖЖЖ", "\n", "x" * 5000, "the " * 2000]
    counts, totals = profile_of(TRAIN)
    expected = {i: guess_brute(text, counts, totals) for i, text in enumerate(texts)}
    assert {"unknown", "en", "de", "fr"} <= set(expected.values())

    df = spark.createDataFrame(list(enumerate(texts)), "id int, filteredText string")
    model = fit_guesser(profile)
    assert model == load_gram_model(spark, model.path)
    plans = {
        "inline": predict(df, "filteredText", "label", model),
        "broadcast": predict_by_join(df, "id", "filteredText", "label", model),
        "shuffled": predict_by_join(df, "id", "filteredText", "label", model, limit=0),
        "slices": predict(df, "filteredText", "label", model, limit=0),
        "stage": GramClassifier(modelPath=model.path, outputCol="label").transform(df),
    }
    for name, plan in plans.items():
        assert {row.id: row.label for row in plan.collect()} == expected, name
    assert model.slices(0) > 3


def test_slices_keep_rows_with_null_and_repeated_keys(spark, profile, monkeypatch):
    monkeypatch.setattr("glotspark.operators.gram_model.SLICE_BYTES", 2048)
    rows = [(None, "the day"), (1, "der tag"), (1, "the day"), (2, "le jour"), (None, None)]
    df = spark.createDataFrame(rows, "id int, filteredText string")
    model = fit_guesser(profile)
    wanted = sorted(df.transform(labeler(model)).collect(), key=str)
    assert len(wanted) == 5
    for limit in (10_000, 3_000, 0):
        assert sorted(df.transform(labeler(model, limit=limit)).collect(), key=str) == wanted


def test_null_text_is_unknown_and_ties_go_to_the_smaller_code(spark):
    twins = build_profile(
        spark.createDataFrame([("xx", "abcabc"), ("aa", "abcabc")], "lang string, text string")
    )
    model = fit_guesser(twins)
    df = spark.createDataFrame([(1, None), (2, "abc"), (3, "777")], "id int, filteredText string")
    for plan in (
        df.transform(labeler(model)),
        predict_by_join(df, "id", "filteredText", "label", model),
        predict_by_join(df, "id", "filteredText", "label", model, limit=0),
    ):
        assert {row.id: row.label for row in plan.collect()} == {
            1: "unknown",
            2: "aa",
            3: "unknown",
        }


def test_large_alphabets(spark):
    """Grams of four characters over many letters, whose number does not fit 64 bits."""
    letters = "".join(chr(0x4E00 + i) for i in range(66_000) if not 0xD800 <= 0x4E00 + i <= 0xDFFF)
    rows = [("c", 4, letters[i : i + 4], 1_000_000) for i in range(0, len(letters) - 4, 4)]
    weights = spark.createDataFrame(rows, "class string, n int, gram string, weight long")
    model = save_gram_model(weights, ["c"], [4], unknown="unknown")
    df = spark.createDataFrame([(1, letters[:4]), (2, "abcd")], "id int, filteredText string")
    got = predict(df, "filteredText", "out", model).collect()
    assert {row.id: row.out for row in got} == {1: "c", 2: "unknown"}


def test_min_count_and_sizes(spark):
    df = spark.createDataFrame([("en", "aaab")], "lang string, text string")
    kept = build_profile(df, min_count=2).orderBy("n").collect()
    assert [(r.n, r.gram, r.freq, r.total) for r in kept] == [(1, "a", 3, 3), (2, "aa", 2, 2)]


def test_json_profiles(spark, profile, tmp_path):
    write_profiles(profile, str(tmp_path / "own"))
    same = ["lang", "n", "gram", "freq", "total"]
    back = read_profiles(spark, str(tmp_path / "own")).select(*same)
    assert back.count() == profile.count()
    assert back.exceptAll(profile.select(*same)).count() == 0

    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "de").write_text('{"freq":{"ü":3,"üb":2,"x":1},"n_words":[4,2,0],"name":"de"}')
    (folder / "sv").write_text('{"freq":{"å":5},"n_words":[5,0,0],"name":"sv"}')
    rows = read_profiles(spark, str(folder)).collect()
    assert {(r.lang, r.n, r.gram, r.freq, r.total) for r in rows} == {
        ("de", 1, "ü", 3, 4),
        ("de", 2, "üb", 2, 2),
        ("de", 1, "x", 1, 4),
        ("sv", 1, "å", 5, 5),
    }
    guess = fit_guesser(read_profiles(spark, str(folder)))
    df = spark.createDataFrame([("åå",), ("über",)], "filteredText string")
    assert [r.label for r in df.transform(labeler(guess)).collect()] == ["sv", "de"]


def test_json_profiles_of_other_lengths(spark, tmp_path):
    texts = spark.createDataFrame(TRAIN, "lang string, text string")
    for name, sizes in {"long": (3, 4), "all": (1, 2, 3, 4, 5)}.items():
        profile = build_profile(texts, sizes=sizes)
        write_profiles(profile, str(tmp_path / name))
        back = read_profiles(spark, str(tmp_path / name)).select(*profile.columns)
        assert back.exceptAll(profile).count() == 0 and back.count() == profile.count()


def test_malformed_profile_fails(spark, tmp_path):
    (tmp_path / "de").write_text('{"freq":{"x":1},"n_words":[4,2,0],"name":"de"')
    with pytest.raises(Exception):
        read_profiles(spark, str(tmp_path)).collect()


def test_many_languages_and_lengths(spark):
    rows = [(f"l{i:04d}", n, "x" * n, 1, 1) for i in range(1100) for n in (1, 2, 3, 4, 5)]
    profile = spark.createDataFrame(rows, "lang string, n int, gram string, freq long, total long")
    model = fit_guesser(profile)
    assert len(model.classes) == 1100 and model.sizes == (1, 2, 3, 4, 5)


def test_language_profile_is_split_over_many_objects(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("glotspark.sources.profiles.GRAMS_PER_OBJECT", 10)
    profile = build_profile(spark.createDataFrame(TRAIN, "lang string, text string"))
    write_profiles(profile, str(tmp_path / "p"))
    lines = spark.read.text(str(tmp_path / "p"))
    assert lines.count() > 10
    assert read_profiles(spark, str(tmp_path / "p")).count() == profile.count()
    assert lines.agg(F.max(F.length("value"))).first()[0] < 2000
