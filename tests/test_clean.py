import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from glotspark.functions import clean
from glotspark.functions import patterns as P
from glotspark.operators.clean import RegexReplacer, prepare, text_cleaner

# Cleaning cases.
GOLDEN = [
    ("RT @bob: hi RT @bob: x", "hi RT : x"),
    ("line1\nRT @bob: l2", "line1\nRT : l2"),
    ("a😆b", "a😆b"),
    ("日本語テキスト abc", " abc"),
    ("갑자기 xyz", " xyz"),
    ("mail john.doe@ex.com z", "mail  z"),
    ("mail John@Example.com z", "mail John.com z"),
    ("#tag #الحد x", " #الحد x"),
    ("see https://t.co/abc. ok", "see  ok"),
    ("http://x y", ""),
    ("&amp; &#39; &gt;", " &; "),
    ("a@b", "a"),
    ("“q” – ‼ ™ ☀", "“q” –   "),
    ("x.@user", "x."),
    ("", ""),
    ("nothing to clean", "nothing to clean"),
]


def texts(spark, rows):
    return spark.createDataFrame([(row,) for row in rows], "text string")


def test_golden_cases(spark):
    df = texts(spark, [case for case, _ in GOLDEN])
    got = df.select("text", clean(F.col("text"))).collect()
    assert {row[0]: row[1] for row in got} == dict(GOLDEN)
    staged = text_cleaner().transform(df).collect()
    assert {row.text: row.filteredText for row in staged} == dict(GOLDEN)


def test_emoji_option(spark):
    df = texts(spark, ["a😆b ☀ 日本"])
    assert df.select(clean(F.col("text"), "supplementary")).first()[0] == "ab  日本"
    with pytest.raises(ValueError):
        clean(F.col("text"), "none")


def test_shortcuts_and_safe_pattern_change_nothing(spark):
    """The guarded, stack-safe cleaner against the plain pattern on texts made of its parts."""
    rng = random.Random(5)
    parts = ["a", "b-", "-", "1", ".", "@", "@", "[", "]", "\\", " ", "\t", '"', '"', "#", "&"]
    parts += ["amp;", ":", "25", "[1.2.3.", "a:", "x.y", "A", "_", "RT @u: ", "http://", "/"]
    parts += ["é", "\n", "{", "‼", "\U0001f606"]
    rows = ["".join(rng.choices(parts, k=rng.randint(1, 24))) for _ in range(60_000)]
    inner = ["a", "]", "\\", "\\ ", " ", "\t", '"', "x", "@", "."]
    rows += [
        "q@[1.2.3.a:" + "".join(rng.choices(inner, k=rng.randint(0, 9))) + rng.choice("] z")
        for _ in range(20_000)
    ]
    df = texts(spark, rows).select(
        "text",
        F.regexp_replace("text", P.CLEAN_PATTERN, "").alias("plain"),
        clean(F.col("text")).alias("safe"),
    )
    assert df.filter("plain <> safe").limit(3).collect() == []
    assert df.filter("plain <> text").count() > 10_000
    emails = texts(spark, rows).select(
        F.regexp_replace("text", P.EMAIL, "<>").alias("plain"),
        F.regexp_replace("text", P.SAFE_EMAIL, "<>").alias("safe"),
    )
    assert emails.filter("plain <> safe").limit(3).collect() == []
    assert emails.filter("plain like '%<>%'").count() > 1_000


@pytest.mark.parametrize(
    "text",
    [
        "a." * 50_000 + " @",
        "0a" * 100_000 + " @",
        'x "' + "Ab" * 50_000 + " @",
        "q@" + "a." * 50_000 + " z",
        "q@[1.2.3.a:" + "x" * 50_000 + " z",
    ],
    ids=["dots", "run", "quote", "domain", "literal"],
)
def test_long_runs_are_survived(spark, text):
    assert texts(spark, [text]).select(F.length(clean(F.col("text")))).first()[0] > 0


def test_regex_replacer_groups_defaults_and_persistence(spark, tmp_path):
    df = texts(spark, ["ab cd"])
    swap = RegexReplacer(inputCol="text", outputCol="out", pattern=r"(\w+) (\w+)")
    assert swap.getReplacement() == ""
    assert swap.setReplacement("$2 $1").transform(df).first().out == "cd ab"
    assert RegexReplacer(inputCol="text", outputCol="out").getPattern() == ""
    Pipeline(stages=[swap]).fit(df).write().overwrite().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert loaded.transform(df).first().out == "cd ab"
    assert loaded.stages[0].uid == swap.uid


def test_prepare_drops_null_and_short_texts(spark):
    df = texts(spark, [None, "", "x" * 29, "y" * 30, "z" * 40 + " @me"])
    assert sorted(row.filteredText for row in prepare(df).collect()) == [
        "y" * 30,
        "z" * 40 + " ",
    ]
    # One code point counts one, also outside the basic plane.
    assert prepare(texts(spark, ["\U0001f606" * 29, "\U0001f606" * 30])).count() == 1


def test_cleaning_runs_once_per_text(spark):
    plan = prepare(texts(spark, ["x" * 40]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(text") == 4
