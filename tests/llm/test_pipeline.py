import public_tokenizers

import corpus_pipeline
from glotspark.llm import bpe, secrets
from tests.llm.test_minhash import brute

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = (before, docs)
        if name != "encoding":
            assert docs.columns == before.columns
    before, after = kept["toxicity"]
    assert after.exceptAll(before).count() == 0 and after.count() < before.count()
    before, after = kept["near_duplicates"]
    found = brute([(r.doc_id, r.text) for r in before.collect()], corpus_pipeline.PERCENT)
    assert {r.doc_id for r in after.collect()} == {d for d, (_, _, own) in found.items() if own}
    before, after = kept["secrets"]
    assert before.count() == after.count()
    assert secrets.scan(after, None).filter("size(spans) > 0").count() == 0
    before, after = kept["mixing"]
    assert after.exceptAll(before.union(before)).count() == 0
    before, after = kept["encoding"]
    texts = [r.text for r in before.collect()]
    pairs = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = after.collect()
    assert all(r.exact and r.n_tokens == len(r.ids) for r in rows)
    assert sorted(pairs.decode(r.ids) for r in rows) == sorted(t.encode() for t in texts)


def test_mix_repeats_equal_rows(spark):
    rows = [(1, "a b c d", "en", "s", 7)] * 5 + [(None, None, None, None, None)] * 2
    rows += [(i, f"w{i} x y", "en", "t", 7) for i in range(2, 40)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    got = corpus_pipeline.mix_sources(spark, docs, SF)
    assert got.columns == docs.columns
    assert got.exceptAll(docs.union(docs)).count() == 0
    sizes = sum(len(r.text.split()) for r in got.filter("text IS NOT NULL").collect())
    assert abs(sizes - 1.5 * (20 + 38 * 3)) <= 8


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_extra_columns_with_any_name(spark, tmp_path):
    """Dotted names, names that stages use themselves, and names of the same letters."""
    names = ["a.b", "row", "times", "copy", "size", "score", "component", "mark", "node", "`q`"]
    rows = [
        (i, f"words of text number {i} and some more of them", "en", f"s{i % 3}", 7, *range(len(names)))
        for i in range(40)
    ]
    rows += [rows[3]] * 3 + [(None,) * (5 + len(names))] + [(2, *rows[9][1:])]
    docs = spark.createDataFrame(rows).toDF("doc_id", "text", "lang", "source", "n_chars", *names)
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF)
        if name == "encoding":
            assert done.count() == docs.count()
            break
        assert done.columns == docs.columns
        assert done.exceptAll(docs.union(docs).union(docs)).count() == 0
        done.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
