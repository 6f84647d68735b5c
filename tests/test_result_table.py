import random
import threading
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glotspark.functions.storage import Scratch, create_once, names_in, new_path
from glotspark.operators.incremental import unpredicted
from glotspark.plans.jobs import predict_into
from glotspark.sources import result_table
from glotspark.sources.predictions import prediction_table, skipped_table
from glotspark.sources.result_table import Log, ResultTable
from glotspark.streaming import predict_stream_into, stream_texts

SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("value", T.LongType())]
)


def table(spark, buckets=8):
    return ResultTable(spark, new_path(spark, "table"), SCHEMA, "id", buckets)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def test_of_many_writers_of_a_file_one_succeeds(spark):
    path = new_path(spark, "log") + "/1.json"
    with ThreadPool(8) as pool:
        made = pool.map(lambda i: create_once(spark, path, f"writer {i}"), range(8))
    assert sum(made) == 1
    assert names_in(spark, path.rsplit("/", 1)[0]) == ["1.json"]


def test_jobs_at_once_leave_one_row_per_key(spark):
    made = table(spark)
    start = threading.Barrier(3)

    def job(number):
        own = ResultTable(spark, made.path, SCHEMA, "id", 8)
        start.wait()
        return own.append(rows(spark, [(f"k{i}", i) for i in range(number * 20, 100 + number * 20)]))

    with ThreadPool(3) as pool:
        commits = pool.map(job, range(3))
    got = sorted(map(tuple, made.read().collect()))
    assert got == sorted((f"k{i}", i) for i in range(140))
    assert sum(commit.rows for commit in commits) == 140


def test_a_job_that_is_overtaken_checks_what_came_in_between(spark, monkeypatch):
    made = table(spark)
    made.append(rows(spark, [("a", 1), ("b", 1)]))
    create, turns = Log.create, []

    def late(log, commit):
        if not turns:
            turns.append(1)
            # Staged rows are not seen before their commit.
            assert made.read().count() == 2
            ResultTable(spark, made.path, SCHEMA, "id", 8).append(rows(spark, [("c", 2), ("d", 2)]))
        return create(log, commit)

    monkeypatch.setattr(Log, "create", late)
    commit = ResultTable(spark, made.path, SCHEMA, "id", 8).append(
        rows(spark, [("b", 3), ("c", 3), ("e", 3), ("e", 4), (None, 5)])
    )
    assert commit.rows == 1
    got = sorted(map(tuple, made.read().collect()))
    assert got == [("a", 1), ("b", 1), ("c", 2), ("d", 2), ("e", 3)]
    # What the overtaken job had staged first is gone.
    assert len(names_in(spark, f"{made.path}/data")) == 3


@pytest.mark.parametrize("limit", [1 << 20, 200])
def test_fresh_keys_equal_the_anti_join(spark, limit):
    draw = random.Random(4)
    made = table(spark)
    for _ in range(4):
        keys = {str(draw.randrange(3000)) for _ in range(150)}
        made.append(rows(spark, [(key, 1) for key in keys]))
    asked = [(str(draw.randrange(4000)), 2) for _ in range(400)] + [(None, 3), (None, 4), ("", 5)]
    asked = rows(spark, asked + asked[:30])
    want = unpredicted(asked, made.read()).groupBy("id").count().collect()
    with Scratch(spark) as scratch:
        fresh = made.fresh_keys(asked, scratch, limit)
        got = fresh.keys.collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
        assert fresh.rows == len(want)


def test_files_that_cannot_hold_a_key_are_not_opened(spark):
    made = table(spark)
    for day in range(5):
        made.append(rows(spark, [(f"{day}{i:04d}", day) for i in range(400)]))
    every = {path for path in made.read().inputFiles()}
    with Scratch(spark) as scratch:
        key = spark.createDataFrame([("30017",)], "id string")
        found = made.rows_of(key, scratch)
        assert [tuple(row) for row in found.collect()] == [("30017", 3)]
        files = {path for path in found.inputFiles() if made.path in path}
        assert files < every and len({path.rsplit("/", 1)[0] for path in files}) == 1
        # Outside all ranges, and inside but ruled out by the filter.
        for absent in ("9", "30017x"):
            nothing = made.rows_of(spark.createDataFrame([(absent,)], "id string"), scratch)
            assert nothing.count() == 0 and not nothing.inputFiles()
        many = spark.createDataFrame([(f"2{i:04d}",) for i in range(0, 400, 7)], "id string")
        plan = made.rows_of(many, scratch)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_commits_are_listed_now_and_then(spark, monkeypatch):
    monkeypatch.setattr(result_table, "SUMMARY", 3)
    made = table(spark)
    for i in range(7):
        made.append(rows(spark, [(f"k{i}", i)]))
    reads = []
    read = result_table.read_small
    monkeypatch.setattr(
        result_table, "read_small", lambda spark, path: reads.append(path) or read(spark, path)
    )
    again = ResultTable(spark, made.path, SCHEMA, "id", 8)
    assert again.read().count() == 7 and len(reads) == 2
    assert again.read().count() == 7 and len(reads) == 2


def test_empty_rows_and_folders_without_a_commit(spark):
    made = table(spark)
    assert made.read().count() == 0 and made.append(rows(spark, [])).rows == 0
    assert made.log.version == 0
    assert made.append(rows(spark, []), batch="b#1").rows == 0 and made.has_batch("b#1")
    made.append(rows(spark, [("a", 1)]))
    made._stage(rows(spark, [("z", 1)]), None)
    assert made.clean() == [] and len(made.clean(0)) == 1
    assert made.read().count() == 1


def texts(spark, count=12):
    return spark.createDataFrame(
        [(str(i), f"text number {i} " + "word " * (i % 4) * 4) for i in range(count)],
        "id string, text string",
    ).select("id", F.expr("timestamp'2024-01-01'").alias("created_at"), "text")


def test_short_rows_are_cleaned_once(spark):
    results = prediction_table(spark, new_path(spark, "results"))
    skipped = skipped_table(spark, new_path(spark, "skipped"))
    score = lambda df: df.withColumn("prediction", F.lit("en")).withColumn("label", F.lit("en"))
    run = lambda **options: predict_into(results, texts(spark), score, skipped=skipped, **options)
    first = run()
    assert (first.rows, first.cleaned, first.short) == (9, 12, 3)
    again = run()
    assert (again.rows, again.cleaned, again.short) == (0, 0, 0)
    lower = run(length=5)
    assert (lower.rows, lower.cleaned, lower.short) == (3, 3, 0)
    assert results.read().count() == 12


def test_a_replayed_batch_is_known_by_its_name(spark, tmp_path):
    path, checkpoint = f"{tmp_path}/texts", f"{tmp_path}/checkpoint"
    source = texts(spark)
    source.write.parquet(path)
    results = prediction_table(spark, new_path(spark, "results"))
    scored = []

    def score(df):
        scored.append(1)
        return df.withColumn("prediction", F.lit("en")).withColumn("label", F.lit(None))

    stream = stream_texts(spark, path, source.schema)
    predict_stream_into(stream, results, checkpoint, score).awaitTermination()
    assert results.read().count() == 9 and scored == [1]
    # The batch is committed in the table but not in the checkpoint: the stream runs it again.
    for name in (tmp_path / "checkpoint" / "commits").iterdir():
        name.unlink()
    predict_stream_into(stream, results, checkpoint, score).awaitTermination()
    assert results.read().count() == 9 and scored == [1]
    assert predict_into(results, source, score, batch=f"{checkpoint}#0").rows == 0 and scored == [1]
    # Rows that came by another batch are left out by their keys.
    assert predict_into(results, source, score, batch="other#0").rows == 0
