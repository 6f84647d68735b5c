"""Incremental scoring as a stream over a growing folder of Parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from glotspark.functions.storage import Scratch
from glotspark.operators.incremental import fresh_keys, only_fresh
from glotspark.plans.jobs import predict_into
from glotspark.sources.predictions import append_predictions, read_predictions, valid_rows
from glotspark.sources.result_table import ResultTable


def stream_texts(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def predict_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Score what has arrived since the last run, append it to ``path``, and stop.

    ``score`` maps ``(id, created_at, text)`` rows to result rows. The checkpoint keeps files from
    being read twice; the anti join in each batch keeps a batch that is run again after a failure,
    or a row that arrives twice, from being appended twice. Of rows that share an id one that
    ``score`` returns is kept. A batch is written once, read from there, and removed with all that
    was made from it when its rows are appended.
    """

    def append(batch: DataFrame, _: int) -> None:
        with Scratch(batch.sparkSession) as scratch:
            rows = scratch.table(valid_rows(batch), "batch")
            fresh = fresh_keys(rows, read_predictions(rows.sparkSession, path), scratch)
            scored = scratch.table(score(only_fresh(rows, fresh)), "scored")
            append_predictions(scored, path)

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def predict_stream_into(
    stream: DataFrame,
    table: ResultTable,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame],
    skipped: ResultTable | None = None,
) -> StreamingQuery:
    """As ``predict_stream``, into a table that other jobs may append to at the same time.

    The number of a batch goes into its commit, with the checkpoint's name. A batch that is run again
    after its rows were committed is known by that: nothing of it is read or scored. ``score`` maps
    cleaned rows to result rows.
    """

    def append(batch: DataFrame, number: int) -> None:
        name = f"{checkpoint}#{number}"
        if not table.has_batch(name):
            with Scratch(batch.sparkSession) as scratch:
                rows = scratch.table(batch, "batch")
                predict_into(table, rows, score, skipped=skipped, batch=name)

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
