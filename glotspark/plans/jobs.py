"""The jobs: learn, predict new rows, both in one, score given texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions import clean
from glotspark.functions.storage import Scratch
from glotspark.operators.clean import clean_text, prepare
from glotspark.operators.features import apply_pipeline, reads_twice
from glotspark.operators.incremental import (
    FreshKeys,
    fresh_keys,
    measured,
    one_per_key,
    only_fresh,
)
from glotspark.operators.increments import fit_sums, stored, sums_of
from glotspark.operators.tuning import FOLDS, GRID, Tuned, text_fold, tune
from glotspark.sources.predictions import (
    RESULT_COLUMNS,
    append_rows,
    count_rejected,
    read_predictions,
    valid_rows,
)
from glotspark.sources.registry import ModelRegistry
from glotspark.sources.result_table import ResultTable

Labeler = Callable[[DataFrame], DataFrame]


def learn(
    texts: DataFrame,
    labeler: Labeler,
    grid: Sequence[tuple[int, int]] = GRID,
    folds: int = FOLDS,
    fold: Column | None = None,
    length: int = C.MIN_TEXT_LENGTH,
    parallelism: int = 4,
) -> Tuned:
    """Clean, filter and label ``texts``, search the grid, and fit the best model on all rows."""
    prepared = prepare(texts, length, labeler)
    fold = fold if fold is not None else text_fold(F.col(C.FILTERED), folds)
    return tune(prepared, fold, grid, folds, parallelism)


def learn_from(
    texts: DataFrame,
    labeler: Labeler,
    registry: ModelRegistry,
    name: str,
    point: tuple[int, int],
    fold: Column | None = None,
    length: int = C.MIN_TEXT_LENGTH,
) -> str:
    """Learn from ``texts`` in addition to all that the registry's model of this name has learnt from.

    Only the given texts are read; what the model knows of earlier ones are the sums kept with it. The
    first call starts the model. ``point`` is the grid point to fit, such as that of an earlier search.
    Returns the digest, that of one fit on all texts together.
    """
    spark = texts.sparkSession
    fold = fold if fold is not None else text_fold(F.col(C.FILTERED), FOLDS)
    with Scratch(spark) as scratch:
        prepared = scratch.table(prepare(texts, length, labeler), "prepared")
        sums = sums_of(prepared, fold, scratch)
        if registry.entries_of(name).limit(1).count():
            sums = sums.plus(registry.load_sums(name))
        sums = stored(sums, spark)
        return registry.save(name, fit_sums(spark, sums, point), sums=sums)


def predict_new(
    rows: DataFrame,
    predicted: DataFrame,
    model: Transformer,
    labeler: Labeler | None,
    length: int = C.MIN_TEXT_LENGTH,
    check_keys: bool = True,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``(id, created_at, text, prediction, label)`` of the rows not predicted before.

    ``text`` is the original. Rows that are too short after cleaning are left out, so they are
    looked at again in the next run; ``count_short`` tells how many. Of rows that share an id one
    is kept, chosen among those that are long enough. Rows with a null in a column that the result
    wants a value in are left out; ``count_rejected`` tells how many. ``check_keys=False`` is for
    sources with a primary key.
    """
    scratch = scratch or Scratch(rows.sparkSession).until_exit()
    rows = valid_rows(rows)
    fresh = fresh_keys(rows, predicted, scratch)
    prepared = prepare(only_fresh(rows, fresh), length)
    if check_keys:
        prepared = one_per_key(prepared, fresh)
    labeled = labeler(prepared) if labeler else with_no_label(prepared)
    if reads_twice(model):
        # Cleaned and labelled once, whatever reads the texts after.
        kept = [C.ID, C.CREATED_AT, C.TEXT, C.FILTERED, C.LABEL]
        labeled = scratch.table(labeled.select(*kept), "labeled")
    return apply_pipeline(model, labeled, scratch).select(*RESULT_COLUMNS)


def with_no_label(df: DataFrame) -> DataFrame:
    return df.withColumn(C.LABEL, F.lit(None).cast("string"))


def count_short(rows: DataFrame, length: int = C.MIN_TEXT_LENGTH) -> int:
    short = F.coalesce(F.length(clean(F.col(C.TEXT))), F.lit(0)) < length
    return rows.filter(short).count()


def predict_job(
    rows: DataFrame,
    path: str | None,
    model: Transformer,
    labeler: Labeler | None,
    read: Callable[[], DataFrame] | None = None,
    write: Callable[[DataFrame], None] | None = None,
    **options,
) -> int:
    """Score the rows that the result table does not hold yet and append them.

    The table is the Parquet folder ``path``, or whatever ``read`` returns and ``write`` appends
    to, such as a table of a ``JdbcDatabase``. Returns how many rows have been rejected for a null
    in a column that must have a value.
    """
    spark = rows.sparkSession
    known = read() if read else read_predictions(spark, path)
    rejected = count_rejected(rows)
    with Scratch(spark) as scratch:
        scored = predict_new(rows, known, model, labeler, scratch=scratch, **options)
        if write:
            write(valid_rows(scored))
        else:
            append_rows(scored, path)
    return rejected


@dataclass(frozen=True)
class Appended:
    """What a run of ``predict_into`` did: rows that came into the table, rows that were cleaned for it,
    and keys that were found too short."""

    rows: int
    cleaned: int
    short: int


def predict_into(
    table: ResultTable,
    rows: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    length: int = C.MIN_TEXT_LENGTH,
    skipped: ResultTable | None = None,
    batch: str | None = None,
) -> Appended:
    """Score the rows that ``table`` does not hold yet and commit them; safe beside other jobs.

    ``score`` maps cleaned rows to result rows. Keys that ``skipped`` lists with fewer characters than
    ``length`` are not cleaned again, and keys that turn out to be too short now are added to it; a
    smaller ``length`` than theirs looks at them again. A ``batch`` that has been committed before is
    recognised by its name: nothing is read, scored or added.
    """
    spark = rows.sparkSession
    if batch is not None and table.has_batch(batch):
        return Appended(0, 0, 0)
    with Scratch(spark) as scratch:
        rows = valid_rows(rows)
        fresh = table.fresh_keys(rows, scratch)
        if skipped is not None:
            fresh = without_short(fresh, skipped, length, scratch)
        cleaned = scratch.table(clean_text(only_fresh(rows, fresh)), "cleaned")
        size = F.coalesce(F.length(C.FILTERED), F.lit(0))
        usable = one_per_key(cleaned.filter(size >= length), fresh)
        commit = table.append(valid_rows(score(usable).select(*RESULT_COLUMNS)), batch)
        found = 0
        if skipped is not None:
            longest = cleaned.groupBy(C.ID).agg(F.max(size).cast("int").alias("length"))
            short = scratch.table(longest.filter(F.col("length") < length), "short")
            found = short.count()
            if found:
                skipped.append(short)
        return Appended(commit.rows if commit else 0, cleaned.count(), found)


def without_short(
    fresh: FreshKeys, skipped: ResultTable, length: int, scratch: Scratch
) -> FreshKeys:
    """The fresh keys but those that are known to be shorter than ``length``."""
    asked = fresh.keys.filter(F.col(C.ID).isNotNull())
    short = skipped.rows_of(asked, scratch).filter(F.col("length") < length).select(C.ID)
    kept = fresh.keys.join(short, C.ID, "left_anti")
    return measured(scratch.table(kept, "fresh"), C.ID)


@dataclass(frozen=True)
class LearnedAndPredicted:
    tuned: Tuned
    digest: str


def learn_and_predict(
    rows: DataFrame,
    path: str,
    registry: ModelRegistry,
    name: str,
    labeler: Labeler,
    **options,
) -> LearnedAndPredicted:
    """Learn from ``rows``, score them with the model in memory, then save it.

    The predictions come first: they stay if the save fails.
    """
    tuned = learn(rows.select(C.TEXT), labeler, **options)
    predict_job(rows, path, tuned.model, labeler)
    return LearnedAndPredicted(tuned, registry.save(name, tuned.model))


def score_texts(texts: DataFrame, model: Transformer) -> DataFrame:
    """``(filteredText, prediction)`` of given texts: no cleaning and no length filter."""
    usable = texts.filter(F.col(C.FILTERED).isNotNull())
    return apply_pipeline(model, usable).select(C.FILTERED, C.PREDICTION)
