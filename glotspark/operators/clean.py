"""Cleaning, the minimum-length filter, and the prepare step shared by all jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark import columns as C
from glotspark.functions import clean
from glotspark.functions.patterns import SAFE_CLEAN_PATTERN


class RegexReplacer(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """ML stage that replaces every match of ``pattern``; ``$1`` refers to a group.

    The body is a built-in expression, so a pipeline holding this stage stays in the JVM, and the
    stage can be saved with the pipeline.
    """

    pattern = Param(Params._dummy(), "pattern", "regular expression", TypeConverters.toString)
    replacement = Param(Params._dummy(), "replacement", "replacement", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, pattern=None, replacement=None):
        super().__init__()
        self._setDefault(pattern="", replacement="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setPattern(self, value: str) -> RegexReplacer:
        return self._set(pattern=value)

    def getPattern(self) -> str:
        return self.getOrDefault(self.pattern)

    def setReplacement(self, value: str) -> RegexReplacer:
        return self._set(replacement=value)

    def getReplacement(self) -> str:
        return self.getOrDefault(self.replacement)

    def setInputCol(self, value: str) -> RegexReplacer:
        return self._set(inputCol=value)

    def setOutputCol(self, value: str) -> RegexReplacer:
        return self._set(outputCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        replaced = F.regexp_replace(
            F.col(self.getInputCol()), self.getPattern(), self.getReplacement()
        )
        return dataset.withColumn(self.getOutputCol(), replaced)


def text_cleaner() -> RegexReplacer:
    """The cleaning step as an ML stage, for pipelines that take raw text."""
    return RegexReplacer(inputCol=C.TEXT, outputCol=C.FILTERED, pattern=SAFE_CLEAN_PATTERN)


def clean_text(df: DataFrame, emoji: str = "range") -> DataFrame:
    return df.withColumn(C.FILTERED, clean(F.col(C.TEXT), emoji))


def min_length(df: DataFrame, length: int = C.MIN_TEXT_LENGTH) -> DataFrame:
    """Keep texts of at least ``length`` code points; null texts drop out here."""
    return df.filter(F.length(C.FILTERED) >= length)


def prepare(
    df: DataFrame,
    length: int = C.MIN_TEXT_LENGTH,
    labeler: Callable[[DataFrame], DataFrame] | None = None,
    emoji: str = "range",
) -> DataFrame:
    """Clean, drop short texts and, with a ``labeler``, add the ``label`` column.

    The cleaned text is generated from a one-element array: a filter on a generated column is not
    pushed below its generator, whereas a filter on a projected one is, and would run the cleaning
    regex a second time for every text.
    """
    cleaned = F.explode(F.array(clean(F.col(C.TEXT), emoji))).alias(C.FILTERED)
    kept = [name for name in df.columns if name != C.FILTERED]
    prepared = df.select(*kept, cleaned).transform(min_length, length)
    return prepared.transform(labeler) if labeler else prepared
