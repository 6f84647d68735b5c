"""Text tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glotspark import columns as C


def read_texts(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """A Parquet table of texts; only the named columns are read."""
    return spark.read.parquet(path).select(*(columns or (C.TEXT,)))


def query_texts(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A subquery as a source, over catalog tables or the given frames (``{name}`` in the SQL)."""
    return spark.sql(sql, **tables)


def inline_texts(spark: SparkSession, texts: Iterable[str]) -> DataFrame:
    """Texts typed in by hand, ready for scoring: one non-null column, no cleaning."""
    return spark.createDataFrame([(text,) for text in texts], f"{C.FILTERED} string not null")


def given_texts(df: DataFrame, text: str = C.TEXT) -> DataFrame:
    """The same for texts that already are a table, of any size."""
    return df.select(F.col(text).alias(C.FILTERED))
