"""The result table of the scoring jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glotspark import columns as C
from glotspark.functions.storage import Scratch, read_or_empty
from glotspark.operators.incremental import fresh_keys, one_per_key, only_fresh

from .result_table import ResultTable

PREDICTED_SCHEMA = T.StructType(
    [
        T.StructField(C.ID, T.StringType(), False),
        T.StructField(C.CREATED_AT, T.TimestampType(), False),
        T.StructField(C.TEXT, T.StringType(), False),
        T.StructField(C.PREDICTION, T.StringType(), False),
        T.StructField(C.LABEL, T.StringType(), True),
    ]
)

RESULT_COLUMNS = PREDICTED_SCHEMA.fieldNames()
NOT_NULL = [field.name for field in PREDICTED_SCHEMA if not field.nullable]


def lacks_value(df: DataFrame):
    """Whether a row holds a null in a column that the result table wants a value in."""
    return reduce(
        lambda one, other: one | other,
        [F.col(name).isNull() for name in df.columns if name in NOT_NULL],
        F.lit(False),
    )


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(~lacks_value(df))


def count_rejected(df: DataFrame) -> int:
    """Rows that can't enter the result table."""
    return df.filter(lacks_value(df)).count()


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, PREDICTED_SCHEMA)


def create_prediction_table(spark: SparkSession, name: str, location: str) -> None:
    """A catalog table over the Parquet folder that the jobs append to."""
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in PREDICTED_SCHEMA
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'")


def prediction_table(spark: SparkSession, path: str) -> ResultTable:
    """A result table that several jobs may append to; ``append_predictions`` is for one at a time."""
    return ResultTable(spark, path, PREDICTED_SCHEMA, C.ID)


# Rows that had too few characters after cleaning, and how many they had.
SKIPPED_SCHEMA = T.StructType(
    [T.StructField(C.ID, T.StringType(), False), T.StructField("length", T.IntegerType(), False)]
)


def skipped_table(spark: SparkSession, path: str) -> ResultTable:
    """The ledger of keys that have been found too short, with the longest of their rows."""
    return ResultTable(spark, path, SKIPPED_SCHEMA, C.ID)


def append_predictions(df: DataFrame, path: str) -> int:
    """Append rows whose key the table does not hold yet, one per key; returns how many rows have
    been rejected for a null in a column that must have a value.

    Parquet has no primary key; this check stands in for it, for one writer at a time.
    """
    rejected = count_rejected(df)
    rows = valid_rows(df)
    with Scratch(df.sparkSession) as scratch:
        fresh = fresh_keys(rows, read_predictions(df.sparkSession, path), scratch)
        append_rows(one_per_key(only_fresh(rows, fresh), fresh), path)
    return rejected


def append_rows(df: DataFrame, path: str) -> None:
    """Append without a key check, for rows that come out of the anti join already. Rows with a
    null where a value must be are left out."""
    valid_rows(df.select(*RESULT_COLUMNS)).write.mode("append").parquet(path)
