"""Reading from and appending to a SQL database over JDBC.

The driver class and credentials are plain JDBC properties. A subquery runs inside the database,
so its joins and column choice are pushed down; ``split`` or ``predicates`` make the read parallel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from glotspark import columns as C


def rows_without_match(
    table: str, other: str, key: str = C.ID, columns: Sequence[str] = (C.ID, C.CREATED_AT, C.TEXT)
) -> str:
    """SQL for the rows of ``table`` whose key ``other`` does not hold."""
    wanted = ", ".join(f"source.{column}" for column in columns)
    matching = f"SELECT 1 FROM {other} AS done WHERE done.{key} = source.{key}"
    return f"SELECT {wanted} FROM {table} AS source WHERE NOT EXISTS ({matching})"


@dataclass(frozen=True)
class Split:
    """A numeric, date or timestamp column whose range is read in ``partitions`` slices.

    The bounds only place the slices; rows outside them are read by the first and the last.
    """

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class JdbcDatabase:
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self, table: str, split: Split | None = None) -> dict[str, str]:
        options = {**self.properties, "url": self.url, "dbtable": table}
        if split:
            options |= {
                "partitionColumn": split.column,
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.partitions),
            }
        return options

    def table(self, spark: SparkSession, name: str, split: Split | None = None) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(name, split)).load()

    def query(
        self, spark: SparkSession, sql: str, alias: str = "texts", split: Split | None = None
    ) -> DataFrame:
        return self.table(spark, subquery(sql, alias), split)

    def query_by_predicates(
        self, spark: SparkSession, sql: str, predicates: Sequence[str], alias: str = "texts"
    ) -> DataFrame:
        """One partition per predicate, for keys that have no numeric range."""
        return spark.read.jdbc(
            self.url,
            subquery(sql, alias),
            predicates=list(predicates),
            properties=dict(self.properties),
        )

    def unpredicted(
        self,
        spark: SparkSession,
        texts: str = "tweets",
        predicted: str = "predicted_tweets",
        split: Split | None = None,
    ) -> DataFrame:
        """Rows without a prediction, by an anti join inside the database."""
        return self.query(spark, rows_without_match(texts, predicted), split=split)

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").format("jdbc").options(**self.options(table)).save()


def subquery(sql: str, alias: str) -> str:
    return f"({sql}) AS {alias}"
