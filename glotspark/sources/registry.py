"""A versioned model registry: name -> digest -> saved pipeline.

``<root>/lookup`` is an append-only Parquet table, cut by a hash of the name, so that looking up a name
reads one part of it; ``<root>/blob/<digest>`` is a saved model, ``<root>/sums/<digest>`` the sums that it
was fitted from, where they are kept. Equal models share a digest and are stored once. A model is loaded
only if what has been read has the digest that the lookup names.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glotspark.functions.storage import names_in, read_or_empty
from glotspark.operators.classifier import GramClassifier
from glotspark.operators.gram_model import load_gram_model
from glotspark.operators.increments import Sums, load_sums

# Parts of the lookup.
PARTS = 32

LOOKUP_SCHEMA = T.StructType(
    [
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("digest", T.StringType(), False),
        T.StructField("spark_version", T.StringType(), True),
    ]
)


class AlteredModelError(ValueError):
    """What is stored under a digest has another one."""


def latest_versions(lookup: DataFrame) -> DataFrame:
    """``(name, created_at, digest)`` of the newest entry of every name."""
    newest = F.max(F.struct("created_at", "digest")).alias("newest")
    return lookup.groupBy("name").agg(newest).select("name", "newest.*")


def model_digest(model: PipelineModel) -> str:
    """SHA-1 over what a model computes; paths, times and stage ids do not enter it."""
    digest = hashlib.sha1()
    for stage in model.stages:
        params = {
            param.name: value
            for param, value in stage.extractParamMap().items()
            if not param.name.startswith("uid") and param.name != "modelPath"
        }
        text = json.dumps(params, sort_keys=True, default=str)
        digest.update(f"{type(stage).__name__}{text}\n".encode())
        for name in ("pi", "theta"):
            if hasattr(stage, name):
                numbers = np.round(getattr(stage, name).toArray(), 12) + 0.0
                digest.update(numbers.astype("<f8").tobytes())
        if isinstance(stage, GramClassifier):
            digest.update(_table_digest(stage).encode())
    return digest.hexdigest()


def _table_digest(stage: GramClassifier) -> str:
    """What a stored gram model holds, whatever the order and the files of its rows."""
    spark = SparkSession.builder.getOrCreate()
    model = load_gram_model(spark, stage.getModelPath())
    table = model.table(spark)
    rows = table.select(F.xxhash64(*table.columns).cast("decimal(38,0)").alias("row"))
    total = rows.agg(F.sum("row"), F.count("*")).first()
    header = (model.sizes, model.classes, model.intercepts, model.unknown)
    return f"{header} {tuple(total)}"


def part_of(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(PARTS)).cast("int")


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def lookup(self) -> DataFrame:
        """All entries; none where nothing has been saved yet."""
        schema = T.StructType([*LOOKUP_SCHEMA.fields, T.StructField("part", T.IntegerType())])
        return read_or_empty(self.spark, f"{self.root}/lookup", schema)

    def entries_of(self, name: str) -> DataFrame:
        """The entries of one name, from its part of the lookup."""
        part = part_of(F.lit(name))
        return self.lookup().filter((F.col("part") == part) & (F.col("name") == name))

    def add_entries(self, entries: DataFrame) -> None:
        rows = entries.select(*LOOKUP_SCHEMA.fieldNames(), part_of(F.col("name")).alias("part"))
        rows.write.mode("append").partitionBy("part").parquet(f"{self.root}/lookup")

    def blob_path(self, digest: str) -> str:
        return f"{self.root}/blob/{digest}"

    def sums_path(self, digest: str) -> str:
        return f"{self.root}/sums/{digest}"

    def save(
        self,
        name: str,
        model: PipelineModel,
        created_at: datetime | None = None,
        sums: Sums | None = None,
    ) -> str:
        """Store the model, then its entry: a name never points at a model that is not there.

        ``sums`` are what the model was fitted from; with them it can learn more later.
        """
        digest = model_digest(model)
        if sums is not None and not names_in(self.spark, self.sums_path(digest)):
            sums.save(self.sums_path(digest))
        stored = self.lookup().filter(F.col("digest") == digest).limit(1).count()
        if not stored:
            model.write().overwrite().save(self.blob_path(digest))
            for place, stage in self._gram_stages(model):
                load_gram_model(self.spark, stage.getModelPath()).copy_to(
                    self.spark, self._gram_path(digest, place)
                )
        entry = self.spark.range(1).select(
            (F.lit(created_at) if created_at else F.current_timestamp()).alias("created_at"),
            F.lit(name).alias("name"),
            F.lit(digest).alias("digest"),
            F.lit(self.spark.version).alias("spark_version"),
        )
        self.add_entries(entry.coalesce(1))
        return digest

    def latest(self, name: str) -> str:
        """The newest digest of a name; ``KeyError`` for a name that was never saved."""
        newest = (
            self.entries_of(name)
            .orderBy(F.desc("created_at"), F.desc("digest"))
            .limit(1)
            .collect()
        )
        if not newest:
            raise KeyError(name)
        return newest[0].digest

    def load(self, name: str) -> PipelineModel:
        """The newest model of a name; ``AlteredModelError`` where it isn't what has been saved."""
        digest = self.latest(name)
        model = PipelineModel.load(self.blob_path(digest))
        for place, stage in self._gram_stages(model):
            stage.setModelPath(self._gram_path(digest, place))
        found = model_digest(model)
        if found != digest:
            raise AlteredModelError(f"{self.blob_path(digest)} has the digest {found}")
        return model

    def load_sums(self, name: str) -> Sums:
        """The sums that the newest model of a name was fitted from."""
        return load_sums(self.spark, self.sums_path(self.latest(name)))

    def _gram_path(self, digest: str, place: int) -> str:
        """Where the weight table of a stage is kept: inside the blob, not where it was made."""
        return f"{self.blob_path(digest)}/grams/{place}"

    @staticmethod
    def _gram_stages(model: PipelineModel) -> list[tuple[int, GramClassifier]]:
        return [
            (place, stage)
            for place, stage in enumerate(model.stages)
            if isinstance(stage, GramClassifier)
        ]
