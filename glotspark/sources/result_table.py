"""A keyed result table that several jobs append to, in Parquet files with a log of commits.

::

    <path>/log/00000000000000000003.json   one commit: which files belong to the table since
    <path>/data/folder=<name>/bucket=7/    rows of that commit, by a hash of their key
    <path>/index/folder=<name>/bucket=7/   a Bloom filter over the keys of that bucket

A job writes its rows and their index under a new name, then creates the next numbered commit. Only one
job can create a number. The others look whether what has been committed since holds keys of theirs,
leave those out, and try the next number. So a key has one row, and readers see whole commits only.

A commit lists, per bucket, the number of rows and the least and the greatest key. Looking for keys opens
no files but those of buckets and key ranges that some asked key falls in, and then only those whose
Bloom filter does not rule all asked keys out. Asked keys are sent to the files; rows of the table are
never shuffled, so that a run costs what it asks for, not what the table has grown to.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glotspark.functions.storage import (
    BROADCAST_BYTES,
    Scratch,
    changed_at,
    create_once,
    delete_path,
    names_in,
    read_small,
)
from glotspark.operators.incremental import (
    ROW_BYTES,
    FreshKeys,
    measured,
    one_per_key,
    only_fresh,
)

BUCKETS = 64

# Bits of a Bloom filter per key, and hashes of a key: about one in 2,000 other keys passes.
BITS = 16
HASHES = 6

# Every so many commits one lists all before it, so that few have to be read.
SUMMARY = 50


@dataclass(frozen=True)
class Part:
    """One bucket of one commit."""

    folder: str
    bucket: int
    rows: int
    low: str
    high: str
    bits: int


@dataclass(frozen=True)
class Commit:
    """Rows that came into the table together. ``batch`` names the piece of a stream they come from."""

    folder: str
    bits: int
    parts: list[list] = field(default_factory=list)  # [bucket, rows, low, high]
    batch: str | None = None

    def files(self) -> list[Part]:
        return [Part(self.folder, *part, self.bits) for part in self.parts]

    @property
    def rows(self) -> int:
        return sum(part[1] for part in self.parts)


class Log:
    """The numbered commits of a table, read once each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.version = 0
        self.commits: list[Commit] = []

    def refresh(self) -> list[Commit]:
        """All commits; reads those made since the last call."""
        names = names_in(self.spark, self.path)
        versions = [int(name[:-5]) for name in names if name.endswith(".json") and name[0] != "."]
        new = [version for version in versions if version > self.version]
        # The newest one that lists all commits before it is a good place to start from.
        listed = [version for version in new if version % SUMMARY == 0]
        if listed:
            new = [version for version in new if version >= listed[-1]]
        for version in new:
            found = json.loads(read_small(self.spark, self._file(version)))
            if "before" in found:
                self.commits = [Commit(**each) for each in found["before"]]
            self.commits.append(Commit(**found["commit"]))
            self.version = version
        return self.commits

    def create(self, commit: Commit) -> bool:
        """Make ``commit`` the next one; False where another job has been first."""
        version = self.version + 1
        content: dict = {"commit": vars(commit)}
        if version % SUMMARY == 0:
            content["before"] = [vars(each) for each in self.commits]
        if not create_once(self.spark, self._file(version), json.dumps(content)):
            return False
        self.version = version
        self.commits.append(commit)
        return True

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:020d}.json"


class ResultTable:
    """Rows of ``schema`` with one row per ``key``, a string column without nulls."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.buckets = key, buckets
        self.log = Log(spark, f"{self.path}/log")

    # ---- reading ----

    def read(self) -> DataFrame:
        """All committed rows; those of jobs that are still at work are not seen."""
        return self._rows(self.log.refresh())

    def has_batch(self, batch: str) -> bool:
        """Whether the rows of a piece of a stream have been committed; no rows are read."""
        return any(commit.batch == batch for commit in self.log.refresh())

    def _rows(self, commits: Sequence[Commit]) -> DataFrame:
        return self._read([self._folder("data", each.folder) for each in commits if each.parts])

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return rows.parquet(*paths).select(*self.schema.names)

    def _folder(self, kind: str, folder: str) -> str:
        return f"{self.path}/{kind}/folder={folder}"

    # ---- looking for keys ----

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _places(self, bits: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(self.key, F.lit(i)), bits) for i in range(HASHES)])

    def candidates(self, asked: DataFrame, commits: Sequence[Commit], scratch: Scratch) -> DataFrame:
        """``(key, folder, bucket)``: where the ``(key, bucket)`` asked for may stand."""
        ranges = {
            row["bucket"]: (row["low"], row["high"])
            for row in asked.groupBy("bucket")
            .agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"))
            .collect()  # at most one row per bucket
        }
        parts = [
            part
            for commit in commits
            for part in commit.files()
            if part.bucket in ranges
            and part.low <= ranges[part.bucket][1]
            and ranges[part.bucket][0] <= part.high
        ]
        schema = f"{self.key} string, folder string, bucket int"
        if not parts:
            return self.spark.createDataFrame([], schema)
        spans = self.spark.createDataFrame(
            [(part.folder, part.bucket, part.low, part.high, part.bits) for part in parts],
            "folder string, bucket int, low string, high string, bits long",
        )
        schema = "word long, set long, folder string, bucket int"
        filters = self.spark.read.schema(schema).option("basePath", f"{self.path}/index").parquet(
            *[f"{self._folder('index', part.folder)}/bucket={part.bucket}" for part in parts]
        )
        # What commits tell of their parts is sent to the keys, a few bytes per file.
        inside = asked.join(F.broadcast(spans), "bucket").filter(
            F.col(self.key).between(F.col("low"), F.col("high"))
        )
        places = inside.select(
            self.key, "folder", "bucket", F.explode(self._places(F.col("bits"))).alias("place")
        )
        words = filters.select("folder", "bucket", "word", "set")
        set_bits = places.withColumn("word", F.shiftright("place", 6)).join(
            words, ["folder", "bucket", "word"]
        ).filter(F.getbit("set", F.pmod("place", F.lit(64)).cast("int")) == 1)
        return scratch.table(
            set_bits.groupBy(self.key, "folder", "bucket")
            .agg(F.count("*").alias("hits"))
            .filter(F.col("hits") == HASHES)
            .select(self.key, "folder", "bucket"),
            "candidates",
        )

    def present(
        self,
        keys: DataFrame,
        scratch: Scratch,
        commits: Sequence[Commit] | None = None,
        limit: int = BROADCAST_BYTES,
    ) -> DataFrame:
        """``(key)``: which of the distinct ``keys`` the table, or some of its commits, hold."""
        return self.rows_of(keys, scratch, commits, limit).select(self.key)

    def rows_of(
        self,
        keys: DataFrame,
        scratch: Scratch,
        commits: Sequence[Commit] | None = None,
        limit: int = BROADCAST_BYTES,
    ) -> DataFrame:
        """The rows of the distinct ``keys``, from the files that may hold some of them."""
        commits = self.log.refresh() if commits is None else commits
        asked = keys.select(F.col(self.key), self.bucket().alias("bucket"))
        found = self.candidates(asked, commits, scratch)
        files = sorted(map(tuple, found.select("folder", "bucket").distinct().collect()))
        if not files:
            return self._read([])
        size = F.octet_length(self.key) + F.lit(ROW_BYTES)
        # A key that several folders may hold is sent, and counted, once for each: no shuffle finds the
        # few that are. Keys beyond the limit go in slices, each to the files of some buckets.
        nbytes = found.agg(F.sum(size)).first()[0]
        slices = max(1, -(-nbytes // limit))
        rows = []
        for number in range(slices):
            paths = [
                f"{self._folder('data', folder)}/bucket={bucket}"
                for folder, bucket in files
                if bucket % slices == number
            ]
            if paths:
                mine = found.filter(F.pmod("bucket", F.lit(slices)) == number).select(self.key)
                rows.append(self._read(paths).join(F.broadcast(mine), self.key, "left_semi"))
        return reduce(DataFrame.union, rows)

    def fresh_keys(
        self, rows: DataFrame, scratch: Scratch, limit: int = BROADCAST_BYTES
    ) -> FreshKeys:
        """The keys of ``rows`` that the table does not hold; null keys are among them."""
        counted = scratch.table(
            rows.groupBy(self.key).agg(F.count("*").alias("copies")), "keys"
        )
        asked = counted.filter(F.col(self.key).isNotNull())
        held = scratch.table(self.present(asked, scratch, limit=limit), "present")
        return measured(
            scratch.table(counted.join(held, self.key, "left_anti"), "fresh"), self.key
        )

    # ---- appending ----

    def append(self, rows: DataFrame, batch: str | None = None) -> Commit | None:
        """Add the rows whose key the table does not hold, of rows with the same key the least.

        Safe with other jobs that append at the same time. Rows without a key are left out. Returns
        the commit; None where ``batch`` has been committed before, by this job or by another one.
        """
        with Scratch(self.spark) as scratch:
            rows = rows.select(*self.schema.names).filter(F.col(self.key).isNotNull())
            seen = list(self.log.refresh())
            fresh = self.fresh_keys(rows, scratch)
            chosen = one_per_key(only_fresh(rows, fresh, self.key), fresh, self.key)
            staged = scratch.table(chosen, "staged")
            commit = None
            while True:
                now = list(self.log.refresh())
                if batch is not None and any(each.batch == batch for each in now):
                    self._discard(commit)
                    return None
                # Only what has been committed since the last look can hold keys of these rows.
                new, seen = now[len(seen) :], now
                held = scratch.table(
                    self.present(staged.select(self.key), scratch, new), "present"
                )
                taken = held.limit(1).count() > 0
                if taken:
                    staged = scratch.table(staged.join(held, self.key, "left_anti"), "staged")
                if commit is None or taken:
                    self._discard(commit)
                    commit = self._stage(staged, batch)
                if (batch is None and not commit.parts) or self.log.create(commit):
                    return commit

    def _stage(self, rows: DataFrame, batch: str | None) -> Commit:
        """Write rows and index of a commit that nobody sees yet."""
        folder = uuid.uuid4().hex
        dealt = rows.withColumn("bucket", self.bucket())
        counts = (
            dealt.groupBy("bucket")
            .agg(F.count("*"), F.min(self.key), F.max(self.key))
            .orderBy("bucket")
            .collect()  # at most one row per bucket
        )
        parts = [list(row) for row in counts]
        bits = 64 * max(1, -(-BITS * max((part[1] for part in parts), default=0) // 64))
        if parts:
            # A hot bucket is a bucket of many keys: files of a bucket come from several tasks.
            dealt.write.partitionBy("bucket").parquet(self._folder("data", folder))
            places = dealt.select("bucket", F.explode(self._places(F.lit(bits))).alias("place"))
            words = places.groupBy("bucket", F.shiftright("place", 6).alias("word")).agg(
                F.bit_or(
                    F.call_function(
                        "shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int")
                    )
                ).alias("set")
            )
            words.write.partitionBy("bucket").parquet(self._folder("index", folder))
        return Commit(folder, bits, parts, batch)

    def _discard(self, commit: Commit | None) -> None:
        if commit is not None and commit.parts:
            for kind in ("data", "index"):
                delete_path(self.spark, self._folder(kind, commit.folder))

    def clean(self, older_than_seconds: float = 86_400.0) -> list[str]:
        """Remove folders that no commit lists, of jobs that have ended without one, once they are old
        enough that no job can still be at work on them. Returns their names."""
        known = {f"folder={commit.folder}" for commit in self.log.refresh()}
        removed = []
        for name in names_in(self.spark, f"{self.path}/data"):
            path = f"{self.path}/data/{name}"
            if name not in known and time.time() - changed_at(self.spark, path) >= older_than_seconds:
                delete_path(self.spark, path)
                delete_path(self.spark, f"{self.path}/index/{name}")
                removed.append(name)
        return removed
