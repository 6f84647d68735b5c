"""Where intermediate tables go, and the one check that guards every broadcast."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# A broadcast side above this many bytes takes another path instead.
BROADCAST_BYTES = 256 * 1024 * 1024

# Names the folder in a session without ``spark.checkpoint.dir``, which can't be set at run time.
LOCAL_FOLDER = "glotspark.scratch.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that the session names; all executors must reach it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_FOLDER, None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return named.rstrip("/")


def use_local_folder(spark: SparkSession) -> None:
    """For entry scripts and tests: a local session that names no shared folder gets a new one.

    Driver and executors of a local session are one process, so any folder is shared. Sessions on
    a cluster are left as they are.
    """
    try:
        shared_dir(spark)
    except RuntimeError:
        master = spark.sparkContext.master
        if master == "local" or master.startswith("local["):
            spark.conf.set(LOCAL_FOLDER, tempfile.mkdtemp(prefix="glotspark-"))


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none where there is no folder."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def changed_at(spark: SparkSession, path: str) -> float:
    """When the newest entry of a folder was made, in seconds."""
    system, target = _file_system(spark, path)
    return max((s.getModificationTime() for s in system.listStatus(target)), default=0) / 1000


def read_small(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    system, target = _file_system(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with all of its text, or return False where it exists already.

    Of several that create the same file at once, one succeeds: the file is written under another
    name first, then gets its own in one step that never replaces another. A local file is linked, on
    other systems it is renamed, which HDFS does in one step.
    """
    system, target = _file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    system.mkdirs(target.getParent())
    if system.getUri().getScheme() == "file":
        own, final = (_file_system(spark, name)[1].toUri().getPath() for name in (draft, path))
        with open(own, "x", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(own, final)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    if system.exists(target):
        return False
    first = _file_system(spark, draft)[1]
    stream = system.create(first, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    done = bool(system.rename(first, target))
    if not done:
        system.delete(first, False)
    return done


class Scratch:
    """Owns the intermediate tables of one job and removes them.

    As a context manager it removes them when the job is done. A query that returns a lazy frame
    over such a table can't know when its reader is done; its tables go when the process ends, or
    with ``clear``.
    """

    _kept: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.clear()

    def until_exit(self) -> Scratch:
        if not Scratch._kept:
            atexit.register(_clear_kept)  # now, so that it runs before the session's own exit hook
        Scratch._kept.append(self)
        return self

    def path(self, name: str) -> str:
        path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        return path

    def table(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Write ``df`` once and read it back.

        Cuts the lineage, survives lost executors, and leaves a columnar table whose later readers
        fetch only the columns they need.
        """
        path = self.path(name)
        df.write.parquet(path, partitionBy=partition_by)
        back = self.spark.read.schema(df.schema).parquet(path)
        back.scratch_path = path
        return back

    def drop(self, df: DataFrame) -> None:
        """Remove a table before the job ends."""
        path = df.scratch_path
        delete_path(self.spark, path)
        self.paths.remove(path)

    def clear(self) -> None:
        while self.paths:
            delete_path(self.spark, self.paths.pop())


def _clear_kept() -> None:
    for scratch in Scratch._kept:
        try:
            scratch.clear()
        except Exception:  # the session may have ended before the process
            continue


def new_path(spark: SparkSession, name: str) -> str:
    return Scratch(spark).until_exit().path(name)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
