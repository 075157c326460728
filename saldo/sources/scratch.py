"""Shared folder for what a job writes on the way."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_passing: list[str] = []


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="saldo-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only for local sessions without one."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise ValueError(f"set {_SETTING} to a folder all executors reach")


def new_folder(spark: SparkSession, name: str, *, keep: bool = False) -> str:
    """Name of a fresh folder; without `keep`, `discard` removes it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not keep:
        _passing.append(path)
    return path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it back: the work behind it runs once."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Removes the passing folders of this process; frames settled there end with them."""
    while _passing:
        remove(spark, _passing.pop())


def located(spark: SparkSession, path: str):
    """(Hadoop path, its file system) of a path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    at, store = located(spark, path)
    store.delete(at, True)


def _entries(spark: SparkSession, path: str, folders: bool) -> list[tuple[int, str]]:
    """(time in ms, path) of what lies in a folder, the last written first."""
    at, store = located(spark, path)
    if not store.exists(at):
        return []
    found = [(s.getModificationTime(), s.getPath().toString())
             for s in store.listStatus(at) if s.isDirectory() == folders]
    return sorted(found, reverse=True)


def folders_in(spark: SparkSession, path: str, *, times: bool = False) -> list:
    """Folders in a folder, the last written first; with `times`, as (time in ms, path)."""
    return [(t, p) if times else p for t, p in _entries(spark, path, True)]


def files_in(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    return _entries(spark, path, False)
