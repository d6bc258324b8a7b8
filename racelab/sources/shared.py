"""Folders that all executors see, for tables and files between jobs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; those of a session are removed as it ends.

    Without that setting a local session has one below its temporary folder, removed as Python ends; any other fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return f"{_local_folder()}/{uuid.uuid4().hex}"
    return f"{_session_folder(spark, root.rstrip('/'))}/{uuid.uuid4().hex}"


_SESSION_FOLDERS: dict[tuple[str, str], str] = {}


def _session_folder(spark: SparkSession, root: str) -> str:
    """The folder of this application below ``root``, which Hadoop's file system removes as the driver's JVM ends."""
    key = spark.sparkContext.applicationId, root
    if key not in _SESSION_FOLDERS:
        folder = f"{root}/racelab-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _SESSION_FOLDERS[key] = folder
    return _SESSION_FOLDERS[key]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage and survives a lost executor."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    path = tempfile.mkdtemp(prefix="racelab-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def renamed(spark: SparkSession, source: str, target: str) -> None:
    """``source`` in place of ``target``, which must not exist yet."""
    at, files = _file_system(spark, source)
    to, _ = _file_system(spark, target)
    if files.exists(to) or not files.rename(at, to):
        raise FileExistsError(target)


def removed(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    files.delete(at, True)
