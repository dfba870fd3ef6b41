"""Folders for tables that a job writes and reads back."""

import atexit
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_folders: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; in local mode without one, a folder removed when Python ends."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="rentlens-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_folder`` named, wherever the shared folder is."""
    root = shared_root(spark).rstrip("/") + "/"
    if not path.startswith(root) or ".." in path:
        raise ValueError(f"{path} is not in the scratch folder")
    delete_folder(spark.sparkContext, path)


def delete_folder(sc: SparkContext, path: str) -> None:
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: a cut of the lineage that survives lost executors."""
    folder = new_folder(df.sparkSession, label)
    _folders.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def clear(spark: SparkSession) -> int:
    """Delete the tables that ``stored`` wrote in this process; results that still read them must be stored elsewhere first."""
    n = len(_folders)
    while _folders:
        remove_folder(spark, _folders.pop())
    return n


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(new_folder(spark, "checkpoints"))
