"""Where the library's own files go: the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a
    cluster a folder of one machine would be lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="opsframe-")
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/opsframe/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: a durable cut of the lineage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _files(spark, path)
    return files.exists(found)


def subfolders(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values of the folders ``name=value`` of a folder, in order; none where it is not there."""
    files, found = _files(spark, path)
    listed = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*")) if files.exists(found) else None
    return sorted(s.getPath().getName()[len(name) + 1:] for s in listed or [])


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that the library wrote; nothing happens where it is not there."""
    files, found = _files(spark, path)
    files.delete(found, True)
