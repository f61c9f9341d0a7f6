"""The shared folder for intermediate tables, and steps on folders.

Intermediate tables are written to the folder the cluster names in
``spark.checkpoint.dir``. They outlive lost executors, are computed once however
often they are read, and give the optimizer real sizes to choose joins by.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Scratch:
    """A new folder inside the shared one. ``remove()`` deletes it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/larder-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return it as read back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a stage after its last reader."""
        delete(self.spark, self.path(name))

    def remove(self) -> None:
        delete(self.spark, self.root)


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="larder-")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str, missing: bool = False) -> list[str]:
    """Names of the folders in a folder; with ``missing``, none where there is no such folder."""
    fs, target = file_system(spark, path)
    if missing and not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
