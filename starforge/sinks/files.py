"""Folders of a table on any file system that Spark knows (S3, HDFS, local)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def folder_exists(spark: SparkSession, path: str) -> bool:
    where, system = _system(spark, path)
    return system.exists(where)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none if it is not there."""
    where, system = _system(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    where, system = _system(spark, path)
    system.delete(where, True)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at ``path``: an empty folder is no table."""
    where, system = _system(spark, path)
    return system.exists(where) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(where))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` in its declared schema; no rows where nothing was written yet."""
    if not has_data(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
