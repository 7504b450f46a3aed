"""File listings and folder operations on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder of intermediate results; stored tables are never passed to it."""
    fs, target = _hadoop_path(spark, path)
    return fs.delete(target, True)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row (path, length) per data file below ``path``; file contents are not read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, length bigint")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length")
    )


def partition_value(path, name: str):
    """Value of ``name=value`` in a path column, null when absent; only %XX escapes are undone."""
    value = F.regexp_extract(path, f"/{name}=([^/]+)/", 1)
    return F.when(value != "", F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))
