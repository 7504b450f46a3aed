"""Run-partitioned raw landing and its readers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from poilake.sources.files import list_files, partition_value, path_exists


def read_bronze(
    spark: SparkSession, root: str, source: str, schema: StructType | str, corrupt: str | None = None
) -> DataFrame:
    """All runs of a source as rows of ``schema``; empty when nothing has landed.

    The schema is explicit, so no inference job runs and absent fields read as null. The
    base path makes source, snapshot date and run id come out as columns, and a filter on
    them prunes folders. ``corrupt`` names a further column that holds the text of records
    that are not valid JSON of the schema and is null for all others; without it such records
    read as nulls.
    """
    path = f"{root}/source={source}"
    if corrupt:
        more = f"{corrupt} string"
        schema = f"{schema}, {more}" if isinstance(schema, str) else StructType(schema.fields).add(corrupt, "string")
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", root)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Uploaded CSV with a header and an explicit schema."""
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def run_path(root: str, source: str, snapshot_date: date | str, run_id: str) -> str:
    return f"{root}/source={source}/snapshot_date={snapshot_date}/run_id={run_id}"


def land_bronze(df: DataFrame, root: str, source: str, snapshot_date: date | str, run_id: str) -> str:
    """Write one run as JSON lines; the same run again replaces its own files only."""
    path = run_path(root, source, snapshot_date, run_id)
    df.write.mode("overwrite").json(path)
    return path


def land_if_absent(
    df: DataFrame, root: str, source: str, snapshot_date: date | str, run_id: str, force: bool = False
) -> str:
    """Land unless the source already has files for that date; returns the path or SKIPPED."""
    day = f"{root}/source={source}/snapshot_date={snapshot_date}"
    if not force and not list_files(df.sparkSession, day, "*.json").isEmpty():
        return "SKIPPED"
    return land_bronze(df, root, source, snapshot_date, run_id)


def list_partitions(spark: SparkSession, root: str, source: str | None = None) -> DataFrame:
    """Landed (source, snapshot_date, run_id) with file count and bytes, from names only."""
    path = root if source is None else f"{root}/source={source}"
    keys = [partition_value(F.col("path"), k).alias(k) for k in ("source", "snapshot_date", "run_id")]
    return (
        list_files(spark, path, "*.json")
        .select(*keys, "length")
        .groupBy("source", F.to_date("snapshot_date").alias("snapshot_date"), "run_id")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def not_landed(requested: DataFrame, landed: DataFrame) -> DataFrame:
    """Requested rows whose (source, snapshot_date) has not landed yet."""
    keys = ["source", "snapshot_date"]
    return requested.join(landed.select(*keys).distinct(), keys, "left_anti")


def land_by_date(df: DataFrame, root: str) -> None:
    """Land rows in the source/date layout, replacing only the dates present."""
    (
        df.hint("rebalance", "source", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "date")
        .json(root)
    )


def landing_manifest(df: DataFrame, by: tuple[str, ...] = ("source", "date"), ts: str = "ingested_at") -> DataFrame:
    """Record count and last ingest time per landed partition."""
    return df.groupBy(*by).agg(F.count("*").alias("record_count"), F.max(ts).alias("ingested_at"))
