"""Silver and mart tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poilake import constants as K
from poilake.sources.files import list_files


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table."""
    return spark.read.parquet(path)


def districts_dim(spark: SparkSession) -> DataFrame:
    """The fixed district centres."""
    return spark.createDataFrame(K.DISTRICT_CENTERS, "district_name string, center_lat double, center_lon double")


def district_boxes_dim(spark: SparkSession) -> DataFrame:
    """The published district boxes."""
    return spark.createDataFrame(
        K.DISTRICT_BOXES,
        "district_name string, lat_min double, lat_max double, lon_min double, lon_max double",
    )


def category_dim(spark: SparkSession) -> DataFrame:
    """Raw category tag to shown category."""
    return spark.createDataFrame(K.CATEGORY_MAP, "raw_category string, shown_category string")


def dates_dim(spark: SparkSession, first: str = "2024-01-01", last: str = "2026-12-31") -> DataFrame:
    """One row per day with weekend flag, day of week (1 = Monday) and month name."""
    days = spark.sql(
        "SELECT explode(sequence(to_date(:first), to_date(:last))) AS date", {"first": first, "last": last}
    )
    weekday = F.weekday("date")
    return days.select(
        "date",
        (weekday >= 5).alias("is_weekend"),
        (weekday + 1).alias("day_of_week"),
        F.date_format("date", "MMMM").alias("month_name"),
    )


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace exactly the partitions present in ``df`` and keep the others.

    The rebalance hint lets adaptive execution split a large partition over several files
    and join small ones, so a hot date is not written by a single task.
    """
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str, day: date, by: str = "snapshot_date") -> DataFrame:
    """Replace one date's partition by ``df``, also by no rows at all, and read it back.

    An empty result must still remove what an earlier run of that date left behind, which
    overwriting only the partitions present would not.
    """
    df.drop(by).hint("rebalance").write.mode("overwrite").parquet(f"{path}/{by}={day}")
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.where(F.col(by) == F.lit(day))


def write_silver(df: DataFrame, path: str, by: str = "snapshot_date") -> None:
    """Silver table; history stays, reruns of a date replace it (A10).

    ``by="processed_day"`` partitions by the day of ``silver_processed_at`` instead.
    """
    if by == "processed_day" and by not in df.columns:
        df = df.withColumn(by, F.to_date("silver_processed_at"))
    write_partitions(df, path, by)


def write_mart(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Full refresh (A11), or replacement of the dates present when partitioned."""
    if partition:
        write_partitions(df, path, partition)
    else:
        df.write.mode("overwrite").parquet(path)


def staging_view(df: DataFrame, name: str) -> DataFrame:
    """Register a staging model as a view and return the view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def export_seed(df: DataFrame, path: str) -> None:
    """The merged seed as Parquet and as JSON records."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").json(f"{path}/json")


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """``primary``, or ``fallback`` when ``primary`` has no row.

    Decided when the query runs: the emptiness test is an uncorrelated EXISTS that stops
    at the first row.
    """
    return primary.unionByName(fallback.where(~primary.select(F.lit(1).alias("one")).exists()))


def storage_stats(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Object count and megabytes per layer, from file names and sizes only; 0 if empty."""
    every = spark.createDataFrame([(layer,) for layer in layers], "layer string")
    files = every.select("layer", F.lit(None).cast("long").alias("length"))  # a row that counts nothing
    for layer, path in layers.items():
        files = files.unionByName(list_files(spark, path).select(F.lit(layer).alias("layer"), "length"))
    return files.groupBy("layer").agg(
        F.count("length").alias("object_count"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1024 / 1024, 2).alias("total_size_mb"),
    )
