"""Incremental Silver, stream dedup and windowed key figures."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from poilake.operators.dedup import latest_per_key
from poilake.plans import marts
from poilake.session import scratch_path, store
from poilake.sources.files import delete_folder, path_exists
from poilake.sources.tables import write_partitions, write_snapshot


def bronze_stream(
    spark: SparkSession, root: str, source: str, schema: StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    """New run files of a source as they land.

    The path is a pattern because a stream takes a plain path as its own base path, which
    would hide the source column.
    """
    reader = spark.readStream.schema(schema).option("basePath", root)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(f"{root}/source={source}/snapshot_date=*")


def upsert(batch: DataFrame, path: str, keys: Sequence[str], order_columns: Sequence[str], by: str) -> list:
    """Merge a batch into the table's partitions it touches; the latest row per key wins.

    Keys are unique within a partition of ``by``. Other partitions are neither read nor
    written, and a batch that is replayed gives the same table. Returns the partitions
    touched, in no order.
    """
    spark = batch.sparkSession
    paths = [scratch_path(spark, "batch"), scratch_path(spark, "upsert")]
    batch = store(batch, paths[0])  # computed once
    merged = batch
    # The batch's partition values, a few dates, as literals: the scan lists no others.
    values = [r[by] for r in batch.select(by).distinct().collect()]
    if path_exists(spark, path):
        table = spark.read.schema(batch.schema).parquet(path)
        known = F.col(by).isin([v for v in values if v is not None])
        touched = table.where(known | F.col(by).isNull() if None in values else known)
        merged = touched.select(*batch.columns).unionByName(batch)
    order = [F.desc_nulls_last(c) for c in order_columns]
    latest = latest_per_key(merged, [*keys, by], order)
    # The merge reads the partitions that it replaces, so it is stored before the swap.
    write_partitions(store(latest, paths[1]), path, by)
    for done in paths:
        delete_folder(spark, done)
    return values


def refresh_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    districts: DataFrame,
    days: Sequence[date],
    loaded_at: datetime | None = None,
) -> None:
    """Rebuild the mart and its partial aggregates for the dates that changed, and no others.

    ``gold/gold_attractions`` and ``gold/gold_partials`` are partitioned by snapshot; the figures
    of any range of dates are sums over ``gold_partials`` (``marts.overview_of`` and the like), so
    dates that did not change are neither read nor written. Doing it again gives the same
    tables. A date whose Silver partition is empty loses its rows.
    """
    for day in days:
        rows = spark.read.parquet(silver).where(F.col("snapshot_date") == F.lit(day))
        mart = marts.build_attractions(rows, districts, day, loaded_at)
        stored = write_snapshot(mart, f"{gold}/gold_attractions", day)
        write_snapshot(marts.partials(stored), f"{gold}/gold_partials", day)


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame],
    keys: Sequence[str] = ("business_key",),
    order_columns: Sequence[str] = ("source_ingested_at", "run_id"),
    by: str = "snapshot_date",
    refresh: Callable[[list], None] | None = None,
) -> StreamingQuery:
    """Process everything that has landed since the last call, then stop.

    ``build`` turns a batch of Bronze rows into Silver rows. ``refresh`` gets the partitions that
    a batch touched, nulls aside, once they are stored; a batch that is replayed calls it again.
    """

    def merge(batch: DataFrame, _: int) -> None:
        touched = upsert(build(batch), path, keys, order_columns, by)
        if refresh:
            refresh(sorted(v for v in touched if v is not None))

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(stream: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key among rows at most ``delay`` apart; state older than that is dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def kpi_stream(
    stream: DataFrame, ts: str, width: str, delay: str, value: str, group: Sequence[str] = ()
) -> DataFrame:
    """Count and mean per tumbling window, final once the watermark passes its end."""
    window = F.window(ts, width)
    return (
        stream.withWatermark(ts, delay)
        .groupBy(window.alias("w"), *group)
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean_value"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *group, "n", "mean_value")
    )


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over everything available into Parquet files and read them."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
