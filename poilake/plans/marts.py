"""Silver to the Gold marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.functions.scores import attraction_key, first_category, health, popularity, reliability
from poilake.operators.clean import drop_no_coords
from poilake.operators.dedup import latest_per_key
from poilake.operators.geo import assign_nearest


def build_attractions(
    silver: DataFrame,
    districts: DataFrame,
    snapshot_date: date,
    loaded_at: datetime | None = None,
    high: int = 3,
    medium: int = 2,
) -> DataFrame:
    """The attraction mart: one row per (name, lat, lon) with key, tier, score, district.

    Of Silver rows equal in all three, the one with the smallest business key is kept.
    """
    rows = silver.select(
        "business_key",
        "name",
        first_category(F.col("poi_types")).alias("category"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        F.col("rating").alias("avg_rating"),
        F.col("review_count").alias("source_count"),
        F.lit("google_osm").alias("sources"),
    )
    one = latest_per_key(rows, ["name", "lat", "lon"], [F.asc_nulls_last("business_key")])
    placed = assign_nearest(one, districts)
    loaded = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    return placed.select(
        attraction_key(F.col("name"), F.col("lat"), F.col("lon")).alias("attraction_key"),
        "name",
        "category",
        "lat",
        "lon",
        "avg_rating",
        "source_count",
        "sources",
        reliability(F.col("source_count"), high, medium).alias("reliability_level"),
        popularity(F.col("avg_rating"), F.col("source_count")).alias("popularity_score"),
        "district_name",
        F.lit(snapshot_date).alias("snapshot_date"),
        loaded.alias("load_timestamp"),
    )


def executive_overview(gold: DataFrame) -> DataFrame:
    """Key figures per snapshot (D01); over all snapshots and ordered, the timeline."""
    return gold.groupBy("snapshot_date").agg(
        F.count("*").alias("total_pois"),
        F.avg("avg_rating").alias("city_avg_rating"),
        F.sum("source_count").alias("total_interactions"),
        F.count_distinct("district_name").alias("districts_covered"),
    )


def timeline(gold: DataFrame) -> DataFrame:
    """Key figures of every snapshot in order."""
    return executive_overview(gold).orderBy("snapshot_date")


def district_benchmarking(gold: DataFrame) -> DataFrame:
    """Districts per snapshot, most popular first."""
    return (
        gold.groupBy("snapshot_date", "district_name")
        .agg(
            F.count("*").alias("poi_count"),
            F.avg("avg_rating").alias("district_avg_rating"),
            F.sum("popularity_score").alias("total_district_popularity"),
            F.count_distinct("category").alias("category_diversity"),
        )
        .orderBy(F.desc_nulls_last("total_district_popularity"))
    )


def service_accessibility(gold: DataFrame) -> DataFrame:
    """Locations per category, district and tier."""
    return gold.groupBy("snapshot_date", "category", "district_name", "reliability_level").agg(
        F.count("*").alias("total_locations"),
        F.count_if(F.col("reliability_level") == "High").alias("verified_count"),
        F.avg("popularity_score").alias("avg_popularity"),
    )


#: What the partial aggregates are grouped by, the date aside.
GROUPS = ["district_name", "category", "reliability_level"]


def partials(gold: DataFrame) -> DataFrame:
    """Sums and counts per snapshot, district, category and tier, which add up over any of these.

    The key figures of D01 to D03 follow from them without the mart; distinct districts and
    categories are exact, as both are part of the group.
    """
    return gold.groupBy("snapshot_date", *GROUPS).agg(
        F.count("*").alias("locations"),
        F.count("avg_rating").alias("rated"),
        F.sum("avg_rating").alias("rating_sum"),
        F.sum("source_count").alias("interactions"),
        F.count("popularity_score").alias("scored"),
        F.sum("popularity_score").alias("popularity_sum"),
    )


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def overview_of(parts: DataFrame, by: Sequence[str | Column] = ("snapshot_date",)) -> DataFrame:
    """``executive_overview`` from partial aggregates, also over several snapshots at once."""
    return parts.groupBy(*by).agg(
        F.sum("locations").alias("total_pois"),
        _mean("rating_sum", "rated").alias("city_avg_rating"),
        F.sum("interactions").alias("total_interactions"),
        F.count_distinct("district_name").alias("districts_covered"),
    )


def benchmarking_of(parts: DataFrame, by: Sequence[str | Column] = ("snapshot_date",)) -> DataFrame:
    """``district_benchmarking`` from partial aggregates."""
    ranked = parts.groupBy(*by, "district_name").agg(
        F.sum("locations").alias("poi_count"),
        _mean("rating_sum", "rated").alias("district_avg_rating"),
        F.sum("popularity_sum").alias("total_district_popularity"),
        F.count_distinct("category").alias("category_diversity"),
    )
    return ranked.orderBy(F.desc_nulls_last("total_district_popularity"))


def accessibility_of(parts: DataFrame, by: Sequence[str | Column] = ("snapshot_date",)) -> DataFrame:
    """``service_accessibility`` from partial aggregates."""
    high = F.when(F.col("reliability_level") == "High", F.col("locations")).otherwise(0)
    return parts.groupBy(*by, "category", "district_name", "reliability_level").agg(
        F.sum("locations").alias("total_locations"),
        F.sum(high).alias("verified_count"),
        _mean("popularity_sum", "scored").alias("avg_popularity"),
    )


def district_stats(
    df: DataFrame, day: str = "report_date", district: str = "district", rating: str = "rating", reviews: str = "review_count"
) -> DataFrame:
    """Totals and maxima per report date and district."""
    return df.groupBy(day, district).agg(
        F.count("*").alias("total_attractions"),
        F.avg(rating).alias("avg_rating"),
        F.sum(reviews).alias("total_reviews"),
        F.max(reviews).alias("max_reviews"),
    )


def quality_alerts(gold: DataFrame) -> DataFrame:
    """Critical and warning attractions, worst first."""
    status = health(F.col("avg_rating"))
    labelled = gold.select(
        "snapshot_date", "name", "category", "avg_rating", "reliability_level", status.alias("health_status")
    )
    alerts = labelled.where(F.col("health_status").isin("CRITICAL", "WARNING"))
    return alerts.orderBy(F.asc_nulls_last("avg_rating"))


def heatmap_feed(gold: DataFrame) -> DataFrame:
    """What the heat map draws."""
    return drop_no_coords(gold).select(
        "snapshot_date", "name", "category", "lat", "lon", "avg_rating", "popularity_score", "district_name"
    )


def star_enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Fact rows with each (dimension, fact column, dimension key) joined on the left.

    Dimension keys are unique. Spark broadcasts a dimension while its size is below the
    broadcast threshold and shuffles otherwise.
    """
    rows = fact
    for dim, column, key in dims:
        keyed = dim.withColumnRenamed(key, "_key")
        rows = rows.join(keyed, rows[column] == keyed["_key"], "left").drop("_key")
    return rows
