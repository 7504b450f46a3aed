"""Row-level cleaning and filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake import constants as K
from poilake.functions.scores import labels_union, parse_stamp


def flatten_enriched(bronze: DataFrame, processed_at: Column | None = None, keep_null_labels: bool = False) -> DataFrame:
    """Nested enriched record to the flat Silver row, without name cleaning or keys.

    Also carries ``osm_type``, which tells nodes and ways of one number apart.

    Name, address and coordinates come from the details record first; ratings only from it.
    Rows without coordinates are dropped.
    """
    own, found = F.col("osm_data"), F.col("google_data")
    tags = own["tags"]
    tag_labels = F.array(*[F.try_element_at(tags, F.lit(t)) for t in ("tourism", "amenity", "historic")])
    flat = bronze.select(
        own["osm_id"].alias("osm_id"),
        own["osm_type"].alias("osm_type"),
        F.coalesce(found["name"], own["name"]).alias("name"),
        F.coalesce(found["formatted_address"], F.try_element_at(tags, F.lit("addr:full"))).alias("address"),
        F.coalesce(found["geometry"]["location"]["lat"], own["lat"]).alias("latitude"),
        F.coalesce(found["geometry"]["location"]["lng"], own["lon"]).alias("longitude"),
        found["rating"].alias("rating"),
        found["user_ratings_total"].alias("review_count"),
        found["website"].alias("website"),
        found["international_phone_number"].alias("phone"),
        labels_union(found["types"], tag_labels, keep_null_labels).alias("poi_types"),
        "run_id",
        "snapshot_date",
        parse_stamp(F.col("ingested_at")).alias("source_ingested_at"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("silver_processed_at"),
    )
    return drop_no_coords(flat, "latitude", "longitude")


def drop_no_coords(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows with both coordinates."""
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def inside_box(lat: Column, lon: Column, box) -> Column:
    """Whether a point lies in a (lat min, lat max, lon min, lon max) box, edges included; false for null."""
    return F.coalesce(lat.between(box[0], box[1]) & lon.between(box[2], box[3]), F.lit(False))


def in_bbox(df: DataFrame, lat: str = "lat", lon: str = "lon", box=K.CITY_BOX) -> DataFrame:
    """Rows inside a (lat min, lat max, lon min, lon max) box, edges included."""
    return df.where(inside_box(F.col(lat), F.col(lon), box))


def rated_only(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Rows with a positive rating."""
    return df.where(F.col(rating) > 0)


def in_dates(df: DataFrame, first: date | str, last: date | str, day: str = "snapshot_date") -> DataFrame:
    """Rows of a date range, edges included; prunes partitions when stored by ``day``."""
    return df.where(F.col(day).between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")))


def map_category(
    df: DataFrame, dim: DataFrame, raw: str = "category", shown: str = "shown_category", default: str | None = None
) -> DataFrame:
    """Adds the shown category of the raw one, the raw one or ``default`` when unmapped.

    ``dim`` has the columns raw_category and ``shown``, one row per raw category; Spark
    broadcasts it while it is below the broadcast threshold.
    """
    joined = df.join(dim, df[raw] == dim["raw_category"], "left").drop("raw_category")
    return joined.withColumn(shown, F.coalesce(F.col(shown), F.lit(default) if default else F.col(raw)))
