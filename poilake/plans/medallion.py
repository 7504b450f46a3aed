"""The whole run: Bronze to Silver to Gold, with a quality gate before each layer is published."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poilake import schemas
from poilake.operators import quality as Q
from poilake.operators.clean import in_bbox, inside_box
from poilake.plans import marts
from poilake.plans.silver import build_silver
from poilake.session import materialize, scratch_path
from poilake.sources.bronze import read_bronze
from poilake.sources.files import delete_folder
from poilake.sources.tables import write_snapshot

SILVER_RULES = [
    Q.not_null("business_key"),
    Q.not_null("latitude"),
    Q.not_null("longitude"),
    Q.accepted_range("rating", 0.0, 5.0),
    Q.unique("business_key", "snapshot_date"),
]
GOLD_RULES = [
    Q.not_null("attraction_key"),
    Q.accepted_range("avg_rating", 0.0, 5.0),
    Q.accepted_range("popularity_score", 0.0),
    Q.unique("attraction_key", "snapshot_date"),
]


class QualityError(RuntimeError):
    """A gate failed; the message lists the failing rules."""


@dataclass(frozen=True)
class Paths:
    """Roots of the three layers."""

    bronze: str
    silver: str
    gold: str


def publish(df: DataFrame, path: str, day: date, rules: list[Q.Rule], layer: str) -> DataFrame:
    """Replace a date's partition if the rows pass their rules; else raise and leave it as it is.

    The rows are written to the shared scratch folder, observed on the way, and published from
    there, so nobody reads a layer that failed.
    """
    staged = scratch_path(df.sparkSession, layer)
    rows, failed = Q.store_observed(df, staged, rules)
    if failed:
        delete_folder(df.sparkSession, staged)
        raise QualityError(f"{layer}: " + "; ".join(failed))
    stored = write_snapshot(rows, path, day)
    delete_folder(df.sparkSession, staged)
    return stored


def rejected(bronze: DataFrame, corrupt: str) -> DataFrame:
    """Records that cannot become places, with the reason: malformed, or without coordinates."""
    own, found = F.col("osm_data"), F.col("google_data.geometry.location")
    nowhere = F.coalesce(found["lat"], own["lat"]).isNull() | F.coalesce(found["lng"], own["lon"]).isNull()
    reason = F.when(F.col(corrupt).isNotNull(), "malformed").when(nowhere, "no_coordinates")
    return bronze.withColumn("reason", reason).where("reason is not null").select(
        "source", "snapshot_date", "run_id", "reason", F.col(corrupt).alias("record"), "osm_data", "google_data"
    )


def run_medallion(
    spark: SparkSession,
    paths: Paths,
    districts: DataFrame,
    snapshot_date: date,
    source: str = "osm_google_enriched",
    processed_at: datetime | None = None,
    box: tuple[float, float, float, float] | None = None,
) -> dict[str, DataFrame]:
    """Run every step for one snapshot and return the stored tables by name.

    Each layer is checked while it is written, published if it passes, and read back by the
    next, so a rerun of the same snapshot replaces its own partitions and nothing else, and a
    failed one replaces none of its layer. Records that are malformed or
    have no coordinates are kept in ``quarantine``, and so are places outside ``box``, as the
    JSON of their Silver row. So every record is there or in Silver or was replaced by a later
    record of its key.
    """
    corrupt = "_corrupt"
    landed = read_bronze(spark, paths.bronze, source, schemas.ENRICHED, corrupt)
    landed = landed.where(landed["snapshot_date"] == snapshot_date)
    refused = rejected(landed, corrupt)
    silver = build_silver(landed.where(F.col(corrupt).isNull()).drop(corrupt), processed_at)
    if box:
        every = materialize(silver, "silver")  # read twice
        silver = in_bbox(every, "latitude", "longitude", box)
        outside = every.where(~inside_box(F.col("latitude"), F.col("longitude"), box))
        refused = refused.unionByName(
            outside.select(
                F.lit(source).alias("source"), "snapshot_date", "run_id", F.lit("outside_box").alias("reason"),
                F.to_json(F.struct("*")).alias("record"),
            ),
            allowMissingColumns=True,
        )
    quarantine = write_snapshot(refused, f"{paths.silver}/quarantine", snapshot_date)
    stored = publish(silver, f"{paths.silver}/attractions_enriched", snapshot_date, SILVER_RULES, "silver")

    attractions = marts.build_attractions(stored, districts, snapshot_date, processed_at)
    gold = publish(attractions, f"{paths.gold}/gold_attractions", snapshot_date, GOLD_RULES, "gold")

    builders = {
        "gold_executive_overview": marts.executive_overview,
        "gold_district_benchmarking": marts.district_benchmarking,
        "gold_service_accessibility": marts.service_accessibility,
        "gold_quality_alerts": marts.quality_alerts,
        "gold_tourism_heatmap": marts.heatmap_feed,
    }
    tables = {"quarantine": quarantine, "attractions_enriched": stored, "gold_attractions": gold}
    for name, build in builders.items():
        tables[name] = write_snapshot(build(gold), f"{paths.gold}/{name}", snapshot_date)
    return tables
