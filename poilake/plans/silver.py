"""Bronze to Silver."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poilake.functions.scores import business_key
from poilake.functions.text import clean_name
from poilake.operators.clean import flatten_enriched
from poilake.operators.dedup import latest_per_key


def build_silver(
    bronze: DataFrame,
    processed_at: datetime | None = None,
    scope: Sequence[str] = (),
    keep_null_labels: bool = False,
    key_by_type: bool = True,
) -> DataFrame:
    """Flatten, clean names, key and keep the latest record per key.

    Latest means: last ingested, then highest run id. ``scope`` adds columns to the key,
    e.g. ``["snapshot_date"]`` keeps one row per key and snapshot. The element type is part of
    the key where the source gives one, as a node and a way may share a number; without
    ``key_by_type`` they count as one place.
    """
    stamp = F.lit(processed_at) if processed_at else None
    flat = flatten_enriched(bronze, stamp, keep_null_labels)
    named = flat.withColumn("name", clean_name(F.col("name")))
    kind = F.col("osm_type") if key_by_type else None
    keyed = named.withColumn(
        "business_key", business_key(F.col("osm_id"), F.col("name"), F.col("latitude"), F.col("longitude"), kind)
    )
    newest = [F.desc_nulls_last("source_ingested_at"), F.desc_nulls_last("run_id")]
    return latest_per_key(keyed.drop("osm_type"), ["business_key", *scope], newest)
