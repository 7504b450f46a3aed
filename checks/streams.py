"""Incremental and streaming operators over the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import views as V
from checks.bronze import SILVER_RUN_2, SOURCE, STAMP, _landed, _silver_shown
from checks.core import query
from poilake import schemas
from poilake.plans import marts
from poilake.plans.silver import build_silver
from poilake.session import scratch_path
from poilake.sources.bronze import land_bronze
from poilake.sources.tables import read_table
from poilake.streaming import incremental as I

W = V.with_views


def _events(spark, sf):
    schema = V.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _silver(batch):
    return build_silver(batch, STAMP, scope=["snapshot_date"])


def _sync(spark, root, files=None):
    stream = I.bronze_stream(spark, f"{root}/bronze", SOURCE, schemas.ENRICHED, files)
    I.upsert_stream(stream, f"{root}/silver", f"{root}/state", _silver).awaitTermination()


@query("stream_upsert", SILVER_RUN_2)
def _(spark, sf):
    root = scratch_path(spark, "lake")
    _landed(spark, sf, f"{root}/bronze", ("run_1", 0.0), ("run_2", 0.1))
    _sync(spark, root, files=4)  # several micro-batches
    return _silver_shown(read_table(spark, f"{root}/silver"), "business_key")


@query("incremental", SILVER_RUN_2)
def _(spark, sf):
    root = scratch_path(spark, "lake")
    _landed(spark, sf, f"{root}/bronze", ("run_1", 0.0))
    _sync(spark, root)
    # The second call sees only what has landed since the first.
    _landed(spark, sf, f"{root}/bronze", ("run_2", 0.1))
    _sync(spark, root)
    return _silver_shown(read_table(spark, f"{root}/silver"), "business_key")


#: Places of two snapshots: run 1 of the first stands, run 2 replaces run 1 of the second.
_TWO_DAYS = W("poi", "districts") + """, day AS (SELECT * FROM (VALUES (DATE '2024-05-01', 0.0), (DATE '2024-06-01', 0.1)) t(snapshot_date, shift)),
 s AS (SELECT osm_id, array_to_string(list_transform(string_split(trim(lower(name)), ' '),
 lambda w: upper(w[1]) || w[2:]), ' ') AS name, CASE WHEN rating IS NOT NULL THEN lower(category) WHEN osm_id % 2 = 0 THEN 'attraction'
 WHEN osm_id % 7 = 0 THEN 'monument' END AS category, lat, lon, rating, CASE WHEN rating IS NOT NULL THEN review_count END AS n FROM poi),
 d AS (SELECT s.*, g.district_name, row_number() OVER (PARTITION BY s.name, s.lat, s.lon ORDER BY
  (s.lat-g.center_lat)*(s.lat-g.center_lat)+(s.lon-g.center_lon)*(s.lon-g.center_lon), g.district_name, """ + V.TYPED_ID + """) AS rn
  FROM s CROSS JOIN districts g)
 SELECT snapshot_date, district_name, count(*) AS poi_count, round(avg(rating + shift) + 1e-9, 6) AS district_avg_rating,
 round(sum((rating + shift) * log10(n + 1)), 4) AS total_district_popularity, count(DISTINCT category) AS category_diversity
 FROM d CROSS JOIN day WHERE rn = 1 GROUP BY snapshot_date, district_name"""


@query("incremental_gold", _TWO_DAYS)
def _(spark, sf):
    """Two calls; the second one's records touch the later of two snapshots only."""
    root, dim = scratch_path(spark, "lake"), V.districts(spark, sf)

    def sync():
        I.upsert_stream(
            I.bronze_stream(spark, f"{root}/bronze", SOURCE, schemas.ENRICHED), f"{root}/silver", f"{root}/state", _silver,
            refresh=lambda days: I.refresh_gold(spark, f"{root}/silver", f"{root}/gold", dim, days, STAMP),
        ).awaitTermination()

    for day in (date(2024, 5, 1), V.SNAPSHOT):
        records = V.enriched(spark, sf, "run_1", 0.0).drop("source", "snapshot_date", "run_id")
        land_bronze(records, f"{root}/bronze", SOURCE, day, "run_1")
    sync()
    _landed(spark, sf, f"{root}/bronze", ("run_2", 0.1))
    sync()
    ranked = marts.benchmarking_of(read_table(spark, f"{root}/gold/gold_partials"))
    return ranked.select(
        "snapshot_date", "district_name", "poi_count", F.round(F.col("district_avg_rating") + 1e-9, 6).alias("district_avg_rating"),
        F.round("total_district_popularity", 4).alias("total_district_popularity"), "category_diversity",
    )


@query(
    "stream_dedup",
    """WITH late AS (SELECT max(ts) - INTERVAL 2 HOUR AS bound FROM events),
 first AS (SELECT DISTINCT user_id, event_type FROM events)
 SELECT user_id, event_type, count(*) AS n FROM (
 SELECT user_id, event_type FROM first
 UNION ALL SELECT user_id, event_type || '-late' FROM (SELECT DISTINCT user_id, event_type FROM events, late WHERE ts > bound))
 GROUP BY user_id, event_type""",
)
def _(spark, sf):
    """All events, then once more under other names: of these the watermark lets only recent ones in."""
    root = scratch_path(spark, "stream")
    events = V.table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    later = events.withColumn("event_type", F.concat("event_type", F.lit("-late")))
    kept = None
    for batch in (events, later):
        batch.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        deduped = I.dedup_stream(stream, ["user_id", "event_type"], "ts", "2 hours")
        kept = I.run_to_files(deduped, f"{root}/out", f"{root}/state")
    return kept.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query(
    "stream_window",
    """SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start, event_type, n, mean_value FROM (
 SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w, event_type, count(*) AS n, round(avg(value) + 1e-9, 6) AS mean_value
 FROM events GROUP BY 1, 2) WHERE w + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def _(spark, sf):
    kpis = I.kpi_stream(_events(spark, sf), "ts", "5 minutes", "10 minutes", "value", ["event_type"])
    root = scratch_path(spark, "stream")
    done = I.run_to_files(kpis, f"{root}/out", f"{root}/state")
    return done.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n",
        F.round(F.col("mean_value") + 1e-9, 6).alias("mean_value"),
    )
