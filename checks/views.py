"""Views that give the driver tables the shape of the operators' inputs.

Each view exists twice: as a DataFrame for the queries and as SQL for the oracle.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poilake import constants as K
from poilake.operators.geo import assign_nearest
from poilake.plans.marts import build_attractions

SNAPSHOT = date(2024, 6, 1)
# The key of an enriched record, whose element is a way where the number is a multiple of three.
TYPED_ID = "concat(CASE WHEN osm_id % 3 = 0 THEN 'way/' ELSE 'node/' END, CAST(osm_id AS VARCHAR))"
# Review counts of the test tables start at 14, so the tiers are set higher than usual.
HIGH, MEDIUM = 40, 25


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _dbl(value) -> Column:
    return F.lit(float(value))


def poi(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    counts = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    key = F.col("p_partkey")
    return p.join(counts, p["p_partkey"] == counts["l_partkey"], "left").select(
        key.alias("osm_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        (_dbl(20.6) + (key * 7919 % 8000).cast("double") / 10000).alias("lat"),
        (_dbl(105.3) + (key * 104729 % 7000).cast("double") / 10000).alias("lon"),
        F.when(key % 10 != 0, (10 + F.col("p_size") % 41).cast("double") / 10).alias("rating"),
        F.coalesce("n", F.lit(0)).alias("review_count"),
    )


def poi_b(spark: SparkSession, sf: str) -> DataFrame:
    p = poi(spark, sf)
    return p.select(
        (F.col("osm_id") + 1000000).alias("osm_id"),
        F.concat(F.split_part("name", F.lit(" "), F.lit(2)), F.lit(" "), F.split_part("name", F.lit(" "), F.lit(1))).alias("name"),
        "category",
        "brand",
        (F.col("lat") + (F.col("osm_id") % 5).cast("double") / 2000).alias("lat"),
        "lon",
        "rating",
        "review_count",
    )


def districts(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("district_name"),
        (_dbl(20.65) + (key * 7 % 25).cast("double") * 0.03).alias("center_lat"),
        (_dbl(105.35) + (key * 11 % 25).cast("double") * 0.025).alias("center_lon"),
    )


def district_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return districts(spark, sf).select(
        "district_name",
        (F.col("center_lat") - 0.06).alias("lat_min"),
        (F.col("center_lat") + 0.06).alias("lat_max"),
        (F.col("center_lon") - 0.06).alias("lon_min"),
        (F.col("center_lon") + 0.06).alias("lon_max"),
    )


def hubs(spark: SparkSession, sf: str) -> DataFrame:
    """A centre per customer, one of them far away from all others."""
    key = F.col("c_custkey")
    away = F.when(key == 1, _dbl(-20.0)).otherwise(_dbl(0.0))
    return table(spark, sf, "customer").select(
        F.col("c_name").alias("district_name"),
        (_dbl(20.65) + (key * 613 % 7500).cast("double") / 10000 + away).alias("center_lat"),
        (_dbl(105.35) + (key * 877 % 6300).cast("double") / 10000).alias("center_lon"),
    )


def hub_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """A box around each customer's centre, of many sizes."""
    half = _dbl(0.002) + (F.length("district_name") + F.ascii(F.substring("district_name", -1, 1)) % 8).cast("double") / 400
    return hubs(spark, sf).select(
        "district_name",
        (F.col("center_lat") - half).alias("lat_min"),
        (F.col("center_lat") + half).alias("lat_max"),
        (F.col("center_lon") - half).alias("lon_min"),
        (F.col("center_lon") + half).alias("lon_max"),
    )


def poi_snap(spark: SparkSession, sf: str) -> DataFrame:
    month = F.trunc("l_shipdate", "month").alias("snapshot_date")
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("osm_id"), month)
        .agg(F.round(1 + 4 * F.avg("l_quantity") / 50, 2).alias("rating"), F.count("*").alias("review_count"))
    )


def poi_history(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots with the district of their place."""
    placed = assign_nearest(poi(spark, sf).select("osm_id", "category", "lat", "lon"), districts(spark, sf))
    return poi_snap(spark, sf).join(placed.select("osm_id", "category", "district_name"), "osm_id")


def fact(spark: SparkSession, sf: str) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    key = F.col("c_custkey")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        key.alias("place_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category"),
        F.col("c_nationkey").alias("weather_snapshot_id"),
        F.when(key % 10 != 0, (10 + key % 41).cast("double") / 10).alias("rating"),
        (key % 97).alias("total_ratings"),
        (key % 5 == 0).alias("is_overcrowded"),
        F.when(key % 50 != 0, F.col("n_name")).alias("district"),
        ((key % 101).cast("double") / 100).alias("visitor_density_score"),
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").alias("snapshot_id"),
        F.col("r_name").alias("weather_condition"),
        (10 + F.col("n_nationkey")).cast("double").alias("temperature_celsius"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    state = F.col("event_id") % 4
    return table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("dag_id"),
        F.concat(F.lit("task_"), (F.col("user_id") % 5).cast("string")).alias("task_id"),
        F.when(state == 0, "success").when(state == 1, "failed").when(state == 2, "running").otherwise("queued").alias("state"),
        F.col("ts").alias("execution_date"),
    )


def silver_shape(places: DataFrame) -> DataFrame:
    """A ``poi``-like frame with the Silver columns the marts read."""
    return places.select(
        F.col("osm_id").cast("string").alias("business_key"),
        "name",
        F.array("category").alias("poi_types"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "rating",
        "review_count",
    )


def gold(spark: SparkSession, sf: str) -> DataFrame:
    built = build_attractions(silver_shape(poi(spark, sf)), districts(spark, sf), SNAPSHOT, high=HIGH, medium=MEDIUM)
    return built.drop("load_timestamp")


def elements(spark: SparkSession, sf: str) -> DataFrame:
    """Map elements with tags, ways located by their centre, some without a name."""
    i = F.col("osm_id")
    tourism = (
        F.when(i % 6 == 0, "attraction").when(i % 6 == 1, "hotel").when(i % 6 == 2, "museum")
        .when(i % 6 == 3, "art museum").when(i % 6 == 5, "viewpoint")
    )
    tags = {
        "name": F.when(i % 13 != 0, F.col("name")),
        "name:vi": F.when(i % 26 == 0, F.col("name")),
        "name:en": F.when(i % 2 == 0, F.upper("name")),
        "tourism": tourism,
        "amenity": F.when(i % 5 == 0, "restaurant").when(i % 5 == 1, "bank"),
        "historic": F.when(i % 7 == 0, "monument"),
        "leisure": F.when(i % 11 == 0, "park"),
    }
    pairs = [part for name, value in tags.items() for part in (F.lit(name), value)]
    node = i % 3 != 0
    return poi(spark, sf).select(
        F.when(node, "node").otherwise("way").alias("type"),
        i.alias("id"),
        F.when(node, F.col("lat")).alias("lat"),
        F.when(node, F.col("lon")).alias("lon"),
        F.when(~node, F.struct("lat", "lon")).alias("center"),
        F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("tags"),
    )


def areas(spark: SparkSession, sf: str) -> DataFrame:
    """One area group per element, with an unnamed element that must not come out."""
    e = elements(spark, sf)
    own = F.struct(*[F.col(c) for c in e.columns])
    unnamed = F.struct(
        F.lit("node").alias("type"), (-F.col("id")).alias("id"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"),
        F.lit(None).cast("struct<lat:double,lon:double>").alias("center"),
        F.create_map(F.lit("tourism"), F.lit("attraction")).alias("tags"),
    )
    return e.select(F.array(own, unnamed).alias("elements"))


def enriched(spark: SparkSession, sf: str, run_id: str = "run_1", rating_shift: float = 0.0) -> DataFrame:
    """Enriched records: unrated places have no details record."""
    i = F.col("osm_id")
    period = F.struct(
        F.struct((i % 7).cast("int").alias("day"), F.lit("0900").alias("time")).alias("open"),
        F.struct((i % 7).cast("int").alias("day"), F.lit("1700").alias("time")).alias("close"),
    )
    review = F.struct(
        F.col("brand").alias("author_name"), (1 + i % 5).cast("int").alias("rating"),
        F.col("category").alias("text"), (1700000000 + i).alias("time"),
    )
    photo = F.struct(F.col("name").alias("photo_reference"), F.lit(600).alias("height"), F.lit(800).alias("width"))
    found = F.struct(
        F.concat(F.lit(" "), F.col("name"), F.lit(" ")).alias("name"),
        F.concat(F.col("brand"), F.lit(" street")).alias("formatted_address"),
        F.struct(F.struct("lat", F.col("lon").alias("lng")).alias("location")).alias("geometry"),
        (F.col("rating") + rating_shift).alias("rating"),
        F.col("review_count").alias("user_ratings_total"),
        F.when(i % 4 != 0, F.concat(F.lit("http://example.com/"), i.cast("string"))).alias("website"),
        F.when(i % 3 == 0, F.concat(F.lit("+84 "), i.cast("string"))).alias("international_phone_number"),
        F.array(F.lower("category"), F.lit("point_of_interest")).alias("types"),
        F.struct(F.array(period).alias("periods")).alias("opening_hours"),
        F.array(review, review).alias("reviews"),
        F.when(i % 2 == 0, F.array(photo)).alias("photos"),
    )
    tags = F.map_filter(
        F.create_map(
            F.lit("tourism"), F.when(i % 2 == 0, "attraction"), F.lit("historic"), F.when(i % 7 == 0, "monument"),
            F.lit("addr:full"), F.when(i % 20 == 0, F.col("brand")),
        ),
        lambda _, v: v.isNotNull(),
    )
    kind = F.when(i % 3 == 0, "way").otherwise("node")
    own = F.struct("osm_id", kind.alias("osm_type"), "name", tags.alias("tags"), "lat", "lon")
    return poi(spark, sf).select(
        own.alias("osm_data"),
        F.when(F.col("rating").isNotNull(), found).alias("google_data"),
        F.lit("2024-06-01T00:00:00Z").alias("ingested_at"),
        F.lit("osm_google_enriched").alias("source"),
        F.lit(SNAPSHOT).alias("snapshot_date"),
        F.lit(run_id).alias("run_id"),
    )


def places(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Both sources in the shape of the entity-resolution input."""

    def shaped(df: DataFrame, source: str) -> DataFrame:
        return df.select(
            F.lit(source).alias("source"), F.col("osm_id").cast("string").alias("source_id"),
            "name", "lat", "lon", "rating", "category",
        )

    return [shaped(poi(spark, sf), "google"), shaped(poi_b(spark, sf), "osm")]


_VALUES = ", ".join(f"('{n}', {a}, {b})" for n, a, b in K.DISTRICT_CENTERS)

_SQL = {
    "poi": """SELECT p.p_partkey AS osm_id, p.p_name AS name, p.p_type AS category, p.p_brand AS brand,
 CAST(20.6 AS DOUBLE) + CAST((p.p_partkey*7919)%8000 AS DOUBLE)/CAST(10000 AS DOUBLE) AS lat,
 CAST(105.3 AS DOUBLE) + CAST((p.p_partkey*104729)%7000 AS DOUBLE)/CAST(10000 AS DOUBLE) AS lon,
 CASE WHEN p.p_partkey % 10 = 0 THEN NULL
      ELSE CAST(10 + p.p_size % 41 AS DOUBLE)/CAST(10 AS DOUBLE) END AS rating,
 CAST(coalesce(l.n,0) AS BIGINT) AS review_count
FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) l
 ON l.l_partkey = p.p_partkey""",
    "poi_b": """SELECT osm_id + 1000000 AS osm_id,
 concat(split_part(name,' ',2), ' ', split_part(name,' ',1)) AS name, category, brand,
 lat + CAST(osm_id % 5 AS DOUBLE)/CAST(2000 AS DOUBLE) AS lat, lon, rating, review_count
FROM poi""",
    "districts": """SELECT n_name AS district_name,
 CAST(20.65 AS DOUBLE) + CAST((n_nationkey*7)%25 AS DOUBLE)*CAST(0.03 AS DOUBLE) AS center_lat,
 CAST(105.35 AS DOUBLE) + CAST((n_nationkey*11)%25 AS DOUBLE)*CAST(0.025 AS DOUBLE) AS center_lon
FROM nation""",
    "fixed_districts": "SELECT t.n AS district_name, CAST(t.a AS DOUBLE) AS center_lat, CAST(t.b AS DOUBLE) AS center_lon"
    f" FROM (VALUES {_VALUES}) AS t(n, a, b)",
    "district_boxes": """SELECT district_name, center_lat - CAST(0.06 AS DOUBLE) AS lat_min, center_lat + CAST(0.06 AS DOUBLE) AS lat_max,
 center_lon - CAST(0.06 AS DOUBLE) AS lon_min, center_lon + CAST(0.06 AS DOUBLE) AS lon_max
FROM districts""",
    "hubs": """SELECT c_name AS district_name,
 CAST(20.65 AS DOUBLE) + CAST((c_custkey*613)%7500 AS DOUBLE)/CAST(10000 AS DOUBLE) + CASE WHEN c_custkey = 1 THEN CAST(-20.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS center_lat,
 CAST(105.35 AS DOUBLE) + CAST((c_custkey*877)%6300 AS DOUBLE)/CAST(10000 AS DOUBLE) AS center_lon
FROM customer""",
    "hub_boxes": """SELECT district_name, center_lat - half AS lat_min, center_lat + half AS lat_max, center_lon - half AS lon_min, center_lon + half AS lon_max
FROM (SELECT *, CAST(0.002 AS DOUBLE) + CAST(length(district_name) + ascii(right(district_name, 1)) % 8 AS DOUBLE)/CAST(400 AS DOUBLE) AS half FROM hubs)""",
    "poi_snap": """SELECT l_partkey AS osm_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
 round(1 + 4*avg(l_quantity)/CAST(50 AS DOUBLE), 2) AS rating, count(*) AS review_count
FROM lineitem GROUP BY l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE)""",
    "nearest": """SELECT osm_id, name, category, brand, lat, lon, rating, review_count, district_name, d2 FROM (
 SELECT p.*, d.district_name, (p.lat-d.center_lat)*(p.lat-d.center_lat)+(p.lon-d.center_lon)*(p.lon-d.center_lon) AS d2,
  row_number() OVER (PARTITION BY p.osm_id ORDER BY (p.lat-d.center_lat)*(p.lat-d.center_lat)+(p.lon-d.center_lon)*(p.lon-d.center_lon), d.district_name) AS rn
 FROM poi p CROSS JOIN districts d) WHERE rn = 1""",
    "poi_history": """SELECT s.osm_id, s.snapshot_date, s.rating, s.review_count, n.category, n.district_name
FROM poi_snap s JOIN nearest n ON n.osm_id = s.osm_id""",
    "fact": """SELECT c_custkey AS place_id, c_name AS name, c_mktsegment AS category, c_nationkey AS weather_snapshot_id,
 CASE WHEN c_custkey % 10 = 0 THEN NULL
      ELSE CAST(10 + c_custkey % 41 AS DOUBLE)/CAST(10 AS DOUBLE) END AS rating,
 c_custkey % 97 AS total_ratings, (c_custkey % 5 = 0) AS is_overcrowded,
 CASE WHEN c_custkey % 50 <> 0 THEN n_name END AS district,
 CAST(c_custkey % 101 AS DOUBLE)/CAST(100 AS DOUBLE) AS visitor_density_score
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "weather": """SELECT n.n_nationkey AS snapshot_id, r.r_name AS weather_condition,
 CAST(10 + n.n_nationkey AS DOUBLE) AS temperature_celsius
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "runs": """SELECT event_id AS run_id, event_type AS dag_id, concat('task_', CAST(user_id % 5 AS VARCHAR)) AS task_id,
 CASE event_id % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' WHEN 2 THEN 'running' ELSE 'queued' END AS state,
 ts AS execution_date
FROM events""",
    "gold": f"""SELECT md5(concat(name, CAST(lat AS VARCHAR), CAST(lon AS VARCHAR))) AS attraction_key, name, category, lat, lon,
 rating AS avg_rating, review_count AS source_count, 'google_osm' AS sources,
 CASE WHEN review_count >= {HIGH} THEN 'High' WHEN review_count >= {MEDIUM} THEN 'Medium' ELSE 'Low' END AS reliability_level,
 rating * log10(review_count + 1) AS popularity_score, district_name, DATE '{SNAPSHOT}' AS snapshot_date
FROM (SELECT *, row_number() OVER (PARTITION BY name, lat, lon ORDER BY CAST(osm_id AS VARCHAR)) AS k FROM nearest) WHERE k = 1""",
    "el": """SELECT CASE WHEN osm_id % 3 <> 0 THEN 'node' ELSE 'way' END AS type, osm_id AS id, lat, lon,
 CASE WHEN osm_id % 13 <> 0 THEN name END AS name_tag, CASE WHEN osm_id % 26 = 0 THEN name END AS name_vi,
 CASE WHEN osm_id % 2 = 0 THEN upper(name) END AS name_en,
 CASE osm_id % 6 WHEN 0 THEN 'attraction' WHEN 1 THEN 'hotel' WHEN 2 THEN 'museum' WHEN 3 THEN 'art museum' WHEN 5 THEN 'viewpoint' END AS tourism,
 CASE osm_id % 5 WHEN 0 THEN 'restaurant' WHEN 1 THEN 'bank' END AS amenity,
 CASE WHEN osm_id % 7 = 0 THEN 'monument' END AS historic, CASE WHEN osm_id % 11 = 0 THEN 'park' END AS leisure
FROM poi""",
}

_NEEDS = {
    "poi_b": ["poi"],
    "district_boxes": ["districts"],
    "hub_boxes": ["hubs"],
    "nearest": ["poi", "districts"],
    "poi_history": ["poi_snap", "nearest"],
    "gold": ["nearest"],
    "el": ["poi"],
}


def with_views(*names: str, extra: str = "", recursive: bool = False) -> str:
    """The WITH clause that defines the named views and those they need."""
    done: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in done:
            done.append(name)

    for name in names:
        add(name)
    parts = [f"{name} AS ({_SQL[name]})" for name in done]
    if extra:
        parts.append(extra)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"
