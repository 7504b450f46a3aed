"""Normalisers, selectors, landing, Silver and the whole run."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from checks import views as V
from checks.core import query
from poilake import constants as K
from poilake import schemas
from poilake.operators import clean
from poilake.operators import quality as Q
from poilake.operators.order import daily_batch
from poilake.plans.medallion import Paths, run_medallion
from poilake.plans.silver import build_silver
from poilake.session import scratch_path
from poilake.sources import bronze as B
from poilake.sources import normalize as N
from poilake.sources import tables as T

W = V.with_views
SOURCE = "osm_google_enriched"
STAMP = datetime(2024, 6, 1, 3, 0, 0)


# Normalisers: the raw documents are built from the places, the SQL says what must come out.


@query(
    "norm_google",
    W("poi") + """SELECT name, lat, lon, rating, CASE WHEN osm_id % 4 = 0 THEN 'attraction' ELSE category END AS category,
 'google' AS source FROM poi""",
)
def _(spark, sf):
    i = F.col("osm_id")
    place = F.struct(
        F.struct(F.col("name").alias("text")).alias("displayName"),
        F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("location"),
        "rating",
        F.when(i % 4 != 0, F.array("category", "brand")).when(i % 8 == 0, F.array().cast("array<string>")).alias("types"),
    )
    text = V.poi(spark, sf).select(F.to_json(F.struct(F.array(place).alias("places"))).alias("json"))
    raw = text.select(F.from_json("json", schemas.PLACES_SEARCH).alias("r")).select("r.*")
    return N.google_places(raw).select("source", "name", "lat", "lon", "rating", "category")


@query(
    "norm_overpass",
    W("el") + """SELECT 'osm' AS source, concat(type, '/', CAST(id AS VARCHAR)) AS source_id,
 coalesce(name_tag, name_vi, name_en) AS name, lat, lon, coalesce(tourism, amenity, historic) AS category
 FROM el WHERE coalesce(name_tag, name_vi, name_en) IS NOT NULL""",
)
def _(spark, sf):
    text = V.areas(spark, sf).select(F.to_json(F.struct("elements")).alias("json"))
    raw = text.select(F.from_json("json", schemas.OVERPASS).alias("r")).select("r.*")
    return N.overpass(raw).select("source", "source_id", "name", "lat", "lon", "category")


@query(
    "norm_overpass_flat",
    W("el") + """SELECT CAST(id AS VARCHAR) AS osm_id, type AS osm_type, lat, lon, name_tag AS name, name_en, amenity, tourism, historic FROM el
 UNION ALL SELECT CAST(-id AS VARCHAR), 'node', 1.0, 1.0, NULL, NULL, NULL, 'attraction', NULL FROM el""",
)
def _(spark, sf):
    return N.overpass_flat(V.areas(spark, sf)).drop("tags")


@query(
    "norm_google_local",
    W("poi") + """SELECT 'google_local' AS source, name AS title, name, category,
 CASE WHEN osm_id % 5 = 0 THEN concat('d', CAST(osm_id AS VARCHAR)) ELSE CAST(osm_id AS VARCHAR) END AS source_id,
 CASE WHEN osm_id % 5 = 0 THEN concat('d', CAST(osm_id AS VARCHAR)) ELSE CAST(osm_id AS VARCHAR) END AS place_id,
 rating, review_count AS reviews, CASE WHEN osm_id % 2 = 0 THEN concat(category, ',', brand) ELSE category END AS types,
 lat, lon FROM poi""",
)
def _(spark, sf):
    i = F.col("osm_id")
    item = F.struct(
        F.col("name").alias("title"),
        F.when(i % 5 != 0, i.cast("string")).alias("place_id"),
        F.concat(F.lit("d"), i.cast("string")).alias("data_id"),
        "rating",
        F.col("review_count").alias("reviews"),
        F.when(i % 2 == 0, F.array("category", "brand")).alias("types"),
        F.col("category").alias("type"),
        F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("gps_coordinates"),
    )
    shape = (
        F.when(i % 3 == 0, F.to_json(F.array(item)))
        .when(i % 3 == 1, F.to_json(F.struct(F.array(item).alias("places"))))
        .otherwise(F.to_json(F.struct(F.array(item).alias("results"))))
    )
    flat = N.google_local(V.poi(spark, sf).select(shape.alias("local_results")))
    return flat.select(
        "source", "title", "name", "category", "source_id", "place_id", "rating", "reviews",
        F.concat_ws(",", "types").alias("types"), "lat", "lon",
    )


@query(
    "norm_tripadvisor",
    W("poi") + """SELECT 'tripadvisor' AS source, name AS title, CAST(osm_id AS VARCHAR) AS place_id, rating,
 review_count AS reviews_count, brand AS location_string FROM poi""",
)
def _(spark, sf):
    i = F.col("osm_id")
    item = F.struct(
        F.col("name").alias("title"),
        i.cast("string").alias("place_id"),
        "rating",
        F.when(i % 2 == 0, F.col("review_count")).alias("reviews"),
        F.when(i % 2 == 1, F.col("review_count")).alias("num_reviews"),
        F.col("brand").alias("location_string"),
    )
    body = F.when(i % 3 == 0, F.to_json(F.struct(F.array(item).alias("results")))).otherwise(
        F.to_json(F.struct(F.array(item).alias("places")))
    )
    raw = V.poi(spark, sf).select(F.from_json(body, schemas.REVIEW_SITE).alias("r")).select("r.*")
    return N.tripadvisor(raw).select("source", "title", "place_id", "rating", "reviews_count", "location_string")


@query(
    "norm_details",
    W("poi") + """SELECT concat(' ', name, ' ') AS name, concat(brand, ' street') AS address, lat AS latitude, lon AS longitude,
 rating, review_count, CASE WHEN osm_id % 4 <> 0 THEN concat('http://example.com/', CAST(osm_id AS VARCHAR)) END AS website,
 CASE WHEN osm_id % 3 = 0 THEN concat('+84 ', CAST(osm_id AS VARCHAR)) END AS phone,
 concat(lower(category), ',point_of_interest') AS types FROM poi WHERE rating IS NOT NULL""",
)
def _(spark, sf):
    return N.details(V.enriched(spark, sf)).withColumn("types", F.concat_ws(",", "types"))


@query(
    "child_tables",
    W("poi") + """SELECT osm_id AS place, 'review' AS child, t.n AS position, brand AS label, CAST(1 + osm_id % 5 AS INTEGER) AS number
 FROM poi CROSS JOIN (VALUES (0), (1)) t(n) WHERE rating IS NOT NULL
 UNION ALL SELECT osm_id, 'hours', 0, '0900', CAST(osm_id % 7 AS INTEGER) FROM poi WHERE rating IS NOT NULL
 UNION ALL SELECT osm_id, 'photo', 0, name, 600 FROM poi WHERE rating IS NOT NULL AND osm_id % 2 = 0""",
)
def _(spark, sf):
    records = V.enriched(spark, sf).withColumn("place", F.col("osm_data.osm_id"))
    child = N.child_tables(records, "place")

    def shown(name, kind, label, number):
        return child[name].select(
            "place", F.lit(kind).alias("child"), "position", F.col(label).alias("label"), F.col(number).alias("number")
        )

    return (
        shown("reviews", "review", "author_name", "rating")
        .unionByName(shown("opening_hours", "hours", "open_time", "open_day"))
        .unionByName(shown("photos", "photo", "photo_reference", "height"))
    )


# Selectors


@query(
    "tag_select",
    W("el") + """SELECT id, type, 'wide' AS clauses FROM el WHERE tourism IS NOT NULL OR historic IS NOT NULL
 OR (type = 'node' AND amenity = 'restaurant') OR leisure = 'park'
 UNION ALL SELECT id, type, 'narrow' FROM el WHERE tourism IN ('attraction', 'museum') OR historic IS NOT NULL""",
)
def _(spark, sf):
    """The wide list of clauses, and the narrow one for heritage."""
    wide = N.select_by_tags(V.elements(spark, sf)).select("id", "type", F.lit("wide").alias("clauses"))
    narrow = N.select_by_tags(V.elements(spark, sf), tuple(K.HERITAGE_CLAUSES))
    return wide.unionByName(narrow.select("id", "type", F.lit("narrow").alias("clauses")))


@query(
    "candidates",
    W("el") + """SELECT id AS osm_id, name_tag AS name, lat, lon FROM el WHERE name_tag IS NOT NULL
 AND coalesce(tourism, '') NOT IN ('hotel', 'guest_house', 'hostel', 'information', 'apartment')
 AND (tourism = 'attraction' OR tourism LIKE '%museum%' OR historic IS NOT NULL)""",
)
def _(spark, sf):
    return N.enrichment_candidates(V.elements(spark, sf)).select("osm_id", "name", "lat", "lon")


@query("coord_fallback", W("el") + "SELECT id, lat, lon FROM el")
def _(spark, sf):
    return N.fallback_coords(V.elements(spark, sf)).select("id", "lat", "lon")


@query(
    "name_fallback",
    W("el") + "SELECT id, coalesce(name_tag, name_vi, name_en) AS name, coalesce(tourism, amenity, historic) AS category FROM el",
)
def _(spark, sf):
    return N.fallback_name(V.elements(spark, sf)).select("id", "name", "category")


@query(
    "daily_batch",
    W("poi") + """SELECT osm_id, name FROM (SELECT osm_id, name, row_number() OVER (ORDER BY name, osm_id) - 1 AS i,
 count(*) OVER () AS n FROM poi) WHERE ((i - (360 * 500) % n) % n + n) % n < least(500, n)""",
)
def _(spark, sf):
    return daily_batch(V.poi(spark, sf).select("osm_id", "name"), ["name", "osm_id"], 360, 500)


# Landing and tables: written below the shared scratch folder, read back, compared with the places.


def _landed(spark, sf, root, *runs):
    for run_id, shift in runs or (("run_1", 0.0),):
        records = V.enriched(spark, sf, run_id, shift).drop("source", "snapshot_date", "run_id")
        B.land_bronze(records, root, SOURCE, V.SNAPSHOT, run_id)
    return B.read_bronze(spark, root, SOURCE, schemas.ENRICHED)


LANDED = f"""SELECT osm_id, lat, lon, rating, '{SOURCE}' AS source, DATE '{V.SNAPSHOT}' AS snapshot_date, 'run_1' AS run_id FROM poi"""


@query("read_bronze", W("poi") + LANDED)
def _(spark, sf):
    raw = _landed(spark, sf, scratch_path(spark, "bronze"))
    return raw.select(
        "osm_data.osm_id", "osm_data.lat", "osm_data.lon", "google_data.rating", "source", "snapshot_date", "run_id"
    )


@query(
    "land",
    W("poi") + f"""SELECT '{SOURCE}' AS source, DATE '{V.SNAPSHOT}' AS snapshot_date, r.run_id, count(*) AS n
 FROM poi CROSS JOIN (VALUES ('run_1'), ('run_2')) r(run_id) GROUP BY r.run_id""",
)
def _(spark, sf):
    root = scratch_path(spark, "bronze")
    # The second landing of run_1 replaces the first.
    raw = _landed(spark, sf, root, ("run_1", 0.0), ("run_2", 0.0), ("run_1", 0.1))
    return raw.groupBy("source", "snapshot_date", "run_id").agg(F.count("*").alias("n"))


@query("optional_fields", W("poi") + "SELECT osm_id, name, CAST(NULL AS VARCHAR) AS website, CAST(NULL AS DOUBLE) AS rating FROM poi")
def _(spark, sf):
    root = scratch_path(spark, "bronze")
    bare = V.poi(spark, sf).select(F.struct("osm_id", "name").alias("osm_data"))
    B.land_bronze(bare, root, SOURCE, V.SNAPSHOT, "run_1")
    raw = B.read_bronze(spark, root, SOURCE, schemas.ENRICHED)
    return raw.select("osm_data.osm_id", "osm_data.name", "google_data.website", "google_data.rating")


@query("empty_input", W("poi") + "SELECT osm_id, name FROM poi")
def _(spark, sf):
    # A source that never landed adds no rows.
    nothing = B.read_bronze(spark, scratch_path(spark, "bronze"), SOURCE, schemas.ENRICHED)
    return V.poi(spark, sf).select("osm_id", "name").unionByName(nothing.select("osm_data.osm_id", "osm_data.name"))


@query(
    "land_if_absent",
    W("poi") + "SELECT 'landed,SKIPPED,landed' AS outcome, count(*) AS n FROM poi",
)
def _(spark, sf):
    root = scratch_path(spark, "bronze")
    rows = V.poi(spark, sf).select("osm_id", "name")
    results = [
        B.land_if_absent(rows, root, SOURCE, V.SNAPSHOT, "run_1"),
        B.land_if_absent(rows, root, SOURCE, V.SNAPSHOT, "run_2"),
        B.land_if_absent(rows, root, SOURCE, V.SNAPSHOT, "run_1", force=True),
    ]
    outcome = ",".join(r if r == "SKIPPED" else "landed" for r in results)
    raw = B.read_bronze(spark, root, SOURCE, "osm_id bigint, name string")
    return raw.agg(F.count("*").alias("n")).select(F.lit(outcome).alias("outcome"), "n")


@query(
    "anti_landed",
    W("poi_snap") + """SELECT DISTINCT snapshot_date, CASE WHEN osm_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source
 FROM poi_snap WHERE NOT (osm_id % 2 = 0 AND snapshot_date < DATE '1997-01-01')""",
)
def _(spark, sf):
    source = F.when(F.col("osm_id") % 2 == 0, "even").otherwise("odd").alias("source")
    wanted = V.poi_snap(spark, sf).select("snapshot_date", source).distinct()
    landed = wanted.where((F.col("source") == "even") & (F.col("snapshot_date") < F.lit(date(1997, 1, 1))))
    return B.not_landed(wanted, landed)


@query(
    "manifest",
    """SELECT event_type AS source, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS record_count, max(event_id) AS ingested_at
 FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    root = scratch_path(spark, "bronze")
    events = V.table(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.to_date("ts").cast("string").alias("date"), "event_id"
    )
    B.land_by_date(events, root)
    landed = spark.read.schema("event_id bigint, source string, date string").json(root)
    return B.landing_manifest(landed, ts="event_id")


@query(
    "partitions",
    W("poi") + f"""SELECT DISTINCT '{SOURCE}' AS source, DATE '{V.SNAPSHOT}' AS snapshot_date, r.run_id, true AS has_files
 FROM poi CROSS JOIN (VALUES ('run_1'), ('run_2')) r(run_id)""",
)
def _(spark, sf):
    root = scratch_path(spark, "bronze")
    _landed(spark, sf, root, ("run_1", 0.0), ("run_2", 0.0))
    listed = B.list_partitions(spark, root, SOURCE)
    return listed.select("source", "snapshot_date", "run_id", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


@query("read_table", W("poi") + "SELECT osm_id, name, rating FROM poi")
def _(spark, sf):
    path = scratch_path(spark, "table")
    T.write_mart(V.poi(spark, sf), path)
    return T.read_table(spark, path).select("osm_id", "name", "rating")


@query("read_csv", W("poi") + "SELECT osm_id, name, lat, rating FROM poi")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    V.poi(spark, sf).select("osm_id", "name", "lat", "rating").write.csv(path, header=True)
    return B.read_csv(spark, path, "osm_id bigint, name string, lat double, rating double")


@query(
    "export_seed",
    W("poi") + "SELECT osm_id, name, rating, 'parquet' AS format FROM poi UNION ALL SELECT osm_id, name, rating, 'json' FROM poi",
)
def _(spark, sf):
    path = scratch_path(spark, "seed")
    T.export_seed(V.poi(spark, sf).select("osm_id", "name", "rating"), path)
    schema = "osm_id bigint, name string, rating double"
    parquet = spark.read.schema(schema).parquet(f"{path}/parquet").withColumn("format", F.lit("parquet"))
    json = spark.read.schema(schema).json(f"{path}/json").withColumn("format", F.lit("json"))
    return parquet.unionByName(json)


@query("write_mart", W("gold") + "SELECT attraction_key, name, district_name FROM gold")
def _(spark, sf):
    path = scratch_path(spark, "mart")
    mart = V.gold(spark, sf).select("attraction_key", "name", "district_name")
    T.write_mart(mart, path)
    T.write_mart(mart, path)  # a full refresh leaves one copy
    return T.read_table(spark, path)


@query(
    "write_by_date",
    W("poi_snap") + """SELECT osm_id, snapshot_date AS report_date, CASE WHEN snapshot_date >= DATE '1999-01-01' THEN -rating ELSE rating END AS rating
 FROM poi_snap""",
)
def _(spark, sf):
    path = scratch_path(spark, "mart")
    rows = V.poi_snap(spark, sf).select("osm_id", F.col("snapshot_date").alias("report_date"), "rating")
    T.write_mart(rows, path, "report_date")
    # Only the dates of the second write are replaced.
    later = rows.where(F.col("report_date") >= F.lit(date(1999, 1, 1)))
    T.write_mart(later.withColumn("rating", -F.col("rating")), path, "report_date")
    return T.read_table(spark, path).select("osm_id", "report_date", "rating")


SILVER = """SELECT osm_id, array_to_string(list_transform(string_split(trim(lower(name)), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name,
 CASE WHEN rating IS NOT NULL THEN concat(brand, ' street') WHEN osm_id % 20 = 0 THEN brand END AS address,
 lat AS latitude, lon AS longitude, round(rating{shift}, 6) AS rating, CASE WHEN rating IS NOT NULL THEN review_count END AS review_count,
 CASE WHEN rating IS NOT NULL AND osm_id % 4 <> 0 THEN concat('http://example.com/', CAST(osm_id AS VARCHAR)) END AS website,
 concat_ws(',', CASE WHEN rating IS NOT NULL THEN concat(lower(category), ',point_of_interest') END,
  CASE WHEN osm_id % 2 = 0 THEN 'attraction' END, CASE WHEN osm_id % 7 = 0 THEN 'monument' END) AS poi_types,
 {run} AS run_id, DATE '2024-06-01' AS snapshot_date {key} FROM poi"""
SILVER_COLUMNS = ["osm_id", "name", "address", "latitude", "longitude", "rating", "review_count", "website"]


def _silver_shown(silver, *more):
    return silver.withColumn("rating", F.round("rating", 6)).select(
        *SILVER_COLUMNS, F.concat_ws(",", "poi_types").alias("poi_types"), "run_id", "snapshot_date", *more
    )


@query("flatten_enriched", W("poi") + SILVER.format(shift="", run="'run_1'", key="").replace(
    "array_to_string(list_transform(string_split(trim(lower(name)), ' '), lambda w: upper(w[1]) || w[2:]), ' ')",
    "CASE WHEN rating IS NOT NULL THEN concat(' ', name, ' ') ELSE name END"))
def _(spark, sf):
    return _silver_shown(clean.flatten_enriched(V.enriched(spark, sf)))


@query(
    "fuse_sources",
    W("poi") + """SELECT osm_id, CASE WHEN rating IS NOT NULL THEN concat(' ', name, ' ') ELSE name END AS name, lat AS latitude, lon AS longitude
 FROM poi""",
)
def _(spark, sf):
    # The element's own coordinates are wrong where the details record has better ones.
    moved = F.col("osm_data").withField("lat", F.when(F.col("google_data").isNull(), F.col("osm_data.lat")).otherwise(0.5))
    records = V.enriched(spark, sf).withColumn("osm_data", moved)
    return clean.flatten_enriched(records).select("osm_id", "name", "latitude", "longitude")


SILVER_RUN_2 = W("poi") + SILVER.format(shift=" + 0.1", run="'run_2'", key=f", {V.TYPED_ID} AS business_key")


@query("silver", SILVER_RUN_2)
def _(spark, sf):
    raw = _landed(spark, sf, scratch_path(spark, "bronze"), ("run_1", 0.0), ("run_2", 0.1))
    return _silver_shown(build_silver(raw, STAMP), "business_key")


@query("write_silver", SILVER_RUN_2)
def _(spark, sf):
    raw = _landed(spark, sf, scratch_path(spark, "bronze"), ("run_1", 0.0), ("run_2", 0.1))
    path = scratch_path(spark, "silver")
    T.write_silver(build_silver(raw, STAMP), path)
    return _silver_shown(T.read_table(spark, path), "business_key")


@query(
    "medallion",
    W("poi", "districts") + """, s AS (SELECT osm_id, array_to_string(list_transform(string_split(trim(lower(name)), ' '),
 lambda w: upper(w[1]) || w[2:]), ' ') AS name, CASE WHEN rating IS NOT NULL THEN lower(category) WHEN osm_id % 2 = 0 THEN 'attraction'
 WHEN osm_id % 7 = 0 THEN 'monument' END AS category, lat, lon, rating, CASE WHEN rating IS NOT NULL THEN review_count END AS n FROM poi),
 d AS (SELECT s.*, g.district_name, row_number() OVER (PARTITION BY s.name, s.lat, s.lon ORDER BY
  (s.lat-g.center_lat)*(s.lat-g.center_lat)+(s.lon-g.center_lon)*(s.lon-g.center_lon), g.district_name, """ + V.TYPED_ID + """) AS rn
  FROM s CROSS JOIN districts g)
 SELECT district_name, count(*) AS poi_count, round(avg(rating) + 1e-9, 6) AS district_avg_rating,
 round(sum(rating * log10(n + 1)), 4) AS total_district_popularity, count(DISTINCT category) AS category_diversity,
 DATE '2024-06-01' AS snapshot_date FROM d WHERE rn = 1 GROUP BY district_name""",
)
def _(spark, sf):
    root = scratch_path(spark, "lake")
    _landed(spark, sf, f"{root}/bronze")
    paths = Paths(f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    made = run_medallion(spark, paths, V.districts(spark, sf), V.SNAPSHOT, SOURCE, STAMP)
    return made["gold_district_benchmarking"].select(
        "district_name", "poi_count", F.round(F.col("district_avg_rating") + 1e-9, 6).alias("district_avg_rating"),
        F.round("total_district_popularity", 4).alias("total_district_popularity"), "category_diversity", "snapshot_date",
    )


# Storage


def _file_a_year(spark, sf):
    """The history in one file a year, each written as its rows come, without a sort.

    Each file has a task, or few share one, which keeps them open side by side.
    """
    path, writers = scratch_path(spark, "table"), "spark.sql.maxConcurrentOutputFileWriters"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    history = V.poi_snap(spark, sf).withColumn("snapshot_date", F.trunc("snapshot_date", "year"))
    before = spark.conf.get(writers)
    spark.conf.set(writers, "16")
    try:
        dealt = history.repartition(tasks, "snapshot_date").write.option("parquet.block.size", 16 << 20)
        dealt.partitionBy("snapshot_date").parquet(path)
    finally:
        spark.conf.set(writers, before)
    return path


@query(
    "storage_stats",
    """SELECT 'silver' AS layer, count(DISTINCT date_trunc('year', l_shipdate)) AS object_count, true AS has_size FROM lineitem
 UNION ALL SELECT 'gold', 0, false""",
)
def _(spark, sf):
    path = _file_a_year(spark, sf)
    stats = T.storage_stats(spark, {"silver": path, "gold": path + "-none"})
    return stats.select("layer", "object_count", (F.col("total_size_mb") > 0).alias("has_size"))


# Quality


def _rule(name, sql, rule, view=V.poi, view_sql="poi"):
    @query(name, W(view_sql) + f"SELECT {sql} FROM {view_sql}")
    def _(spark, sf):
        return Q.run_suite(view(spark, sf), [rule])


def _rule_sql(rule, column, failing):
    return (
        f"'{rule}' AS rule, '{column}' AS \"column\", count(*) FILTER (WHERE {failing}) AS failed, count(*) AS total, "
        f"count(*) FILTER (WHERE {failing}) = 0 AS success"
    )


_rule("rule_not_null", _rule_sql("not_null", "rating", "rating IS NULL"), Q.not_null("rating"))
_rule(
    "rule_values",
    _rule_sql("accepted_values", "category", "category NOT IN ('ECONOMY', 'PROMO')"),
    Q.accepted_values("category", ["ECONOMY", "PROMO"]),
)
_rule("rule_range", _rule_sql("accepted_range", "rating", "rating < 2 OR rating > 4"), Q.accepted_range("rating", 2, 4))
_rule(
    "rule_popularity",
    _rule_sql("accepted_range", "popularity_score", "popularity_score < 0 OR popularity_score > 8"),
    Q.accepted_range("popularity_score", 0, 8), V.gold, "gold",
)
UNIQUE = """SELECT 'unique' AS rule, '{label}' AS "column", CAST(sum(n) - count(*) AS BIGINT) AS failed, CAST(sum(n) AS BIGINT) AS total,
 sum(n) = count(*) AS success FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})"""


@query(
    "rule_unique",
    W("gold") + UNIQUE.format(label="name,snapshot_date", keys="name, snapshot_date", source="gold")
    + " UNION ALL " + UNIQUE.format(label="attraction_key", keys="attraction_key", source="gold"),
)
def _(spark, sf):
    return Q.run_suite(V.gold(spark, sf), [Q.unique("name", "snapshot_date"), Q.unique("attraction_key")])


@query(
    "suite",
    W("poi") + "SELECT "
    + " FROM poi UNION ALL SELECT ".join(
        [
            _rule_sql("not_null", "osm_id", "osm_id IS NULL"),
            _rule_sql("not_null", "name", "name IS NULL"),
            _rule_sql("accepted_range", "rating", "rating < 0 OR rating > 5"),
            _rule_sql("accepted_range", "latitude", "true"),
            _rule_sql("accepted_range", "longitude", "true"),
        ]
    )
    + " FROM poi",
)
def _(spark, sf):
    # The places call their coordinates lat and lon: both coordinate rules miss their column.
    return Q.run_suite(V.poi(spark, sf), Q.gold_rules())


@query(
    "quarantine",
    W("poi") + """SELECT osm_id, concat_ws(';', CASE WHEN rating IS NULL THEN 'not_null:rating' END,
 CASE WHEN lat < 20.8 OR lat > 21.2 THEN 'accepted_range:lat' END) AS reasons FROM poi""",
)
def _(spark, sf):
    rules = [Q.not_null("rating"), Q.accepted_range("lat", 20.8, 21.2)]
    good, bad = Q.quarantine(V.poi(spark, sf).select("osm_id", "rating", "lat"), rules)
    return good.select("osm_id", F.lit("").alias("reasons")).unionByName(
        bad.select("osm_id", F.concat_ws(";", "reasons").alias("reasons"))
    )


@query(
    "layer_reconcile",
    W("poi", "gold") + """SELECT a AS rows_a, b AS rows_b, round(abs(a - b) / CAST(a AS DOUBLE), 6) AS difference,
 abs(a - b) / CAST(a AS DOUBLE) > CAST(0.1 AS DOUBLE) AS alert FROM (SELECT (SELECT count(*) FROM poi) AS a,
 (SELECT count(*) FROM gold WHERE avg_rating >= 2) AS b)""",
)
def _(spark, sf):
    return Q.reconcile(V.poi(spark, sf), V.gold(spark, sf).where(F.col("avg_rating") >= 2))


@query("missing_keys", W("gold") + "SELECT attraction_key FROM gold WHERE avg_rating IS NULL OR avg_rating < 2")
def _(spark, sf):
    gold = V.gold(spark, sf)
    return Q.missing_keys(gold, gold.where(F.col("avg_rating") >= 2), ["attraction_key"])


@query(
    "bad_paths",
    W("poi") + "SELECT count(*) > 0 AS found, 'snapshot_date=20240601' AS folder FROM poi",
)
def _(spark, sf):
    root = scratch_path(spark, "bronze")
    _landed(spark, sf, root)
    B.land_bronze(V.poi(spark, sf), root, SOURCE, "20240601", "run_1")
    folder = F.regexp_extract("path", "(snapshot_date=[^/]+)", 1).alias("folder")
    return Q.bad_paths(spark, root).groupBy(folder).agg((F.count("*") > 0).alias("found"))


@query(
    "idempotency",
    W("poi") + "SELECT true AS equal_content, count(*) AS rows_first, count(*) AS rows_second, CAST(0 AS BIGINT) AS duplicate_keys FROM poi",
)
def _(spark, sf):
    raw = _landed(spark, sf, scratch_path(spark, "bronze"), ("run_1", 0.0), ("run_2", 0.1))
    runs = []
    for _ in range(2):
        path = scratch_path(spark, "silver")
        T.write_silver(build_silver(raw), path)
        runs.append(T.read_table(spark, path))
    return Q.idempotent(*runs, keys=["business_key", "snapshot_date"], ignore=["silver_processed_at"])

