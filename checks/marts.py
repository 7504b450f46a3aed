"""Marts, district assignment, scores and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks import views as V
from checks.core import query
from poilake.functions import geodesy as G
from poilake.functions import scores as S
from poilake.functions import text as T
from poilake.operators import clean, geo, profiles, report
from poilake.plans import marts
from poilake.session import scratch_path
from poilake.sources import tables

W = V.with_views


def settle(column, digits=6):
    """Round a mean the same way on both sides: the offset takes exact halves off the edge."""
    return F.round(F.col(column) + 1e-9, digits).alias(column)


def r6(*columns):
    return [settle(c) for c in columns]


GOLD_COLUMNS = [
    "attraction_key", "name", "category", "lat", "lon", "avg_rating", "source_count", "sources",
    "reliability_level", "district_name", "snapshot_date",
]


@query(
    "gold_attractions",
    W("gold") + f"SELECT {', '.join(GOLD_COLUMNS)}, round(popularity_score, 6) AS popularity_score FROM gold",
)
def _(spark, sf):
    return V.gold(spark, sf).select(*GOLD_COLUMNS, F.round("popularity_score", 6).alias("popularity_score"))


BENCHMARKING = W("gold") + """SELECT snapshot_date, district_name, count(*) AS poi_count,
 round(avg(avg_rating) + 1e-9, 6) AS district_avg_rating, round(sum(popularity_score), 4) AS total_district_popularity,
 count(DISTINCT category) AS category_diversity FROM gold GROUP BY snapshot_date, district_name"""


@query("district_benchmarking", BENCHMARKING)
def district_benchmarking(spark, sf):
    return marts.district_benchmarking(V.gold(spark, sf)).select(
        "snapshot_date", "district_name", "poi_count", *r6("district_avg_rating"),
        F.round("total_district_popularity", 4).alias("total_district_popularity"), "category_diversity",
    )


@query(
    "executive_overview",
    W("gold") + """SELECT snapshot_date, count(*) AS total_pois, round(avg(avg_rating) + 1e-9, 6) AS city_avg_rating,
 CAST(sum(source_count) AS BIGINT) AS total_interactions, count(DISTINCT district_name) AS districts_covered
 FROM gold GROUP BY snapshot_date""",
)
def _(spark, sf):
    return marts.executive_overview(V.gold(spark, sf)).select(
        "snapshot_date", "total_pois", *r6("city_avg_rating"), "total_interactions", "districts_covered"
    )


@query(
    "service_accessibility",
    W("gold") + """SELECT snapshot_date, category, district_name, reliability_level, count(*) AS total_locations,
 CAST(sum(CASE WHEN reliability_level = 'High' THEN 1 ELSE 0 END) AS BIGINT) AS verified_count,
 round(avg(popularity_score) + 1e-9, 6) AS avg_popularity
 FROM gold GROUP BY snapshot_date, category, district_name, reliability_level""",
)
def _(spark, sf):
    mart = marts.service_accessibility(V.gold(spark, sf))
    return mart.withColumn("avg_popularity", settle("avg_popularity"))


ALERTS = """SELECT snapshot_date, name, category, avg_rating, reliability_level,
 CASE WHEN avg_rating < 3.0 THEN 'CRITICAL' WHEN avg_rating < 4.0 THEN 'WARNING' ELSE 'HEALTHY' END AS health_status
 FROM gold WHERE avg_rating < 4.0"""


@query("quality_alerts", W("gold") + ALERTS)
def _(spark, sf):
    return marts.quality_alerts(V.gold(spark, sf))


@query(
    "heatmap_feed",
    W("gold") + """SELECT snapshot_date, name, category, lat, lon, avg_rating,
 round(popularity_score, 6) AS popularity_score, district_name FROM gold WHERE lat IS NOT NULL AND lon IS NOT NULL""",
)
def _(spark, sf):
    return marts.heatmap_feed(V.gold(spark, sf)).withColumn("popularity_score", F.round("popularity_score", 6))


@query(
    "district_stats",
    W("poi_history") + """SELECT snapshot_date AS report_date, district_name AS district, count(*) AS total_attractions,
 round(avg(rating) + 1e-9, 6) AS avg_rating, CAST(sum(review_count) AS BIGINT) AS total_reviews, max(review_count) AS max_reviews
 FROM poi_history GROUP BY snapshot_date, district_name""",
)
def _(spark, sf):
    history = V.poi_history(spark, sf).withColumnsRenamed({"snapshot_date": "report_date", "district_name": "district"})
    return marts.district_stats(history).withColumn("avg_rating", settle("avg_rating"))


def _history_gold(spark, sf):
    return V.poi_history(spark, sf).withColumnsRenamed({"rating": "avg_rating", "review_count": "source_count"})


TIMELINE = """SELECT snapshot_date, count(*) AS total_pois, round(avg(rating) + 1e-9, 6) AS city_avg_rating,
 CAST(sum(review_count) AS BIGINT) AS total_interactions, count(DISTINCT district_name) AS districts_covered
 FROM poi_history GROUP BY snapshot_date"""


@query("timeline", W("poi_history") + TIMELINE)
def _(spark, sf):
    return marts.timeline(_history_gold(spark, sf)).withColumn("city_avg_rating", settle("city_avg_rating"))


@query(
    "date_slider",
    W("poi_snap") + "SELECT osm_id, snapshot_date, rating, review_count FROM poi_snap "
    "WHERE snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'",
)
def _(spark, sf):
    return clean.in_dates(V.poi_snap(spark, sf), "1996-01-01", "1996-06-30")


@query(
    "rating_delta",
    W("poi_snap") + """SELECT osm_id, snapshot_date, rating, lag(rating) OVER w AS previous_rating,
 round(rating - lag(rating) OVER w, 6) AS rating_delta FROM poi_snap
 WINDOW w AS (PARTITION BY osm_id ORDER BY snapshot_date)""",
)
def _(spark, sf):
    return report.rating_delta(V.poi_snap(spark, sf), ["osm_id"])


@query(
    "district_rank",
    W("poi_history") + """SELECT snapshot_date, district_name, avg_rating,
 CAST(rank() OVER (PARTITION BY snapshot_date ORDER BY avg_rating DESC) AS INTEGER) AS rank,
 CAST(dense_rank() OVER (PARTITION BY snapshot_date ORDER BY avg_rating DESC) AS INTEGER) AS dense_rank
 FROM (SELECT snapshot_date, district_name, round(avg(rating) + 1e-9, 4) AS avg_rating
       FROM poi_history GROUP BY snapshot_date, district_name)""",
)
def _(spark, sf):
    stats = marts.district_stats(V.poi_history(spark, sf), "snapshot_date", "district_name")
    rounded = stats.select("snapshot_date", "district_name", settle("avg_rating", 4))
    return report.district_rank(rounded, "avg_rating")


@query(
    "rating_drop",
    W("poi_snap") + """SELECT * FROM (SELECT osm_id, snapshot_date, rating, round(base, 6) AS baseline,
 round(round(base, 6) - rating, 6) AS "drop" FROM (SELECT *, avg(rating) OVER (PARTITION BY osm_id ORDER BY snapshot_date
 ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS base FROM poi_snap)) WHERE "drop" >= 1.5""",
)
def _(spark, sf):
    return report.rating_drop(V.poi_snap(spark, sf), ["osm_id"], 1.5)


@query(
    "star_enrich",
    W("poi_history") + """SELECT h.osm_id, h.snapshot_date, h.rating, h.district_name, d.center_lat, d.center_lon,
 coalesce(isodow(h.snapshot_date) >= 6 AND h.snapshot_date BETWEEN DATE '1992-01-01' AND DATE '2001-12-31', false) AS is_weekend,
 CASE WHEN h.snapshot_date BETWEEN DATE '1992-01-01' AND DATE '2001-12-31' THEN CAST(isodow(h.snapshot_date) AS INTEGER) END AS day_of_week,
 CASE WHEN h.snapshot_date BETWEEN DATE '1992-01-01' AND DATE '2001-12-31' THEN monthname(h.snapshot_date) END AS month_name
 FROM poi_history h LEFT JOIN districts d ON d.district_name = h.district_name""",
)
def _(spark, sf):
    dates = tables.dates_dim(spark, "1992-01-01", "2001-12-31")
    dims = [
        (V.districts(spark, sf), "district_name", "district_name"),
        (dates, "snapshot_date", "date"),
    ]
    rows = marts.star_enrich(V.poi_history(spark, sf), dims)
    return rows.select(
        "osm_id", "snapshot_date", "rating", "district_name", "center_lat", "center_lon",
        F.coalesce("is_weekend", F.lit(False)).alias("is_weekend"), "day_of_week", "month_name",
    )


# District assignment


@query("nearest_district", W("nearest") + "SELECT osm_id, lat, lon, district_name FROM nearest")
def _(spark, sf):
    places = V.poi(spark, sf).select("osm_id", "lat", "lon")
    return geo.assign_nearest(places, V.districts(spark, sf))


NEAREST_HUB = """SELECT osm_id, lat, lon, district_name FROM (SELECT p.osm_id, p.lat, p.lon, h.district_name,
  row_number() OVER (PARTITION BY p.osm_id ORDER BY (p.lat-h.center_lat)*(p.lat-h.center_lat)
  + (p.lon-h.center_lon)*(p.lon-h.center_lon), h.district_name) AS rn FROM poi p CROSS JOIN hubs h) WHERE rn = 1"""


@query("nearest_district_grid", W("poi", "hubs") + NEAREST_HUB)
def _(spark, sf):
    places = V.poi(spark, sf).select("osm_id", "lat", "lon")
    return geo.assign_nearest(places, V.hubs(spark, sf))


@query(
    "cross_distances",
    W("poi", "districts") + """SELECT osm_id, district_name, distance_sq FROM (
 SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY d2, district_name) AS rn FROM (
 SELECT p.osm_id, d.district_name, (p.lat-d.center_lat)*(p.lat-d.center_lat)+(p.lon-d.center_lon)*(p.lon-d.center_lon) AS d2,
 round((p.lat-d.center_lat)*(p.lat-d.center_lat)+(p.lon-d.center_lon)*(p.lon-d.center_lon), 9) AS distance_sq
 FROM poi p CROSS JOIN districts d)) WHERE rn <= 10""",
)
def _(spark, sf):
    """The distances that are used: those to the ten nearest centres of each place."""
    places = V.poi(spark, sf).select("osm_id", "lat", "lon")
    pairs = geo.rank_centers(places, V.districts(spark, sf), 10)
    return pairs.select("osm_id", "district_name", F.round("distance_sq", 9).alias("distance_sq"))


@query(
    "nearest_window",
    W("poi", "districts") + """SELECT * FROM (SELECT p.osm_id, d.district_name, CAST(row_number() OVER (PARTITION BY p.osm_id ORDER BY
 (p.lat-d.center_lat)*(p.lat-d.center_lat) + (p.lon-d.center_lon)*(p.lon-d.center_lon), d.district_name) AS INTEGER) AS rank_nearest
 FROM poi p CROSS JOIN districts d) WHERE rank_nearest <= 3""",
)
def _(spark, sf):
    places = V.poi(spark, sf).select("osm_id", "lat", "lon")
    return geo.rank_centers(places, V.districts(spark, sf), 3).select("osm_id", "district_name", "rank_nearest")


@query(
    "centroid_dim",
    W("poi", "fixed_districts") + """SELECT f.district_name, f.center_lat, f.center_lon, count(p.osm_id) AS places
 FROM fixed_districts f LEFT JOIN (SELECT osm_id, district_name FROM (SELECT q.osm_id, g.district_name,
  row_number() OVER (PARTITION BY q.osm_id ORDER BY (q.lat-g.center_lat)*(q.lat-g.center_lat)
  + (q.lon-g.center_lon)*(q.lon-g.center_lon), g.district_name) AS rn FROM poi q CROSS JOIN fixed_districts g)
  WHERE rn = 1) p ON p.district_name = f.district_name GROUP BY f.district_name, f.center_lat, f.center_lon""",
)
def _(spark, sf):
    dim = tables.districts_dim(spark)
    counts = (
        geo.assign_nearest(V.poi(spark, sf).select("osm_id", "lat", "lon"), dim)
        .groupBy("district_name")
        .agg(F.count("*").alias("n"))
    )
    return dim.join(counts, "district_name", "left").select(
        "district_name", "center_lat", "center_lon", F.coalesce("n", F.lit(0)).alias("places")
    )


BBOX = W("poi", "district_boxes") + """SELECT osm_id, lat, lon, coalesce(district_name, 'Unknown District') AS district_name FROM (
 SELECT p.osm_id, p.lat, p.lon, b.district_name, row_number() OVER (PARTITION BY p.osm_id
  ORDER BY (b.lat_max-b.lat_min)*(b.lon_max-b.lon_min), b.district_name) AS rn
 FROM poi p LEFT JOIN district_boxes b ON p.lat BETWEEN b.lat_min AND b.lat_max AND p.lon BETWEEN b.lon_min AND b.lon_max)
 WHERE rn = 1"""


@query("bbox_district", BBOX)
def _(spark, sf):
    places = V.poi(spark, sf).select("osm_id", "lat", "lon")
    return geo.assign_bbox(places, V.district_boxes(spark, sf))


@query("bbox_district_grid", BBOX.replace("FROM poi p LEFT JOIN district_boxes", "FROM poi p LEFT JOIN hub_boxes").replace(W("poi", "district_boxes"), W("poi", "hub_boxes")))
def _(spark, sf):
    places = V.poi(spark, sf).select("osm_id", "lat", "lon")
    return geo.assign_bbox(places, V.hub_boxes(spark, sf))


@query(
    "heat_grid",
    W("gold") + """SELECT CAST(floor(lat/CAST(0.05 AS DOUBLE)) AS BIGINT) AS cell_lat, CAST(floor(lon/CAST(0.05 AS DOUBLE)) AS BIGINT) AS cell_lon,
 round(sum(popularity_score), 4) AS weight, count(*) AS points FROM gold GROUP BY 1, 2""",
)
def _(spark, sf):
    return geo.heat_grid(V.gold(spark, sf), 0.05, "popularity_score").withColumn("weight", F.round("weight", 4))


@query(
    "marker_clusters",
    W("gold") + """SELECT zoom, tile_lat, tile_lon, markers, center_lat, center_lon,
 CASE WHEN g >= o AND g >= r THEN 'green' WHEN o >= r THEN 'orange' ELSE 'red' END AS color FROM (
 SELECT zoom, CAST(floor(lat / (CAST(360 AS DOUBLE) / pow(2, zoom))) AS BIGINT) AS tile_lat,
  CAST(floor(lon / (CAST(360 AS DOUBLE) / pow(2, zoom))) AS BIGINT) AS tile_lon,
  count(*) AS markers, round(avg(lat) + 1e-9, 6) AS center_lat, round(avg(lon) + 1e-9, 6) AS center_lon,
  count(*) FILTER (WHERE avg_rating >= 4.5) AS g, count(*) FILTER (WHERE avg_rating >= 4.0 AND avg_rating < 4.5) AS o,
  count(*) FILTER (WHERE avg_rating IS NULL OR avg_rating < 4.0) AS r
 FROM gold CROSS JOIN (VALUES (9), (11), (13)) z(zoom) GROUP BY 1, 2, 3)""",
)
def _(spark, sf):
    clusters = geo.marker_clusters(V.gold(spark, sf), [9, 11, 13], "avg_rating")
    return clusters.withColumns({"center_lat": settle("center_lat"), "center_lon": settle("center_lon")})


# Scores and labels, one query each


def _label(name, sql, column, view=V.poi, view_sql="poi", key="osm_id"):
    @query(name, W(view_sql) + f"SELECT {key}, {sql} AS {name} FROM {view_sql}")
    def _(spark, sf):
        return view(spark, sf).select(key, column().alias(name))


_label(
    "attraction_key", "md5(concat(name, CAST(lat AS VARCHAR), CAST(lon AS VARCHAR)))",
    lambda: S.attraction_key(F.col("name"), F.col("lat"), F.col("lon")),
)
_label(
    "popularity", "round(rating * log10(review_count + 1), 6)",
    lambda: F.round(S.popularity(F.col("rating"), F.col("review_count")), 6),
)
_label(
    "reliability", "CASE WHEN review_count >= 40 THEN 'High' WHEN review_count >= 25 THEN 'Medium' ELSE 'Low' END",
    lambda: S.reliability(F.col("review_count"), 40, 25),
)
_label(
    "health", "CASE WHEN rating < 3 THEN 'CRITICAL' WHEN rating < 4 THEN 'WARNING' ELSE 'HEALTHY' END",
    lambda: S.health(F.col("rating")),
)
_label(
    "sentiment",
    "CASE WHEN rating >= 4.5 THEN 'Rất hài lòng (Excellent)' WHEN rating >= 4.0 THEN 'Hài lòng (Good)' "
    "ELSE 'Cần cải thiện (Needs Improvement)' END",
    lambda: S.sentiment(F.col("rating")),
)
_label(
    "color_band", "CASE WHEN rating >= 4.5 THEN 'green' WHEN rating >= 4.0 THEN 'orange' ELSE 'red' END",
    lambda: S.color_band(F.col("rating")),
)
_label(
    "source_type",
    "CASE WHEN rating IS NOT NULL AND osm_id % 3 <> 0 THEN 'Hợp nhất (Google + OSM)' "
    "WHEN rating IS NOT NULL THEN 'Chỉ Google' ELSE 'Chỉ OSM' END",
    lambda: S.source_type(F.col("rating"), F.when(F.col("osm_id") % 3 != 0, F.col("osm_id"))),
)
_label(
    "overcrowded", "visitor_density_score > CAST(0.8 AS DOUBLE)",
    lambda: S.overcrowded(F.col("visitor_density_score")), V.fact, "fact", "place_id",
)
_label(
    "distance_sq", "round((lat - 21.0)*(lat - 21.0) + (lon - 105.8)*(lon - 105.8), 9)",
    lambda: F.round(G.distance_sq(F.col("lat"), F.col("lon"), F.lit(21.0), F.lit(105.8)), 9),
)
_label(
    "clean_name",
    "array_to_string(list_transform(string_split(lower(trim(name)), ' '), lambda w: upper(w[1]) || w[2:]), ' ')",
    lambda: T.clean_name(F.col("name")),
)
_label(
    "title_name",
    "array_to_string(list_transform(string_split(lower(trim(name)), ' '), lambda w: upper(w[1]) || w[2:]), '-') || chr(39) || 'S 2Nd'",
    lambda: T.title_name(F.concat(F.lit(" "), F.replace("name", F.lit(" "), F.lit("-")), F.lit("'s 2nd"))),
)
_label(
    "business_key",
    "CASE WHEN osm_id % 2 = 0 THEN CAST(osm_id AS VARCHAR) ELSE sha256(concat(lower(name), '_', "
    "CAST(round(lat, 4) AS VARCHAR), '_', CAST(round(lon, 4) AS VARCHAR))) END",
    lambda: S.business_key(
        F.when(F.col("osm_id") % 2 == 0, F.col("osm_id")), F.col("name"), F.col("lat"), F.col("lon")
    ),
)
_label(
    "safe_id", "replace(replace(lower(concat(category, '-', name)), ' ', '_'), '-', '_')",
    lambda: T.safe_id(F.concat("category", F.lit("-"), "name")),
)
_label("round_cols", "round(rating, 0)", lambda: S.round_to(F.col("rating"), 0))
_label("first_category", "category", lambda: S.first_category(F.array("category", "brand")))


@query(
    "coord_round",
    W("poi") + """SELECT osm_id, round(lat + osm_id % 9 / CAST(8000000 AS DOUBLE), 6) AS lat, round(lon, 6) AS lon,
 round(lat, 2) AS lat2 FROM poi""",
)
def _(spark, sf):
    return V.poi(spark, sf).select(
        "osm_id", S.round_to(F.col("lat") + F.col("osm_id") % 9 / F.lit(8000000.0), 6).alias("lat"), S.round_to(F.col("lon"), 6).alias("lon"),
        S.round_to(F.col("lat"), 2).alias("lat2"),
    )


@query(
    "run_date_parts",
    """SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
 strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp, CAST(o_orderdate AS DATE) AS order_day FROM orders""",
)
def _(spark, sf):
    orders = V.table(spark, sf, "orders")
    day = F.col("o_orderdate")
    return orders.select(
        "o_orderkey", S.day_of_year(day).alias("day_of_year"), S.utc_stamp(day).alias("stamp"),
        F.to_date(day).alias("order_day"),
    )


@query(
    "percent",
    W("poi") + """SELECT category, round(count(rating) * CAST(100 AS DOUBLE) / nullif(count(*), 0), 6) AS rated_pct
 FROM poi GROUP BY category""",
)
def _(spark, sf):
    groups = V.poi(spark, sf).groupBy("category").agg(F.count("rating").alias("part"), F.count("*").alias("total"))
    return groups.select("category", F.round(S.percent(F.col("part"), F.col("total")), 6).alias("rated_pct"))


# Filters


@query("in_bbox", W("poi") + "SELECT osm_id, lat, lon FROM poi WHERE lat BETWEEN 20.8 AND 21.2 AND lon BETWEEN 105.5 AND 105.8")
def _(spark, sf):
    return clean.in_bbox(V.poi(spark, sf), box=(20.8, 21.2, 105.5, 105.8)).select("osm_id", "lat", "lon")


@query("coords_present", W("poi") + "SELECT osm_id, lat, lon FROM poi WHERE osm_id % 4 <> 0")
def _(spark, sf):
    holes = V.poi(spark, sf).select("osm_id", F.when(F.col("osm_id") % 4 != 0, F.col("lat")).alias("lat"), "lon")
    return clean.drop_no_coords(holes)


@query("rated_only", W("poi") + "SELECT osm_id, rating FROM poi WHERE rating > 0")
def _(spark, sf):
    return clean.rated_only(V.poi(spark, sf)).select("osm_id", "rating")


@query(
    "map_category",
    W("poi") + """SELECT osm_id, category, CASE category WHEN 'ECONOMY' THEN 'Budget' WHEN 'PROMO' THEN 'Offer'
 ELSE 'Other' END AS shown_category FROM poi""",
)
def _(spark, sf):
    # The mapping is read off the data: two of the categories are given a shown name.
    raw = V.table(spark, sf, "part").select(F.col("p_type").alias("raw_category")).distinct()
    shown = F.when(F.col("raw_category") == "ECONOMY", "Budget").when(F.col("raw_category") == "PROMO", "Offer")
    dim = raw.select("raw_category", shown.alias("shown_category"))
    places = V.poi(spark, sf).select("osm_id", "category")
    return clean.map_category(places, dim, default="Other")


# Reports


@query(
    "source_mix",
    W("poi") + """SELECT CASE WHEN rating IS NOT NULL AND osm_id % 3 <> 0 THEN 'Hợp nhất (Google + OSM)'
 WHEN rating IS NOT NULL THEN 'Chỉ Google' ELSE 'Chỉ OSM' END AS data_source_type, count(*) AS n FROM poi GROUP BY 1""",
)
def _(spark, sf):
    places = V.poi(spark, sf).withColumn("osm_id", F.when(F.col("osm_id") % 3 != 0, F.col("osm_id")))
    return report.source_mix(places)


@query(
    "completeness",
    W("poi") + """SELECT 'rating' AS field, count(rating) AS present, round(count(rating)*CAST(100 AS DOUBLE)/count(*), 6) AS percentage FROM poi
 UNION ALL SELECT 'name', count(name), round(count(name)*CAST(100 AS DOUBLE)/count(*), 6) FROM poi
 UNION ALL SELECT 'brand', count(brand), round(count(brand)*CAST(100 AS DOUBLE)/count(*), 6) FROM poi""",
)
def _(spark, sf):
    return report.completeness(V.poi(spark, sf), ["rating", "name", "brand"])


@query(
    "sentiment_counts",
    W("poi") + """SELECT CASE WHEN rating >= 4.5 THEN 'Rất hài lòng (Excellent)' WHEN rating >= 4.0 THEN 'Hài lòng (Good)'
 ELSE 'Cần cải thiện (Needs Improvement)' END AS sentiment_label, count(*) AS n FROM poi WHERE rating IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    return report.sentiment_counts(V.poi(spark, sf))


@query(
    "per_source_counts",
    W("poi", "poi_b") + "SELECT 'google' AS source, count(*) AS n FROM poi UNION ALL SELECT 'osm', count(*) FROM poi_b",
)
def _(spark, sf):
    google, osm = V.places(spark, sf)
    return report.per_source_counts(google.unionByName(osm))


@query(
    "rating_box",
    W("gold") + """SELECT district_name, min(avg_rating) AS low, round(quantile_cont(avg_rating, 0.25) + 1e-9, 6) AS q1,
 round(quantile_cont(avg_rating, 0.5) + 1e-9, 6) AS median, round(quantile_cont(avg_rating, 0.75) + 1e-9, 6) AS q3,
 max(avg_rating) AS high, count(*) AS n FROM gold WHERE avg_rating > 0 GROUP BY district_name""",
)
def _(spark, sf):
    box = report.rating_box(V.gold(spark, sf), "district_name")
    return box.select("district_name", "low", *r6("q1", "median", "q3"), "high", "n")


@query(
    "rating_corr",
    W("poi") + "SELECT round(corr(rating, review_count) + 1e-9, 6) AS correlation, count(*) AS n FROM poi WHERE rating > 0",
)
def _(spark, sf):
    return report.rating_corr(V.poi(spark, sf)).withColumn("correlation", settle("correlation"))


@query(
    "rating_bins",
    W("poi") + """SELECT CAST(floor(rating / CAST(0.5 AS DOUBLE)) AS BIGINT) AS rating_bin,
 CAST(floor(review_count / CAST(10 AS DOUBLE)) AS BIGINT) AS review_bin, count(*) AS n FROM poi WHERE rating > 0 GROUP BY 1, 2""",
)
def _(spark, sf):
    return report.rating_bins(V.poi(spark, sf))


@query(
    "rating_by_category",
    W("gold") + """SELECT category, round(avg(avg_rating) + 1e-9, 6) AS avg_rating,
 round(avg(CASE WHEN avg_rating >= 4.0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100 + 1e-9, 6) AS high_rating_pct, count(*) AS n
 FROM gold GROUP BY category""",
)
def _(spark, sf):
    shares = report.rating_by_category(V.gold(spark, sf))
    return shares.withColumns({"avg_rating": settle("avg_rating"), "high_rating_pct": settle("high_rating_pct")})


@query(
    "accessibility_pct",
    W("poi") + """SELECT category, round(avg(CASE WHEN rating IS NOT NULL AND osm_id % 4 <> 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)*100 + 1e-9, 6) AS website_pct,
 round(avg(CASE WHEN rating IS NOT NULL AND osm_id % 7 IN (0, 6) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)*100 + 1e-9, 6) AS weekend_pct,
 count(*) AS n FROM (SELECT *, CASE WHEN rating IS NOT NULL THEN lower(category) ELSE 'none' END AS c FROM poi) GROUP BY category""",
)
def _(spark, sf):
    rows = V.enriched(spark, sf).join(
        V.poi(spark, sf).select(F.col("osm_id").alias("id"), "category"), F.col("osm_data.osm_id") == F.col("id")
    )
    weekend = report.opens_at_weekend(F.col("google_data.opening_hours.periods"))
    shares = report.accessibility_pct(rows, F.col("google_data.website"), weekend, ["category"])
    return shares.withColumns({"website_pct": settle("website_pct"), "weekend_pct": settle("weekend_pct")})


@query("tier_counts", W("gold") + "SELECT reliability_level, count(*) AS n FROM gold GROUP BY reliability_level")
def _(spark, sf):
    return report.tier_counts(V.gold(spark, sf))


def _profile_sql(column, number):
    stats = (
        f"round(min({column}), 4) AS min_value, round(max({column}), 4) AS max_value, round(avg({column}), 4) AS mean_value"
        if number
        else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS mean_value"
    )
    return (
        f"SELECT '{column}' AS \"column\", count(*) AS rows, count({column}) AS present, "
        f"round((count(*) - count({column})) * CAST(100 AS DOUBLE) / count(*), 6) AS null_pct, "
        f"count(DISTINCT {column}) AS distinct_values, {stats} FROM poi"
    )


@query(
    "profile",
    W("poi") + " UNION ALL ".join(
        _profile_sql(c, n) for c, n in [("name", False), ("category", False), ("lat", True), ("rating", True), ("review_count", True)]
    ),
)
def _(spark, sf):
    return report.profile(V.poi(spark, sf), ["name", "category", "lat", "rating", "review_count"])


_MERGED = """SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS present,
 round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct, {numbers}, true AS distinct_close, {close} AS quantiles_close FROM events"""
_NUMBERS = "round(min({c}), 4) AS min_value, round(max({c}), 4) AS max_value, round(avg({c}), 4) AS mean_value"
_NO_NUMBERS = "NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value, NULL::DOUBLE AS mean_value"


@query(
    "profile_merged",
    " UNION ALL ".join(
        _MERGED.format(c=c, numbers=(_NUMBERS if number else _NO_NUMBERS).format(c=c), close="true" if number else "NULL::BOOLEAN")
        for c, number in [("event_id", True), ("user_id", True), ("event_type", False), ("value", True), ("props", False)]
    ),
)
def _(spark, sf):
    """Events profiled by day and merged; estimates are held against exact counts and ranks."""
    names = ["event_id", "user_id", "event_type", "value", "props"]
    events = V.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    path = scratch_path(spark, "profiles")
    tables.write_partitions(profiles.partial_profiles(events, "day", names), path, "day")
    merged = profiles.merged_profiles(spark.read.parquet(path))
    exact = report.profile(events, names).select("column", F.col("distinct_values").alias("exact"))
    # The shares of rows below and up to each estimate, with the estimates, three per column, as literals.
    found = {r["column"]: r for r in merged.where("q50 is not null").collect()}

    def close(c: str):
        # Equal values hold all ranks from the first to the last of them.
        ends = [(p / 100, F.col(c) < found[c][f"q{p}"], F.col(c) <= found[c][f"q{p}"]) for p in (25, 50, 75)]
        shares = [(p, F.avg(below.cast("double")), F.avg(upto.cast("double"))) for p, below, upto in ends]
        return reduce(lambda a, b: a & b, [(first <= p + 0.02) & (last >= p - 0.02) for p, first, last in shares])

    ranks = events.agg(*[close(c).alias(c) for c in found])
    ranks = ranks.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("quantiles_close")) for c in found])))
    return merged.join(exact, "column").join(ranks, "column", "left").select(
        "column", "rows", "present", "null_pct", "min_value", "max_value", "mean_value",
        (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact")).alias("distinct_close"), "quantiles_close",
    )
