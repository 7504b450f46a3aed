"""API queries, top lists and the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import views as V
from checks.core import query
from poilake.functions.scores import labels_union
from poilake.operators import clean, dedup, fulltext, runs, serve
from poilake.plans import marts
from poilake.session import scratch_path
from poilake.sources import tables

W = V.with_views

FACT = "place_id, name, district, category, round(rating, 2) AS rating, total_ratings, is_overcrowded"


@query(
    "top_attractions",
    W("fact") + f"SELECT {FACT} FROM fact WHERE rating IS NOT NULL AND total_ratings > 10 "
    "ORDER BY fact.rating DESC, total_ratings DESC, place_id LIMIT 10",
)
def _(spark, sf):
    return serve.search_attractions(V.fact(spark, sf), limit=10)


@query(
    "search_attractions",
    W("fact") + f"SELECT {FACT} FROM fact WHERE rating IS NOT NULL AND total_ratings > 10 AND category = 'BUILDING' "
    "AND district = 'NATION_3' AND fact.rating >= 2 ORDER BY fact.rating DESC, total_ratings DESC, place_id LIMIT 50",
)
def _(spark, sf):
    return serve.search_attractions(V.fact(spark, sf), "NATION_3", "BUILDING", 2.0, limit=50)


@query(
    "top_by_reviews",
    W("poi") + "SELECT osm_id, name, review_count, rating FROM poi ORDER BY review_count DESC, osm_id LIMIT 10",
)
def _(spark, sf):
    places = V.poi(spark, sf).select("osm_id", "name", "review_count", "rating")
    return serve.top_k(places, [F.desc_nulls_last("review_count"), F.asc("osm_id")], 10)


@query("top5_rating", W("poi") + "SELECT osm_id, name, rating FROM poi ORDER BY rating DESC NULLS LAST, osm_id LIMIT 5")
def _(spark, sf):
    places = V.poi(spark, sf).select("osm_id", "name", "rating")
    return serve.top_k(places, [F.desc_nulls_last("rating"), F.asc("osm_id")], 5)


@query(
    "top_markers",
    W("gold") + """SELECT lat, lon, round(popularity_score, 6) AS weight, name FROM gold WHERE lat IS NOT NULL AND lon IS NOT NULL
 ORDER BY round(popularity_score, 6) DESC NULLS LAST, attraction_key LIMIT 10""",
)
def _(spark, sf):
    feed = clean.drop_no_coords(V.gold(spark, sf)).withColumn("weight", F.round("popularity_score", 6))
    best = serve.top_k(feed, [F.desc_nulls_last("weight"), F.asc("attraction_key")], 10)
    return best.select("lat", "lon", "weight", "name")


@query(
    "top_popularity",
    W("gold") + """SELECT attraction_key, name, district_name, round(popularity_score, 6) AS popularity_score FROM gold
 ORDER BY round(popularity_score, 6) DESC NULLS LAST, attraction_key LIMIT 20""",
)
def _(spark, sf):
    scored = V.gold(spark, sf).select(
        "attraction_key", "name", "district_name", F.round("popularity_score", 6).alias("popularity_score")
    )
    return serve.top_k(scored, [F.desc_nulls_last("popularity_score"), F.asc("attraction_key")], 20)


@query(
    "ordered_alerts",
    W("gold") + """SELECT attraction_key, avg_rating FROM gold WHERE avg_rating < 4.0 ORDER BY avg_rating ASC NULLS LAST, attraction_key""",
)
def _(spark, sf):
    alerts = V.gold(spark, sf).where(F.col("avg_rating") < 4.0).select("attraction_key", "avg_rating")
    return serve.ordered(alerts, F.asc_nulls_last("avg_rating"), F.asc("attraction_key"))


@query(
    "dashboard_summary",
    W("fact") + """SELECT count(*) AS total_attractions, round(avg(rating) + 1e-9, 2) AS avg_rating,
 CAST(sum(total_ratings) AS BIGINT) AS total_reviews, count(CASE WHEN is_overcrowded THEN 1 END) AS overcrowded_count
 FROM fact WHERE rating IS NOT NULL""",
)
def _(spark, sf):
    return serve.dashboard_summary(V.fact(spark, sf))


@query(
    "district_summary",
    W("fact") + """SELECT district, count(*) AS attraction_count, round(avg(rating) + 1e-9, 2) AS avg_rating,
 CAST(sum(total_ratings) AS BIGINT) AS total_reviews FROM fact WHERE district IS NOT NULL AND rating IS NOT NULL GROUP BY district""",
)
def _(spark, sf):
    return serve.district_summary(V.fact(spark, sf))


@query(
    "lakehouse_stats",
    W("fact") + """SELECT count(*) AS total_attractions, count(DISTINCT district) AS total_districts, round(avg(rating) + 1e-9, 2) AS avg_rating,
 CAST(sum(total_ratings) AS BIGINT) AS total_reviews, count(CASE WHEN visitor_density_score > CAST(0.8 AS DOUBLE) THEN 1 END) AS overcrowded_count
 FROM fact""",
)
def _(spark, sf):
    return serve.lakehouse_stats(V.fact(spark, sf))


@query(
    "hidden_gems",
    W("fact") + """SELECT place_id, name, rating, total_ratings FROM fact WHERE rating >= 4.5 AND total_ratings <= 20
 ORDER BY rating DESC, total_ratings, place_id LIMIT 15""",
)
def _(spark, sf):
    return serve.hidden_gems(V.fact(spark, sf), 4.5, 20, 15).select("place_id", "name", "rating", "total_ratings")


@query(
    "adhoc_sql",
    W("fact") + """SELECT category, count(*) AS n, round(avg(total_ratings) + 1e-9, 6) AS mean_ratings FROM fact
 GROUP BY category HAVING count(*) > 10""",
)
def _(spark, sf):
    tables.staging_view(V.fact(spark, sf), "fact_attractions")
    return serve.adhoc_sql(
        spark,
        "WITH f AS (SELECT * FROM fact_attractions) SELECT category, count(*) AS n, "
        "round(avg(total_ratings) + 1e-9, 6) AS mean_ratings FROM f GROUP BY category HAVING count(*) > 10",
        1000,
    )


@query(
    "weather_join",
    W("fact", "weather") + """SELECT f.place_id, f.rating, w.weather_condition, w.temperature_celsius
 FROM fact f JOIN weather w ON f.weather_snapshot_id = w.snapshot_id""",
)
def _(spark, sf):
    joined = serve.join_weather(V.fact(spark, sf), V.weather(spark, sf))
    return joined.select("place_id", "rating", "weather_condition", "temperature_celsius")


@query(
    "weather_corr",
    W("fact", "weather") + """SELECT w.weather_condition, round(avg(f.rating) + 1e-9, 2) AS avg_rating, count(*) AS sample_count,
 round(avg(w.temperature_celsius) + 1e-9, 1) AS avg_temp FROM fact f JOIN weather w ON f.weather_snapshot_id = w.snapshot_id
 GROUP BY w.weather_condition""",
)
def _(spark, sf):
    return serve.weather_summary(V.fact(spark, sf), V.weather(spark, sf))


@query(
    "search_text",
    """WITH t AS (SELECT doc_id, lang, n_chars, list_distinct(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+')) AS words FROM documents),
 m AS (SELECT doc_id, lang, n_chars, CAST(len(list_filter(['the', 'and', 'that', 'with', 'from'], lambda w: list_contains(words, w))) AS INTEGER) AS matches FROM t)
 SELECT doc_id, lang, matches FROM m WHERE matches > 0 ORDER BY matches DESC, n_chars DESC, doc_id LIMIT 25""",
)
def _(spark, sf):
    documents = V.table(spark, sf, "documents")
    best = serve.search_text(
        documents, "The and that with from", 25, "text", [F.desc_nulls_last("n_chars")], ["doc_id"]
    )
    return best.select("doc_id", "lang", "matches")


#: Okapi BM25 over all documents; the words' order and rounding as in the index.
_RANKED = """WITH t AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '') AS words
 FROM documents),
 total AS (SELECT count(*) AS d, sum(len(words)) / count(*) AS mean FROM t),
 p AS (SELECT doc_id, lang, len(words) AS l, q.w, len(list_filter(words, lambda x: x = q.w)) AS n
  FROM t, (SELECT unnest(['the', 'und', 'de', 'license', 'version']) AS w) q),
 f AS (SELECT w, count(*) AS df FROM p WHERE n > 0 GROUP BY w)
 SELECT doc_id AS id, lang, CAST(count(*) AS INTEGER) AS matches,
 round(sum(ln(1 + (d - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS weight
 FROM p JOIN f USING (w), total WHERE n > 0 GROUP BY doc_id, lang ORDER BY weight DESC, doc_id LIMIT 50"""


@query("search_index", _RANKED)
def _(spark, sf):
    """Two segments; the second is given all documents and adds those that the first lacks."""
    path, documents = scratch_path(spark, "index"), V.table(spark, sf, "documents")
    fulltext.index_texts(documents.where("lang = 'en'"), path, "first", "doc_id", "text", ["lang"], buckets=8)
    fulltext.index_texts(documents, path, "second", "doc_id", "text", ["lang"])
    return fulltext.search_index(spark, path, "The und de; license VERSION", 50)


# Keys


@query(
    "latest_per_key",
    """SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
 ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def _(spark, sf):
    events = V.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    latest = dedup.latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return latest.drop("ts")


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(spark, sf):
    return dedup.duplicate_keys(V.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_keys_per_snapshot",
    """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date, l_partkey, count(*) AS n FROM lineitem
 GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(spark, sf):
    items = V.table(spark, sf, "lineitem").select("l_partkey", F.trunc("l_shipdate", "month").alias("snapshot_date"))
    return dedup.duplicate_keys(items, ["snapshot_date", "l_partkey"])


@query(
    "union_sources",
    W("poi", "poi_b") + """SELECT osm_id, name, brand, CAST(NULL AS BIGINT) AS review_count FROM poi
 UNION ALL SELECT osm_id, name, NULL, review_count FROM poi_b""",
)
def _(spark, sf):
    a = V.poi(spark, sf).select("osm_id", "name", "brand")
    b = V.poi_b(spark, sf).select("osm_id", "name", "review_count")
    return dedup.union_sources(a, b)


@query(
    "union_first_wins",
    W("poi", "poi_b") + """SELECT k, osm_id, q FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY q, osm_id) AS rn FROM (
 SELECT CASE WHEN osm_id % 2 = 0 THEN CAST(osm_id % 1000000 AS VARCHAR) ELSE name END AS k, osm_id, 1 AS q FROM poi
 UNION ALL SELECT CASE WHEN osm_id % 2 = 0 THEN CAST(osm_id % 1000000 AS VARCHAR) ELSE name END, osm_id, 2 FROM poi_b)) WHERE rn = 1""",
)
def _(spark, sf):
    results = V.poi(spark, sf).withColumn("q", F.lit(1)).unionByName(V.poi_b(spark, sf).withColumn("q", F.lit(2)))
    place_id = F.when(F.col("osm_id") % 2 == 0, (F.col("osm_id") % 1000000).cast("string"))
    keyed = results.select("osm_id", "q", F.coalesce(place_id, "name").alias("k"))
    return dedup.first_per_key(keyed, F.col("k"), [F.asc("q"), F.asc("osm_id")])


@query(
    "label_union",
    W("poi") + """SELECT osm_id, CASE WHEN osm_id % 3 = 0 THEN concat(category, '|', brand) WHEN osm_id % 3 = 1
 THEN concat(category, '|', name) ELSE category END AS labels FROM poi""",
)
def _(spark, sf):
    second = F.when(F.col("osm_id") % 3 == 0, F.array("category", "brand")).when(
        F.col("osm_id") % 3 == 1, F.array(F.lit(None).cast("string"), F.col("name"))
    )
    labels = labels_union(F.array("category"), second)
    return V.poi(spark, sf).select("osm_id", F.concat_ws("|", labels).alias("labels"))


@query(
    "fallback",
    W("poi", "poi_b") + """SELECT osm_id, name FROM poi_b UNION ALL SELECT osm_id, name FROM poi""",
)
def _(spark, sf):
    # The first has rows and wins; the second has none and gives way.
    a, b = V.poi(spark, sf).select("osm_id", "name"), V.poi_b(spark, sf).select("osm_id", "name")
    nothing = a.where(F.col("osm_id") < 0)
    return tables.with_fallback(b, a).unionByName(tables.with_fallback(nothing, a))


# Run log

RUN = "dag_id, run_id, task_id, state"


@query(
    "runs_latest_n",
    W("runs") + f"""SELECT {RUN} FROM (SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY execution_date DESC, run_id DESC) AS rn
 FROM runs) WHERE rn <= 10""",
)
def _(spark, sf):
    return runs.latest_runs(V.runs(spark, sf), 10).select("dag_id", "run_id", "task_id", "state")


@query(
    "run_state_summary",
    W("runs") + """SELECT count(*) AS total, count(*) FILTER (WHERE state = 'success') AS success,
 count(*) FILTER (WHERE state = 'failed') AS failed, count(*) FILTER (WHERE state = 'running') AS running
 FROM (SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY execution_date DESC, run_id DESC) AS rn FROM runs) WHERE rn <= 50""",
)
def _(spark, sf):
    return runs.run_state_summary(V.runs(spark, sf), 50)


@query(
    "run_counts",
    W("runs") + """SELECT 'run' AS level, dag_id, CAST(NULL AS VARCHAR) AS task_id, state, count(*) AS n FROM runs GROUP BY dag_id, state
 UNION ALL SELECT 'task', dag_id, task_id, state, count(*) FROM runs GROUP BY dag_id, task_id, state""",
)
def _(spark, sf):
    return runs.run_counts(V.runs(spark, sf))


@query("recent_runs", W("runs") + f"SELECT {RUN} FROM runs ORDER BY execution_date DESC, run_id DESC LIMIT 20")
def _(spark, sf):
    return runs.recent_runs(V.runs(spark, sf), 20).select("dag_id", "run_id", "task_id", "state")


NOW = datetime(2024, 1, 20, 12, 0, 0)


@query(
    "failed_24h",
    W("runs") + f"""SELECT {RUN} FROM runs WHERE state = 'failed' AND execution_date >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR
 AND execution_date <= TIMESTAMP '{NOW}'""",
)
def _(spark, sf):
    return runs.failed_since(V.runs(spark, sf), NOW).select("dag_id", "run_id", "task_id", "state")


@query(
    "staging_view",
    W("gold") + "SELECT district_name, count(*) AS n FROM gold GROUP BY district_name",
)
def _(spark, sf):
    view = tables.staging_view(marts.heatmap_feed(V.gold(spark, sf)), "stg_heatmap")
    return view.groupBy("district_name").agg(F.count("*").alias("n"))
