"""Entity resolution and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.core import query
from poilake.functions import geodesy as G
from poilake.functions import text as T
from poilake.operators import resolve as R
from poilake.operators.dedup import union_sources
from poilake.session import materialize

W = V.with_views

ORDER = ["source", "source_id"]  # "google" sorts before "osm"


def distance_sql(a: str, b: str) -> str:
    """Metres between two rows of the SQL side."""
    middle = f"radians(({a}.lat + {b}.lat) / 2)"
    bend = f"(1 - CAST(0.0066943799901413165 AS DOUBLE) * sin({middle}) * sin({middle}))"
    north = f"(CAST(6335439.327292462 AS DOUBLE) / ({bend} * sqrt({bend})) * radians({a}.lat - {b}.lat))"
    east = f"(CAST(6378137.0 AS DOUBLE) / sqrt({bend}) * cos({middle}) * radians({a}.lon - {b}.lon))"
    return f"sqrt({north} * {north} + {east} * {east})"


KEY_SQL = "array_to_string(list_sort(string_split(lower({name}), ' ')), ' ')"

# The longest common subsequence by one bit per letter of a, as the operator counts it.
LCS_SQL = """list_reduce(list_transform(string_split(b, ''), lambda ch: list_sum(list_transform(range(len(a)),
  lambda i: CASE WHEN a[i + 1] = ch THEN 1::BIGINT << i ELSE 0::BIGINT END))::BIGINT),
  lambda v, m: ((v + (v & m)) | (v - (v & m))) & ((1::BIGINT << len(a)) - 1), (1::BIGINT << len(a)) - 1)"""
SIM_SQL = f"CAST(CASE WHEN a = b THEN 100 ELSE round_even(200.0 * (len(a) - bit_count({LCS_SQL})) / (len(a) + len(b)), 0) END AS INTEGER)"

# Every pair is tested, then the places are walked in order: one that an earlier seed matches is no seed.
WALK = f"""places AS (SELECT 'google' AS source, CAST(osm_id AS VARCHAR) AS source_id, name, lat, lon, rating, category FROM poi
 UNION ALL SELECT 'osm', CAST(osm_id AS VARCHAR), name, lat, lon, rating, category FROM poi_b),
keyed AS (SELECT *, {KEY_SQL.format(name="name")} AS name_key FROM places),
nodes AS (SELECT lat, lon, name_key, row_number() OVER (ORDER BY min(concat(source, '|', source_id)), lat, lon, name_key) - 1 AS idx
 FROM keyed GROUP BY lat, lon, name_key),
words AS (SELECT DISTINCT name_key FROM nodes),
sims AS (SELECT a AS ka, b AS kb, {SIM_SQL} AS sim FROM (SELECT x.name_key AS a, y.name_key AS b FROM words x CROSS JOIN words y)),
close AS (SELECT a.idx AS i, b.idx AS j, a.name_key AS ka, b.name_key AS kb, {distance_sql("a", "b")} AS d
 FROM nodes a JOIN nodes b ON a.idx < b.idx AND abs(a.lat - b.lat) < 0.004 AND abs(a.lon - b.lon) < 0.004),
pairs AS (SELECT i, j, d, sim FROM close JOIN sims USING (ka, kb) WHERE d < 100 OR (d < 300 AND sim > 80)),
late AS (SELECT j, list(i) AS earlier, row_number() OVER (ORDER BY j) AS k FROM pairs GROUP BY j),
walk(k, taken) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
 SELECT w.k + 1, CASE WHEN len(list_filter(l.earlier, lambda e: NOT list_contains(w.taken, e))) > 0
  THEN list_append(w.taken, l.j) ELSE w.taken END FROM walk w JOIN late l ON l.k = w.k + 1),
taken AS (SELECT unnest(taken) AS idx FROM (SELECT taken FROM walk ORDER BY k DESC LIMIT 1)),
cluster AS (SELECT n.idx, CASE WHEN t.idx IS NULL THEN n.idx ELSE (SELECT min(p.i) FROM pairs p WHERE p.j = n.idx
 AND p.i NOT IN (SELECT idx FROM taken)) END AS cluster FROM nodes n LEFT JOIN taken t ON t.idx = n.idx),
member AS (SELECT k.*, c.cluster FROM keyed k JOIN nodes n ON n.lat = k.lat AND n.lon = k.lon AND n.name_key = k.name_key
 JOIN cluster c ON c.idx = n.idx)"""


def _walk(select: str) -> str:
    return W("poi", "poi_b", extra=WALK, recursive=True) + select


@query(
    "name_distance",
    W("poi", "poi_b") + f"SELECT b.osm_id, round({distance_sql('a', 'b')}, 3) AS meters FROM poi_b b JOIN poi a ON a.osm_id = b.osm_id - 1000000",
)
def _(spark, sf):
    a = V.poi(spark, sf).select((F.col("osm_id") + 1000000).alias("osm_id"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"))
    pairs = V.poi_b(spark, sf).join(a, "osm_id")
    meters = G.distance_m(F.col("lat"), F.col("lon"), F.col("lat_a"), F.col("lon_a"))
    return pairs.select("osm_id", F.round(meters, 3).alias("meters"))


#: A point about 1,140 km from the places.
FAR_POINT = (10.776, 106.701)


def geodesic_sql(rounds: int = 8) -> str:
    """The inverse geodesic of the places and ``FAR_POINT``, one subquery an iteration."""
    f, a = "(1 / 298.257223563)", "6378137.0"
    b = f"({a} * (1 - {f}))"
    at = f"""SELECT osm_id, radians({FAR_POINT[1]} - lon) AS big, radians({FAR_POINT[1]} - lon) AS lam,
 atan((1 - {f}) * tan(radians(lat))) AS u1, atan((1 - {f}) * tan(radians({FAR_POINT[0]}))) AS u2 FROM poi"""
    arc = """SELECT osm_id, big, u1, u2, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
 sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs, atan2(ss, cs) AS sg, cos(u1) * cos(u2) * sin(lam) / ss AS sa,
 1 - sa * sa AS c2, cs - 2 * sin(u1) * sin(u2) / c2 AS cm FROM ({at})"""
    for _ in range(rounds):
        at = f"""SELECT osm_id, big, u1, u2, {f} / 16 * c2 * (4 + {f} * (4 - 3 * c2)) AS c,
 big + (1 - c) * {f} * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1))) AS lam FROM ({arc.format(at=at)})"""
    return f"""SELECT osm_id, round(meters, 3) AS meters FROM (SELECT osm_id, c2 * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS k,
 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))) AS big_a, k / 1024 * (256 + k * (-128 + k * (74 - 47 * k))) AS big_b,
 {b} * big_a * (sg - big_b * ss * (cm + big_b / 4 * (cs * (2 * cm * cm - 1)
 - big_b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) AS meters FROM ({arc.format(at=at)}))"""


@query("geodesic", W("poi") + geodesic_sql())
def _(spark, sf):
    meters = G.geodesic_m(F.col("lat"), F.col("lon"), F.lit(FAR_POINT[0]), F.lit(FAR_POINT[1]))
    return V.poi(spark, sf).select("osm_id", F.round(meters, 3).alias("meters"))


@query(
    "token_sort",
    W("poi") + f""", t AS (SELECT osm_id, {KEY_SQL.format(name="name")} AS a, {KEY_SQL.format(name="concat(category, ' ', name)")} AS b FROM poi)
SELECT osm_id, {SIM_SQL} AS similarity FROM t""",
)
def _(spark, sf):
    ratio = T.token_sort_ratio(F.col("name"), F.concat("category", F.lit(" "), "name"))
    return V.poi(spark, sf).select("osm_id", ratio.alias("similarity"))


@query(
    "match_pairs",
    _walk("""SELECT i AS seed_idx, j AS idx, round(d, 3) AS meters, CASE WHEN d >= 100 THEN sim END AS similarity
 FROM pairs WHERE i NOT IN (SELECT idx FROM taken)"""),
)
def _(spark, sf):
    pairs = R.match_pairs(union_sources(*V.places(spark, sf)), ORDER)
    return pairs.select("seed_idx", "idx", F.round("distance_m", 3).alias("meters"), "similarity")


@query("greedy_clusters", _walk("SELECT source, source_id, cluster FROM member"))
def _(spark, sf):
    clustered = R.greedy_clusters(union_sources(*V.places(spark, sf)), ORDER)
    return clustered.select("source", "source_id", "cluster")


MERGED = """SELECT arg_min(name, r) AS name, arg_min(lat, r) AS lat, arg_min(lon, r) AS lon, round(avg(rating) + 1e-9, 6) AS rating,
 array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, arg_min(category, r) AS category, count(*) AS cluster_size
 FROM (SELECT *, concat(CASE source WHEN 'google' THEN '0' ELSE '1' END, source, '|', source_id) AS r FROM member) GROUP BY cluster"""


def _shown(merged):
    return merged.withColumn("rating", F.round(F.col("rating") + 1e-9, 6))


@query("cluster_collapse", _walk(MERGED))
def _(spark, sf):
    clustered = R.greedy_clusters(union_sources(*V.places(spark, sf)), ORDER)
    return _shown(R.collapse_clusters(clustered, ORDER))


@query("merge_sources", _walk(MERGED))
def _(spark, sf):
    return _shown(R.merge_sources(V.places(spark, sf), ["google", "osm"]))


# Places are called by name, category and brand; candidates by the same words in another order,
# one letter short where their number is odd. A key has each word once; grams are those of the key between two spaces.
ASKED = "concat(split_part(name, ' ', 2), ' ', split_part(name, ' ', 1), ' ', brand, ' ', category)"
MISSPELT = f"""CASE WHEN osm_id % 2 = 1 THEN concat(left({ASKED}, CAST(1 + osm_id % 9 AS INT)), substr({ASKED}, CAST(3 + osm_id % 9 AS INT))) ELSE {ASKED} END"""
WORDS_SQL = "array_to_string(list_sort(list_distinct(string_split(trim(lower(regexp_replace({name}, '[^a-zA-Z0-9_]+', ' ', 'g'))), ' '))), ' ')"
GRAMS_SQL = "list_distinct(list_transform(range(1, len(k) + 1), lambda i: substr(concat(' ', k, ' '), i, 3)))"
LOOKUP = f"""asked AS (SELECT osm_id, lat, lon, {WORDS_SQL.format(name=MISSPELT)} AS k
  FROM (SELECT osm_id + 1000000 AS osm_id, name, category, brand, lat + CAST(osm_id % 5 AS DOUBLE) / 2000 AS lat, lon FROM poi)),
places AS (SELECT osm_id, lat, lon, review_count, concat(name, ' ', category, ' ', brand) AS place_name,
  {WORDS_SQL.format(name="concat(name, ' ', category, ' ', brand)")} AS k FROM poi),
ga AS (SELECT k, unnest({GRAMS_SQL}) AS g, len({GRAMS_SQL}) AS n FROM (SELECT DISTINCT k FROM asked)),
gp AS (SELECT k, unnest({GRAMS_SQL}) AS g, len({GRAMS_SQL}) AS n FROM (SELECT DISTINCT k FROM places)),
alike AS (SELECT a, p, CAST(c AS DOUBLE) / (na + np - c) AS similarity FROM (
  SELECT ga.k AS a, gp.k AS p, any_value(ga.n) AS na, any_value(gp.n) AS np, count(*) AS c FROM ga JOIN gp USING (g) GROUP BY ga.k, gp.k)
  WHERE CAST(c AS DOUBLE) / (na + np - c) >= 0.6)"""


def _lookup(spark, sf):
    """(candidates, places) with the names of ``LOOKUP``."""
    # The parts are few small files: dealt out once, before names are made of them.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = materialize(V.poi(spark, sf).repartition(tasks, "osm_id"), "asked")
    key = F.col("osm_id") + 1000000
    asked = F.concat_ws(" ", F.split_part("name", F.lit(" "), F.lit(2)), F.split_part("name", F.lit(" "), F.lit(1)), "brand", "category")
    cut = (key % 9).cast("int")
    short = F.concat(F.substr(asked, F.lit(1), 1 + cut), F.substr(asked, 3 + cut))
    candidates = own.select(
        key.alias("osm_id"),
        F.concat(F.when(key % 2 == 1, short).otherwise(asked), F.lit(", Hà Nội")).alias("name"),
        (F.col("lat") + (F.col("osm_id") % 5).cast("double") / 2000).alias("lat"),
        "lon",
    )
    return candidates, own.select("osm_id", F.concat_ws(" ", "name", "category", "brand").alias("name"), "review_count", "lat", "lon")


@query(
    "enrich",
    W("poi", extra=LOOKUP) + """SELECT a.osm_id, b.osm_id AS place_id, b.place_name, b.review_count, round(l.similarity, 9) AS similarity
FROM asked a JOIN alike l ON l.a = a.k JOIN (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY review_count DESC, osm_id) AS rn FROM places) b ON b.k = l.p AND b.rn = 1
QUALIFY row_number() OVER (PARTITION BY a.osm_id ORDER BY l.similarity DESC, b.review_count DESC, b.osm_id, b.k) = 1""",
)
def _(spark, sf):
    candidates, places = _lookup(spark, sf)
    found = R.enrich(candidates, places, "Hà Nội", [-F.col("review_count"), F.col("osm_id")])
    data = F.col("google_data")
    return found.select(
        "osm_id", data["osm_id"].alias("place_id"), data["name"].alias("place_name"), data["review_count"].alias("review_count"),
        F.round("similarity", 9).alias("similarity"),
    )


@query(
    "enrich_nearby",
    W("poi", extra=LOOKUP) + f"""SELECT a.osm_id, b.osm_id AS place_id, round(l.similarity, 9) AS similarity, round({distance_sql('a', 'b')}, 3) AS meters
FROM asked a JOIN alike l ON l.a = a.k JOIN places b ON b.k = l.p AND abs(a.lat - b.lat) < 0.05 AND abs(a.lon - b.lon) < 0.05
WHERE {distance_sql('a', 'b')} <= 3000
QUALIFY row_number() OVER (PARTITION BY a.osm_id ORDER BY l.similarity DESC, {distance_sql('a', 'b')}, b.review_count DESC, b.osm_id) = 1""",
)
def _(spark, sf):
    candidates, places = _lookup(spark, sf)
    found = R.enrich(candidates, places, "Hà Nội", [-F.col("review_count"), F.col("osm_id")], within=3000.0)
    return found.select(
        "osm_id", F.col("google_data.osm_id").alias("place_id"), F.round("similarity", 9).alias("similarity"),
        F.round("distance_m", 3).alias("meters"),
    )
