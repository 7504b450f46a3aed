"""Cleaning, keys, dedup, scores, normalisers, serving and the run log on small edge cases."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from poilake import schemas
from poilake.functions import scores as S
from poilake.operators import clean, dedup, report, runs, serve
from poilake.plans import marts
from poilake.plans.silver import build_silver
from poilake.sources import normalize as N
from poilake.sources import tables
from tests.conftest import plan_of


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


def test_scores(spark):
    assert [one(spark, S.reliability(F.col("n")), n=n) for n in (3, 2, 1, None)][:3] == ["High", "Medium", "Low"]
    assert spark.range(1).select(S.reliability(F.lit(None).cast("long"))).first()[0] == "Low"
    assert spark.range(1).select(S.health(F.lit(None).cast("double"))).first()[0] == "HEALTHY"
    assert [one(spark, S.health(F.col("r")), r=r) for r in (2.9, 3.0, 4.0)] == ["CRITICAL", "WARNING", "HEALTHY"]
    assert [one(spark, S.color_band(F.col("r")), r=r) for r in (4.5, 4.0, 3.9)] == ["green", "orange", "red"]
    assert abs(one(spark, S.popularity(F.col("r"), F.col("n")), r=4.0, n=99) - 8.0) < 1e-12
    assert spark.range(1).select(S.popularity(F.lit(None).cast("double"), F.lit(5))).first()[0] is None
    assert spark.range(1).select(S.attraction_key(F.lit(None).cast("string"), F.lit(1.0), F.lit(2.0))).first()[0] is None
    assert spark.range(1).select(S.percent(F.lit(1), F.lit(0))).first()[0] is None
    assert one(spark, S.round_mean(F.col("m"), 2), m=2.9449999999999994) == 2.95


def test_business_key(spark):
    df = spark.createDataFrame([(7, "A", 1.0, 2.0, "way"), (None, "A", 1.00004, 2.0, None)], "i long, n string, a double, b double, t string")
    plain = [r[0] for r in df.select(S.business_key(F.col("i"), F.col("n"), F.col("a"), F.col("b"))).collect()]
    import hashlib

    assert plain == ["7", hashlib.sha256(b"a_1.0_2.0").hexdigest()]
    typed = df.select(S.business_key(F.col("i"), F.col("n"), F.col("a"), F.col("b"), F.col("t"))).collect()
    assert typed[0][0] == "way/7" and typed[1][0] == plain[1]


def test_labels(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", None, "c"]), (None, [None]), ([], None)], "a array<string>, b array<string>")
    rows = df.select(S.labels_union(F.col("a"), F.col("b")), S.labels_union(F.col("a"), F.col("b"), True)).collect()
    assert [r[0] for r in rows] == [["a", "b", "c"], [], []]
    assert [r[1] for r in rows] == [["a", "b", None, "c"], [None], []]
    assert [r[0] for r in df.select(S.first_category(F.col("a"))).collect()] == ["a", None, None]


def test_latest_per_key(spark):
    rows = [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), (None, 5, "d"), (None, None, "e")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    latest = dedup.latest_per_key(df, ["k"], [F.desc_nulls_last("t")])
    got = {r["k"]: r["v"] for r in latest.collect()}
    assert got[None] == "d" and got["k"] in ("b", "c")
    again = dedup.latest_per_key(df.repartition(5), ["k"], [F.desc_nulls_last("t")])
    assert {r["k"]: r["v"] for r in again.collect()} == got
    # Each task keeps one row per key before the shuffle.
    fresh = dedup.latest_per_key(df, ["k"], [F.desc_nulls_last("t")])
    assert plan_of(fresh).count("WindowGroupLimit") == 2


def test_duplicates_and_first(spark):
    df = spark.createDataFrame([("p", "t1", 1), ("p", "t2", 2), (None, "t1", 3), (None, "t1", 4)], "pid string, title string, q int")
    first = dedup.first_per_key(df, F.coalesce("pid", "title"), [F.asc("q")])
    assert sorted(r["q"] for r in first.collect()) == [1, 3]
    assert [(r["pid"], r["n"]) for r in dedup.duplicate_keys(df, ["pid"]).orderBy("pid").collect()] == [(None, 2), ("p", 2)]


def bronze(spark, rows):
    import json

    text = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string")
    return text.select(F.from_json("j", schemas.ENRICHED).alias("r")).select("r.*")


def test_silver(spark):
    base = {"snapshot_date": "2024-06-01", "run_id": "r1", "ingested_at": "2024-06-01T00:00:00Z"}
    rows = [
        base | {"osm_data": {"osm_id": 1, "name": " old name ", "lat": 21.0, "lon": 105.0, "tags": {"addr:full": "x", "tourism": "museum"}}},
        base | {"osm_data": {"osm_id": 1, "name": "late", "lat": 21.0, "lon": 105.0}, "ingested_at": "2024-06-02T00:00:00Z"},
        base | {"osm_data": {"osm_id": 2, "name": "no place"}},
        base | {"osm_data": {"osm_id": 3, "lat": 1.0, "lon": 2.0},
                "google_data": {"name": "Found", "geometry": {"location": {"lat": 3.0, "lng": 4.0}}, "rating": 4, "types": ["a"]}},
        base | {"osm_data": {"osm_id": 4, "name": "tie", "lat": 1.0, "lon": 2.0}, "run_id": "r1"},
        base | {"osm_data": {"osm_id": 4, "name": "tie two", "lat": 1.0, "lon": 2.0}, "run_id": "r2"},
    ]
    silver = build_silver(bronze(spark, rows), datetime(2024, 6, 3))
    got = {r["osm_id"]: r for r in silver.collect()}
    assert set(got) == {1, 3, 4}
    assert got[1]["name"] == "Late" and got[1]["poi_types"] == []
    assert (got[3]["name"], got[3]["latitude"], got[3]["longitude"], got[3]["rating"]) == ("Found", 3.0, 4.0, 4.0)
    assert got[4]["name"] == "Tie Two"
    assert [f"{f.name} {f.dataType.simpleString()}" for f in silver.schema] == [
        " ".join(part.split()) for part in schemas.SILVER.replace("\n", " ").split(",")
    ]


def test_silver_key_by_type(spark):
    base = {"snapshot_date": "2024-06-01", "run_id": "r1", "ingested_at": "2024-06-01T00:00:00Z"}
    rows = [base | {"osm_data": {"osm_id": 1, "osm_type": t, "name": t, "lat": 1.0, "lon": 1.0}} for t in ("node", "way")]
    assert build_silver(bronze(spark, rows)).count() == 2
    assert build_silver(bronze(spark, rows), key_by_type=False).count() == 1


def test_mart_keeps_one_row_per_name_and_spot(spark):
    silver = spark.createDataFrame(
        [("2", "n", ["c"], 21.0, 105.8, 4.0, 5), ("1", "n", ["d"], 21.0, 105.8, 3.0, 2), ("3", None, [], 21.0, 105.8, None, None)],
        "business_key string, name string, poi_types array<string>, latitude double, longitude double, rating double, review_count long",
    )
    gold = marts.build_attractions(silver, tables.districts_dim(spark), date(2024, 6, 1))
    rows = sorted(gold.collect(), key=lambda r: r["name"] or "")
    assert len(rows) == 2
    assert rows[0]["attraction_key"] is None and rows[0]["category"] is None and rows[0]["reliability_level"] == "Low"
    assert rows[1]["category"] == "d" and rows[1]["reliability_level"] == "Medium" and rows[1]["district_name"]


def test_overpass_edges(spark):
    areas = spark.createDataFrame(
        [([
            ("node", 1, 21.0, 105.0, None, {"name": "", "name:vi": "vi", "amenity": "x"}),
            ("way", 2, 0.0, 0.0, (1.0, 2.0), {"name": "centre", "tourism": "", "historic": "h"}),
            ("node", 3, 21.0, None, None, {"name": "no lon"}),
            ("node", 4, 21.0, 105.0, None, None),
        ],)],
        schemas.OVERPASS,
    )
    got = {r["source_id"]: r for r in N.overpass(areas).collect()}
    assert set(got) == {"node/1", "way/2"}
    assert got["node/1"]["name"] == "vi" and got["way/2"]["lat"] == 1.0 and got["way/2"]["category"] == "h"
    assert {r["osm_id"] for r in N.overpass_flat(areas).collect()} == {"1", "2", "3"}


def test_google_places_edges(spark):
    df = spark.createDataFrame([([(None, (1.0, 2.0), None, [], "a", 3), (("n",), None, 4.0, ["t", "u"], "b", None)],), ([],)], schemas.PLACES_SEARCH)
    got = N.google_places(df).collect()
    assert [(r["name"], r["category"], r["lat"]) for r in got] == [("", "attraction", 1.0), ("n", "t", None)]
    assert [(r["source_id"], r["position"], r["review_count"]) for r in got] == [("a", 0, 3), ("b", 1, None)]


def test_normalisers_give_one_shape(spark):
    shape = [f.name for f in spark.createDataFrame([], schemas.PLACES).schema]
    local = spark.createDataFrame([('[{"title": "x", "data_id": "d"}]', "q"), ("{broken", "q"), (None, "q")], "local_results string, query_used string")
    made = N.google_local(local, carry=["query_used"])
    assert {r["query_used"] for r in made.collect()} == {"q"} and made.count() == 1
    assert [r["local_results"] for r in N.local_rejects(local).collect()] == ["{broken"]
    frames = [
        N.google_places(spark.createDataFrame([], schemas.PLACES_SEARCH)), N.overpass(spark.createDataFrame([], schemas.OVERPASS)),
        made, N.tripadvisor(spark.createDataFrame([], schemas.REVIEW_SITE)),
    ]
    for frame in frames:
        assert set(shape) <= set(frame.columns)
        assert dict(frame.select(*shape).dtypes) == dict(spark.createDataFrame([], schemas.PLACES).dtypes)


def test_search_and_adhoc_guards(spark):
    fact = spark.createDataFrame([(1, 4.0, 11), (2, None, 99), (3, 5.0, 10)], "place_id int, rating double, total_ratings int")
    assert [r["place_id"] for r in serve.search_attractions(fact).collect()] == [1]
    for limit in (0, 51):
        with pytest.raises(ValueError):
            serve.search_attractions(fact, limit=limit)
    fact.createOrReplaceTempView("adhoc_fact")
    assert serve.adhoc_sql(spark, "with f as (select * from adhoc_fact limit 2) select * from f;", 1).count() == 1
    assert serve.adhoc_sql(spark, "SELECT 'insert into x; drop' AS t -- drop").first()[0].startswith("insert")
    for bad in ("drop table x", "with a as (select 1) insert into t select * from a", "select 1; drop table x", "  insert into t values (1)"):
        with pytest.raises(ValueError):
            serve.adhoc_sql(spark, bad)


def test_search_text(spark):
    df = spark.createDataFrame([(1, "Old TEMPLE of the lake"), (2, "lake"), (3, None), (4, "templelake")], "id int, text string")
    got = serve.search_text(df, "temple lake LAKE", 5, tie=["id"]).collect()
    assert [(r["id"], r["matches"]) for r in got] == [(1, 2), (2, 1)]
    assert serve.search_text(df, " ,", 5).count() == 0


def test_weather_summary_ignores_unknown_values(spark):
    fact = spark.createDataFrame([(1, 4.0), (1, None), (2, 2.0), (9, 5.0)], "weather_snapshot_id int, rating double")
    weather = spark.createDataFrame([(1, "sun", 30.0), (2, "sun", None)], "snapshot_id int, weather_condition string, temperature_celsius double")
    row = serve.weather_summary(fact, weather).first()
    assert (row["avg_rating"], row["sample_count"], row["avg_temp"]) == (3.0, 3, 30.0)


def test_reports(spark):
    df = spark.createDataFrame([(None, 1), (0.0, 2), (1.0, 3), (2.0, 4), (4.0, 5)], "rating double, review_count long").withColumn("g", F.lit("x"))
    box = report.rating_box(df, "g", "rating").first()
    assert (box["low"], box["q1"], box["median"], box["q3"], box["high"], box["n"]) == (1.0, 1.5, 2.0, 3.0, 4.0, 3)
    assert report.rating_box(df, "g", "rating", accuracy=1000).first()["median"] == 2.0
    filled = {r["field"]: r["percentage"] for r in report.completeness(df, ["rating", "g"]).collect()}
    assert filled == {"rating": 80.0, "g": 100.0}
    approx = {r["column"]: r["distinct_values"] for r in report.profile(df, approximate=True).collect()}
    exact = {r["column"]: r["distinct_values"] for r in report.profile(df).collect()}
    assert exact == approx == {"rating": 4, "review_count": 5, "g": 1}
    assert report.profile(df.where("1 = 0"), ["rating"]).first()["null_pct"] is None


def test_rating_delta_takes_one_row_per_day(spark):
    rows = [(1, date(2024, 1, 1), 4.0, 1), (1, date(2024, 1, 1), 3.0, 9), (1, date(2024, 1, 2), 2.5, 1)]
    df = spark.createDataFrame(rows, "id int, snapshot_date date, rating double, review_count int")
    got = report.rating_delta(df, ["id"]).orderBy("snapshot_date").collect()
    assert [r["rating_delta"] for r in got] == [None, -0.5]
    assert report.rating_drop(df, ["id"], 0.5).count() == 1


def test_run_log(spark):
    now = datetime(2024, 1, 2)
    rows = [("d", f"r{i}", "t", s, datetime(2024, 1, 1, i)) for i, s in enumerate(["failed", "success", "running", "queued"])]
    rows.append(("e", "old", "t", "failed", datetime(2023, 12, 31, 23)))
    log = spark.createDataFrame(rows, "dag_id string, run_id string, task_id string, state string, execution_date timestamp")
    assert runs.run_state_summary(log, 2).first().asDict() == {"total": 3, "success": 0, "failed": 1, "running": 1}
    assert [r["run_id"] for r in runs.recent_runs(log, 2).collect()] == ["r3", "r2"]
    assert [r["run_id"] for r in runs.failed_since(log, now).collect()] == ["r0"]
    counts = runs.run_counts(log).collect()
    assert sum(r["n"] for r in counts if r["level"] == "run") == sum(r["n"] for r in counts if r["level"] == "task") == 5


def test_filters(spark):
    df = spark.createDataFrame([(20.5, 106.5, 0.0), (21.6, 105.0, 1.0), (None, 105.0, None)], "lat double, lon double, rating double")
    assert clean.in_bbox(df).count() == 1 and clean.drop_no_coords(df).count() == 2 and clean.rated_only(df).count() == 1
    shown = clean.map_category(
        spark.createDataFrame([("restaurant",), ("museum",), (None,)], "category string"), tables.category_dim(spark)
    )
    assert {r["category"]: r["shown_category"] for r in shown.collect()} == {"restaurant": "Ẩm thực", "museum": "museum", None: None}


def test_dates_dim(spark):
    dim = {r["date"]: r for r in tables.dates_dim(spark).collect()}
    assert len(dim) == 1096 and dim[date(2024, 6, 1)]["is_weekend"] and dim[date(2024, 6, 3)]["day_of_week"] == 1
    assert dim[date(2024, 6, 3)]["month_name"] == "June"


def test_fallback(spark):
    a, b = spark.range(2).toDF("x"), spark.range(5).toDF("x")
    assert tables.with_fallback(a, b).count() == 2
    assert tables.with_fallback(a.where("x < 0"), b).count() == 5
    assert tables.with_fallback(a.where("x < 0"), b.where("x < 0")).count() == 0
