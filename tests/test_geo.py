import random

import pytest
from pyspark.sql import functions as F

from poilake.operators import geo
from poilake.sources import tables
from tests.conftest import plan_of

POI = "id int, lat double, lon double"


def places(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.uniform(20.5, 21.5), rng.uniform(105.0, 106.5)) for i in range(n)]
    return rows, spark.createDataFrame(rows + [(n, None, 105.5), (n + 1, 21.0, None)], POI)


def nearest(rows, centers):
    return {
        i: min(((lat - a) ** 2 + (lon - b) ** 2, name) for name, a, b in centers)[1] for i, lat, lon in rows
    }


@pytest.mark.parametrize("n_centers, spread", [(5, 1.0), (200, 1.0), (200, 0.01), (1, 1.0)])
def test_nearest_equals_brute_force(spark, n_centers, spread):
    rng = random.Random(n_centers)
    centers = [(f"d{i:03d}", 21.0 + rng.uniform(0, 0.5) * spread, 105.8 + rng.uniform(0, 0.7) * spread) for i in range(n_centers)]
    rows, poi = places(spark)
    dim = spark.createDataFrame(centers, "district_name string, center_lat double, center_lon double")
    got = {r["id"]: r["district_name"] for r in geo.assign_nearest(poi, dim).collect()}
    assert got == nearest(rows, centers) | {300: None, 301: None}


def test_nearest_tie_goes_to_the_first_name(spark):
    dim = spark.createDataFrame(
        [("b", 1.0, 0.0), ("a", -1.0, 0.0), ("c", -1.0, 0.0)], "district_name string, center_lat double, center_lon double"
    )
    poi = spark.createDataFrame([(1, 0.0, 0.0)], POI)
    assert geo.assign_nearest(poi, dim).first()["district_name"] == "a"


def test_fixed_districts_need_no_shuffle(spark):
    _, poi = places(spark)
    plan = plan_of(geo.assign_nearest(poi, tables.districts_dim(spark)))
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "SortMergeJoin" not in plan
    assert tables.districts_dim(spark).count() == 30


def test_k_nearest_equal_brute_force(spark):
    rng = random.Random(9)
    centers = [(f"d{i:03d}", rng.uniform(20.8, 21.2), rng.uniform(105.5, 106)) for i in range(150)]
    centers += [("twin", *centers[0][1:]), ("null", None, 105.0)]
    rows, poi = places(spark)
    dim = spark.createDataFrame(centers, "district_name string, center_lat double, center_lon double")
    got = {}
    for r in geo.rank_centers(poi, dim, 4).collect():
        got.setdefault(r["id"], {})[r["rank_nearest"]] = r["district_name"]
    for i, lat, lon in rows:
        near = sorted(((lat - a) ** 2 + (lon - b) ** 2, n) for n, a, b in centers if a is not None)[:4]
        assert [got[i][k] for k in (1, 2, 3, 4)] == [n for _, n in near]
    assert len(got) == 300
    assert geo.rank_centers(poi, dim.limit(0), 4).count() == 0
    assert {r["district_name"] for r in geo.assign_nearest(poi, dim.where("center_lat is null")).collect()} == {None}


def test_an_outlier_does_not_cost_pairs(spark):
    """2,000 even centres and one far away: rows still meet a bounded number of centres."""
    centers = [(f"c{i}", 21 + (i // 50) / 100, 105 + (i % 50) / 100) for i in range(2000)] + [("far", 0.0, 0.0)]
    dim = spark.createDataFrame(centers, "district_name string, center_lat double, center_lon double")
    poi = spark.createDataFrame([(1, 0.1, 0.1), (2, 21.0, 105.0), (2, 21.0, 105.0), (None, 21.39, 105.49), (3, float("nan"), 0.0)], POI)
    leaves, grid = geo._nearest_cells(dim, 1, poi, "lat", "lon")
    assert leaves.agg(F.max(F.size("items"))).first()[0] <= geo._ENOUGH and len(grid.levels) < 8
    got = sorted((r["id"] or 0, r["district_name"] or "") for r in geo.assign_nearest(poi, dim).collect())
    assert got == [(0, "c1999"), (1, "far"), (2, "c0"), (2, "c0"), (3, "")]


@pytest.mark.parametrize("n", [20, 200])
def test_boxes_equal_brute_force(spark, n):
    rng = random.Random(5)
    boxes = []
    for i in range(n):
        a, b, h, w = rng.uniform(20.5, 21.4), rng.uniform(105, 106.4), rng.uniform(0.001, 0.4), rng.uniform(0.001, 0.4)
        boxes.append((f"b{i:03d}", a, a + h, b, b + w))
    boxes.append(("twin", *boxes[0][1:]))
    rows, poi = places(spark)
    dim = spark.createDataFrame(boxes, "district_name string, lat_min double, lat_max double, lon_min double, lon_max double")
    got = {r["id"]: r["district_name"] for r in geo.assign_bbox(poi, dim).collect()}
    for i, lat, lon in rows:
        around = [((d - c) * (f - e), n) for n, c, d, e, f in boxes if c <= lat <= d and e <= lon <= f]
        assert got[i] == (min(around)[1] if around else "Unknown District")
    assert got[300] == got[301] == "Unknown District"


def test_published_boxes(spark):
    poi = spark.createDataFrame([(1, 21.03, 105.85), (2, 21.04, 105.82), (3, 20.0, 105.0)], POI)
    got = geo.assign_bbox(poi, tables.district_boxes_dim(spark)).orderBy("id").collect()
    assert [r["district_name"] for r in got] == ["Hoàn Kiếm", "Ba Đình", "Unknown District"]


def test_marker_clusters_sum_up_across_zooms(spark):
    _, poi = places(spark)
    rated = poi.withColumn("rating", (F.col("id") % 50) / 10)
    totals = geo.marker_clusters(rated, [5, 8, 12]).groupBy("zoom").agg(F.sum("markers").alias("n")).collect()
    assert {r["zoom"]: r["n"] for r in totals} == {5: 300, 8: 300, 12: 300}


def test_heat_grid(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.4, 1.2, 3.0), (-0.1, 1.0, 1.0), (None, 1.0, 9.0)], "lat double, lon double, w double")
    got = {(r["cell_lat"], r["cell_lon"]): (r["weight"], r["points"]) for r in geo.heat_grid(df, 0.5, "w").collect()}
    assert got == {(2, 2): (5.0, 2), (-1, 2): (1.0, 1)}


def test_centres_on_one_spot_and_nearly_one_spot_stop_dividing(spark):
    """Cells with many equal or nearly equal candidates are not divided for ever."""
    same = [(f"s{i:02d}", 21.0, 105.0) for i in range(40)]
    near = [(f"n{i:02d}", 22.0 + i * 1e-13, 105.0) for i in range(40)]
    centers = spark.createDataFrame(same + near, "district_name string, center_lat double, center_lon double")
    rng = random.Random(3)
    rows = [(i, 20.5 + 2 * rng.random(), 104.5 + rng.random()) for i in range(200)] + [(900, 21.0, 105.0), (901, None, 1.0)]
    poi = spark.createDataFrame(rows, "id int, lat double, lon double")
    for k in (1, 10):
        got = {(r["id"], r["rank_nearest"]): r["district_name"] for r in geo.rank_centers(poi, centers, k).collect()}
        for i, lat, lon in rows[:-1]:
            order = sorted(((lat - y) ** 2 + (lon - x) ** 2, name) for name, y, x in same + near)
            assert [got[i, n + 1] for n in range(k)] == [name for _, name in order[:k]]
        assert len(got) == 201 * k


def test_equal_boxes_and_boxes_with_a_common_edge(spark):
    equal = [(f"e{i:02d}", 21.0, 21.5, 105.0, 105.5) for i in range(40)]
    edge = [(f"c{i:02d}", 22.0, 22.1 + i / 100, 105.0, 105.1 + i / 100) for i in range(60)]
    boxes = spark.createDataFrame(equal + edge + [(None, 21.0, 21.5, 105.0, 105.5)], "district_name string, lat_min double, lat_max double, lon_min double, lon_max double")
    rng = random.Random(4)
    rows = [(i, 20.9 + 2 * rng.random(), 104.9 + rng.random()) for i in range(300)] + [(900, 22.0, 105.0), (901, 21.0, 105.5), (902, None, None)]
    poi = spark.createDataFrame(rows, "id int, lat double, lon double")
    got = {r["id"]: r["district_name"] for r in geo.assign_bbox(poi, boxes, "none").collect()}

    cells = boxes.collect()

    def answer(lat, lon):
        hits = [((b[2] - b[1]) * (b[4] - b[3]), b[0] or "") for b in cells if lat is not None and b[1] <= lat <= b[2] and b[3] <= lon <= b[4]]
        return (min(hits)[1] or "none") if hits else "none"

    assert got == {i: answer(lat, lon) for i, lat, lon in rows}


def test_more_candidates_than_one_task_takes(spark, monkeypatch):
    """Crowded cells are divided by Spark first; the answers are the same."""
    rng = random.Random(5)
    centers = [(f"d{i}", 20 + rng.random(), 105 + rng.random()) for i in range(300)]
    table = spark.createDataFrame(centers, "district_name string, center_lat double, center_lon double")
    rows = [(i, 20 + rng.random(), 105 + rng.random()) for i in range(150)]
    poi = spark.createDataFrame(rows, "id int, lat double, lon double")
    monkeypatch.setattr(geo, "_ONE_TASK", 100)
    got = {r["id"]: r["district_name"] for r in geo.assign_nearest(poi, table).collect()}
    assert got == {i: min(((lat - y) ** 2 + (lon - x) ** 2, n) for n, y, x in centers)[1] for i, lat, lon in rows}
    half = table.selectExpr("district_name", "center_lat - 0.05 lat_min", "center_lat + 0.05 lat_max", "center_lon - 0.05 lon_min", "center_lon + 0.05 lon_max")
    split = {r["id"]: r["district_name"] for r in geo.assign_bbox(poi, half).collect()}
    monkeypatch.undo()
    assert split == {r["id"]: r["district_name"] for r in geo.assign_bbox(poi, half).collect()}
