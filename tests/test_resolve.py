import random

import pytest
from pyspark.sql import functions as F

from poilake.functions.text import indel_ratio, similarity_above
from poilake.operators import resolve as R
from poilake.operators.order import daily_batch, global_index
from tests.test_geodesy import vincenty

SCHEMA = "source string, source_id string, name string, lat double, lon double, rating double, category string"
ORDER = ["source", "source_id"]
METER = 1 / 110950.0


def sort_key(name):
    return " ".join(sorted((name or "").lower().split()))


def matches(a, b):
    d = vincenty(a[3], a[4], b[3], b[4])
    return d < 100 or (d < 300 and indel_ratio(sort_key(a[2]), sort_key(b[2])) > 80)


def greedy(rows):
    """The plain sequential pass: cluster number per (source, source_id)."""
    left, out = sorted(rows, key=lambda r: (r[0], r[1])), {}
    while left:
        seed = left[0]
        taken = [r for r in left if r is seed or matches(seed, r)]
        for r in taken:
            out[r[:2]] = seed[:2]
        left = [r for r in left if r[:2] not in out]
    return out


def spark_clusters(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = R.greedy_clusters(df, ORDER).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault(r["cluster"], set()).add((r["source"], r["source_id"]))
    return {frozenset(g) for g in groups.values()}


def plain_clusters(rows):
    groups = {}
    for key, seed in greedy(rows).items():
        groups.setdefault(seed, set()).add(key)
    return {frozenset(g) for g in groups.values()}


def town(seed, n, width, names=("old house", "house old", "green park", "green parks", "lake")):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["google", "osm"]), f"{i:04d}", rng.choice(names),
            21.0 + rng.uniform(0, width) * METER, 105.8 + rng.uniform(0, width) * METER, None, "x",
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, n, width", [(1, 60, 400), (2, 120, 1500), (3, 150, 150), (4, 100, 6000)])
def test_clusters_equal_the_sequential_pass(spark, seed, n, width):
    rows = town(seed, n, width)
    assert spark_clusters(spark, rows) == plain_clusters(rows)


def test_chain_is_not_transitive(spark):
    # 90 m steps along a street, in order: each seed takes its neighbour only.
    rows = [("osm", f"{i:02d}", f"name{i * 7919}", 21.0 + 90 * i * METER, 105.8, None, "x") for i in range(8)]
    got = spark_clusters(spark, rows)
    assert got == plain_clusters(rows)
    assert max(len(g) for g in got) == 2


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    rows = [("osm", f"{i:03d}", f"name{i * 7919}", 21.0 + 90 * i * METER, 105.8, None, "x") for i in range(400)]
    calls = []
    for name in ("_tile_round", "_wide_round"):
        plain = getattr(R, name)
        monkeypatch.setattr(R, name, lambda *a, f=plain, n=name: (calls.append(n), f(*a))[1])
    assert spark_clusters(spark, rows) == plain_clusters(rows)
    assert calls == ["_tile_round"]  # a round per two places would be 200


@pytest.mark.parametrize("limit", [12, 60])
def test_small_and_crowded_tiles(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "TILE_NODES", limit)
    rows = town(7, 70, 6000) + [("x" + r[0], *r[1:]) for r in town(8, 50, 400)]
    assert spark_clusters(spark, rows) == plain_clusters(rows)


def test_similarity_above_is_the_ratio():
    rng = random.Random(5)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc é") for _ in range(rng.randrange(0, 12))) for _ in "ab")
        least = rng.randrange(0, 100)
        assert similarity_above(a, b, least) == (indel_ratio(a, b) > least)


def test_edges_of_the_rule(spark):
    # About 99.5 m and 100.5 m with unlike names; 299 m and 301 m with like names.
    def row(i, name, meters):
        return ("osm", f"{i}", name, 21.0 + meters * METER, 105.8, None, "x")

    base = row(0, "alpha", 0)
    for meters, name, together in [
        (99.0, "zz", True), (101.5, "zz", False), (297.0, "alpha", True), (303.0, "alpha", False),
        (200.0, "alphb", False),  # similarity of exactly 80 is not enough
    ]:
        rows = [base, row(1, name, meters)]
        assert matches(*rows) is together
        assert (len(spark_clusters(spark, rows)) == 1) is together


def test_copies_and_a_hot_spot(spark):
    # A third of the rows are copies of one record, another third sits within 60 m.
    rng = random.Random(9)
    copies = [("osm", f"c{i:04d}", "Hot Spot", 21.0, 105.8, 4.0, "x") for i in range(300)]
    dense = [
        ("google", f"d{i:04d}", f"n{rng.randint(0, 9)}", 21.001 + rng.uniform(0, 60) * METER, 105.8, None, "y")
        for i in range(300)
    ]
    rows = copies + dense + town(5, 100, 3000)
    assert spark_clusters(spark, rows) == plain_clusters(rows)


@pytest.mark.parametrize("limit", [0, 8192])
def test_rounds_do_not_list_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "TILE_NODES", limit)
    rng = random.Random(11)
    rows = [
        ("osm", f"{i:05d}", f"name {i}", 21.0 + rng.uniform(0, 50) * METER, 105.8 + rng.uniform(0, 50) * METER, None, "x")
        for i in range(3000)
    ]
    nodes = R.place_nodes(spark.createDataFrame(rows, SCHEMA), ORDER)
    seeds = R._seeds(nodes, R.MatchRule())
    assert seeds.count() < 9
    assert R._seed_matches(nodes, seeds, R.MatchRule()).count() < 4 * 3000


def test_rows_without_coordinates_or_name(spark):
    rows = [
        ("google", "1", None, 21.0, 105.8, 4.0, "x"), ("osm", "2", "", 21.0, 105.8, 2.0, "y"),
        ("osm", "3", "far", None, 105.8, 1.0, "z"), ("osm", "4", "far", 21.0, None, None, "z"),
    ]
    merged = R.merge_sources([spark.createDataFrame(rows, SCHEMA)]).collect()
    by_size = sorted((r["cluster_size"], r["rating"], r["sources"]) for r in merged if r["rating"] is not None)
    assert by_size == [(1, 1.0, "osm"), (2, 3.0, "google,osm")]
    assert len(merged) == 3


def test_collapse_prefers_the_primary_source(spark):
    a = spark.createDataFrame([("osm", "1", "osm name", 21.0, 105.8, None, "temple")], SCHEMA)
    b = spark.createDataFrame([("google", "9", "google name", 21.0, 105.8001, 4.5, "museum")], SCHEMA)
    row = R.merge_sources([a, b], ["google", "osm"]).first()
    assert row.asDict() == {
        "name": "google name", "lat": 21.0, "lon": 105.8001, "rating": 4.5, "sources": "google,osm",
        "category": "museum", "cluster_size": 2,
    }


def test_empty_input(spark):
    assert R.merge_sources([spark.createDataFrame([], SCHEMA)]).count() == 0


def test_enrich_finds_the_best_of_a_hot_name(spark):
    candidates = spark.createDataFrame([(i, "Café Sen") for i in range(50)] + [(99, "Nowhere")], "id int, name string")
    places = spark.createDataFrame(
        [(i, "sen cafe", i % 7) for i in range(70)] + [(500, "Cafe Sen Ha Noi", 9)], "pid int, name string, reviews int"
    )
    found = R.enrich(candidates, places, "Hà Nội", [-F.col("reviews"), F.col("pid")]).collect()
    assert len(found) == 50 and {r["google_data"]["pid"] for r in found} == {500}


def test_global_index_is_the_rank(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = global_index(df, ["k"]).collect()
    assert sorted((r["k"], r["idx"]) for r in got) == [(i, i) for i in range(1000)]
    assert global_index(df.where("k < 0"), ["k"]).count() == 0


@pytest.mark.parametrize("total, batch", [(10, 3), (10, 10), (3, 10), (0, 5), (7, 4)])
def test_daily_batch_covers_everything(spark, total, batch):
    df = spark.range(total).select(F.col("id").alias("k"))
    seen = set()
    for day in range(1, 8):
        got = sorted(r["k"] for r in daily_batch(df, ["k"], day, batch).collect())
        start = day * batch % total if total else 0
        expected = sorted({(start + i) % total for i in range(min(batch, total))}) if total else []
        assert got == expected
        seen.update(got)
    assert total == 0 or seen == set(range(total)) or total * 1 > 7 * batch


def test_daily_batch_tail_only_in_strict_mode(spark):
    df = spark.range(3).select(F.col("id").alias("k"))
    assert [r["k"] for r in daily_batch(df, ["k"], 2, 10, strict_reference=True).collect()] == [2]


def test_four_sources_merge_as_the_sequential_pass(spark):
    """Documents to normalisers to the merge, whatever the partitioning; some records have no id."""
    import json

    from poilake import schemas
    from poilake.sources import normalize as N

    rng = random.Random(21)

    def spot():
        return 21.0 + rng.uniform(0, 700) * METER, 105.8 + rng.uniform(0, 700) * METER

    names = ["Old House", "House Old", "Green Park", "Lake", "Pagoda"]
    google = [(rng.choice(names), *spot(), rng.choice([None, 3.0, 5.0])) for _ in range(30)]
    osm = [(rng.choice(names), *spot()) for _ in range(30)]
    local = [(rng.choice(names), *spot(), 4.0) for _ in range(20)]
    trip = [(rng.choice(names), 2.0) for _ in range(5)]
    texts = {
        "g": (schemas.PLACES_SEARCH, {"places": [{"displayName": {"text": n}, "location": {"latitude": a, "longitude": b}, "rating": r} for n, a, b, r in google]}),
        "o": (schemas.OVERPASS, {"elements": [{"type": "node", "id": i, "lat": a, "lon": b, "tags": {"name": n}} for i, (n, a, b) in enumerate(osm)]}),
        "t": (schemas.REVIEW_SITE, {"places": [{"title": n, "place_id": f"t{i}", "rating": r} for i, (n, r) in enumerate(trip)]}),
    }

    def read(key):
        kind, value = texts[key]
        return spark.createDataFrame([(json.dumps(value),)], "j string").select(F.from_json("j", kind).alias("r")).select("r.*")

    items = [{"title": n, "data_id": f"d{i}", "rating": r, "gps_coordinates": {"latitude": a, "longitude": b}} for i, (n, a, b, r) in enumerate(local)]
    places = spark.createDataFrame([(json.dumps(items),)], "local_results string")
    sources = [N.google_places(read("g")), N.overpass(read("o")), N.google_local(places), N.tripadvisor(read("t"))]
    priority = ["google", "osm", "google_local", "tripadvisor"]

    rows = [("google", i, "", n, a, b, r) for i, (n, a, b, r) in enumerate(google)]
    rows += [("osm", i, f"node/{i}", n, a, b, None) for i, (n, a, b) in enumerate(osm)]
    rows += [("google_local", i, f"d{i}", n, a, b, r) for i, (n, a, b, r) in enumerate(local)]
    left, want = rows, [(n, None, None, r, "tripadvisor", 1) for n, r in trip]
    while left:
        near = [r for r in left if r is left[0] or matches((0, 0, left[0][3], *left[0][4:6]), (0, 0, r[3], *r[4:6]))]
        best = next((r for r in near if r[0] == "google"), near[0])
        known = [r[6] for r in near if r[6] is not None]
        mean = round(sum(known) / len(known), 6) if known else None
        want.append((best[3], best[4], best[5], mean, ",".join(sorted({r[0] for r in near})), len(near)))
        left = [r for r in left if r not in near]
    for parts in (1, 3, 7):
        merged = R.merge_sources([s.repartition(parts) for s in sources], priority).collect()
        got = [
            (r["name"], r["lat"], r["lon"], None if r["rating"] is None else round(r["rating"], 6), r["sources"], r["cluster_size"])
            for r in merged
        ]
        assert sorted(got, key=str) == sorted(want, key=str)
