import math
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from poilake.functions import geodesy as G
from poilake.operators import nearby as N
from poilake.operators import resolve as R


def meters(a, b):
    return float(N._meters(*(np.array([float(v)]) for v in (*a, *b)))[0])


def least_of(point, alike, spots, within):
    """The spots at the least distance of the most similar key that has one within reach."""
    for similarity in sorted({s for _, s in alike}, reverse=True):
        keys = {k for k, s in alike if s == similarity}
        hits = [(meters(point, at), spot) for spot, (key, *at) in enumerate(spots) if key in keys]
        hits = [h for h in hits if h[0] <= within]
        if hits:
            return {(spot, similarity) for d, spot in hits if d <= min(hits)[0] + 1e-6}
    return set()


@settings(max_examples=60, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(1, 9), st.integers(1, 7), st.sampled_from([40.0, 300.0, 5000.0]))
def test_search_equals_all_pairs(rng, batch, pairs, within):
    """Whatever rows a batch has: lists and places of a tile may lie in earlier batches than its points."""
    rows, want = [], set()
    for tile in range(rng.randint(1, 3)):
        spots = [(rng.randrange(4), 21 + rng.randrange(9) / 4000, 105 + rng.randrange(9) / 4000) for _ in range(rng.randint(0, 12))]
        rows += [(tile, 0, 0, None, lat, lon, key, 100 * tile + n, None, None) for n, (key, lat, lon) in enumerate(spots)]
        for q in range(rng.randint(1, 4)):
            query = f"{tile} {q}"
            alike = sorted({k: rng.choice([0.6, 0.75, 1.0]) for k in rng.sample(range(6), rng.randint(0, 6))}.items(), key=lambda x: -x[1])
            rows.append((tile, 0, 1, query, None, None, None, None, [k for k, _ in alike], [s for _, s in alike]))
            for _ in range(rng.randint(0, 5)):
                at = 21 + rng.randrange(9) / 4000, 105 + rng.randrange(9) / 4000
                rows.append((tile, 0, 2, query, *at, None, None, None, None))
                want |= {(query, *at, 100 * tile + spot, s) for spot, s in least_of(at, alike, spots, within)}
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
    table = pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[c.split()[0] for c in N._ROW.split(", ")])
    whole, N.PAIRS = N.PAIRS, pairs
    try:
        got = {tuple(r.values()) for b in N._searched(iter(table.to_batches(batch)), within) for r in b.to_pylist()}
    finally:
        N.PAIRS = whole
    assert got == want


def test_touched_cells_hold_all_within_reach(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(3000):
        lat = rng.choice([rng.uniform(-90, 90), rng.uniform(89.5, 90), rng.uniform(-90, -89.5), rng.uniform(-0.1, 0.1), 60.0])
        lon, reach = rng.choice([rng.uniform(-180, 180), 179.999, -179.999, 0.0]), rng.choice([50.0, 3000.0, 40000.0])
        turn, far = rng.uniform(0, 2 * math.pi), reach * rng.choice([1, 1, rng.random()])
        other = lat + far * math.sin(turn) / 111700
        rows.append((reach, lat, lon, other, lon + far * math.cos(turn) / (111320 * max(math.cos(math.radians((lat + other) / 2)), 1e-6))))
    df = spark.createDataFrame(rows, "reach double, lat double, lon double, lat2 double, lon2 double")
    for reach in (50.0, 3000.0, 40000.0):
        for times in (2, 4):
            near = df.where((F.col("reach") == reach) & (G.distance_m(*(F.col(c) for c in ("lat", "lon", "lat2", "lon2"))) <= reach) & (F.abs("lat2") <= 90))
            held = F.array_contains(G.touched_cells(F.col("lat"), F.col("lon"), reach, times * reach), G.reach_cell(F.col("lat2"), F.col("lon2"), times * reach))
            assert near.count() > 500 and near.where(~held).count() == 0


def crowd(spark, n):
    """Places and candidates of few names within some 200 m."""
    rng = random.Random(n)
    names = ["cafe sen", "cafe sen two", "lake view"]
    spot = lambda: (21 + rng.random() / 500, 179.9995 + rng.random() / 500)
    places = [(i, rng.choice(names), *spot()) for i in range(n)]
    asked = [(i, rng.choice(names), *spot()) for i in range(n)]
    return asked, places, spark.createDataFrame(asked, "id long, name string, lat double, lon double"), spark.createDataFrame(places, "pid long, name string, lat double, lon double")


def most_rows(plan):
    """The most rows that an operator of a plan that ran put out, without those read."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return most_rows(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return most_rows(plan.plan())
    own = plan.metrics().get("numOutputRows")
    children = plan.children()
    return max([own.get().value() if own.isDefined() else 0, *(most_rows(children.apply(i)) for i in range(children.size()))])


def test_crowded_reach_makes_no_row_a_pair(spark):
    """All places are within reach of all candidates: 250,000 pairs, of which none is a row."""
    _, _, c, p = crowd(spark, 500)
    found = R.enrich(c, p, "Hà Nội", [F.col("pid")], least=0.5, within=3000.0)
    assert len(found.collect()) == 500
    assert 500 <= most_rows(found._jdf.queryExecution().executedPlan()) <= 10 * 500


def test_crowded_tiles_are_split(spark, monkeypatch):
    """The parts of a tile give what the whole gives, also across the date line."""
    monkeypatch.setattr(N, "TILE_ROWS", 9)
    asked, places, c, p = crowd(spark, 60)
    jaccard = {("cafe sen", "cafe sen two"): 8 / 13}
    got = sorted((r["id"], r["google_data"]["pid"]) for r in R.enrich(c, p, "Hà Nội", [F.col("pid")], least=0.5, within=60.0).collect())
    want = []
    for i, name, *at in asked:
        alike = lambda other: 1.0 if name == other else jaccard.get((min(name, other), max(name, other)), 0.0)  # noqa: B023, E731
        hits = [(-alike(other), meters(at, to), pid) for pid, other, *to in places if alike(other) >= 0.5 and meters(at, to) <= 60]
        want += [(i, min(hits)[2])] if hits else []
    assert got == want
