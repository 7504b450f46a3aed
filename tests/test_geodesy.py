import math
import random

from pyspark.sql import functions as F

from poilake.functions import geodesy as G


def vincenty(lat1, lon1, lat2, lon2):
    """The inverse geodesic by Vincenty's published iteration."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = math.atan((1 - f) * math.tan(math.radians(lat1))), math.atan((1 - f) * math.tan(math.radians(lat2)))
    big = lam = math.radians((lon2 - lon1 + 540) % 360 - 180)
    for _ in range(200):
        sin_s = math.hypot(
            math.cos(u2) * math.sin(lam),
            math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam),
        )
        if sin_s == 0:
            return 0.0
        cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        s = math.atan2(sin_s, cos_s)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / sin_s
        cos2 = 1 - sin_a**2
        cos_m = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0.0
        c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        old, lam = lam, big + (1 - c) * f * sin_a * (s + c * sin_s * (cos_m + c * cos_s * (2 * cos_m**2 - 1)))
        if abs(old - lam) < 1e-14:
            break
    k = cos2 * (a * a - b * b) / (b * b)
    big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    delta = big_b * sin_s * (
        cos_m + big_b / 4 * (cos_s * (2 * cos_m**2 - 1) - big_b / 6 * cos_m * (4 * sin_s**2 - 3) * (4 * cos_m**2 - 3))
    )
    return b * big_a * (s - delta)


def near_pairs(seed, n, reach):
    rng = random.Random(seed)
    pairs = []
    for i in range(n):
        lat, lon = rng.uniform(-70, 70), rng.uniform(-180, 180)
        angle, far = rng.uniform(0, 2 * math.pi), rng.uniform(0, reach)
        lat2 = lat + far * math.sin(angle) / 111000
        lon2 = lon + far * math.cos(angle) / (111000 * math.cos(math.radians(lat)))
        pairs.append((i, lat, lon, lat2, (lon2 + 540) % 360 - 180))
    return pairs


COLUMNS = ["lat", "lon", "lat2", "lon2"]
SCHEMA = "i int, lat double, lon double, lat2 double, lon2 double"


def test_distance_equals_the_geodesic(spark):
    pairs = near_pairs(1, 300, 900) + [(300, 21.0, 180.0, 21.001, -179.999), (301, 10.0, 10.0, 10.0, 10.0)]
    df = spark.createDataFrame(pairs, SCHEMA)
    for r in df.withColumn("d", G.distance_m(*[F.col(c) for c in COLUMNS])).collect():
        assert abs(r["d"] - vincenty(r["lat"], r["lon"], r["lat2"], r["lon2"])) < 1e-3


def test_haversine(spark):
    row = spark.range(1).select(G.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))).first()
    assert abs(row[0] - math.pi * 6371008.8) < 1e-3


def test_reach_cells_hold_every_near_point(spark):
    pairs = near_pairs(2, 3000, 299.5) + [(3000, 0.001, 179.9999, -0.001, -179.9999), (3001, 69.9, 0.0, 69.901, -0.004)]
    df = spark.createDataFrame(pairs, SCHEMA)
    near = df.where(G.distance_m(*[F.col(c) for c in COLUMNS]) < 300)
    around = G.reach_cells(F.col("lat"), F.col("lon"), 300.0)
    missed = near.where(~F.array_contains(around, G.reach_cell(F.col("lat2"), F.col("lon2"), 300.0)))
    assert near.count() > 2900 and missed.count() == 0


def test_points_of_one_tight_cell_are_near(spark):
    df = spark.createDataFrame(near_pairs(4, 4000, 150), SCHEMA)
    same = df.where(
        G.tight_cell(F.col("lat"), F.col("lon"), 100.0) == G.tight_cell(F.col("lat2"), F.col("lon2"), 100.0)
    )
    assert same.count() > 200
    assert same.where(G.distance_m(*[F.col(c) for c in COLUMNS]) >= 100).count() == 0


def test_geodesic_of_points_far_apart(spark):
    rng = random.Random(4)
    pairs = near_pairs(3, 200, 1_000_000)
    pairs += [(i, rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-60, 60), rng.uniform(-180, 180)) for i in range(200)]
    pairs += [
        (0, 0.0, 0.0, 0.0, 1.0), (1, 10.0, 20.0, 10.0, 20.0), (2, 0.0, 0.0, 90.0, 0.0), (3, 90.0, 0.0, -90.0, 0.0),
        (4, 5.0, 179.5, 6.0, -179.5), (5, 0.0, 0.0, 0.5, 179.7), (6, 0.0, 0.0, 0.0, 180.0), (7, None, 1.0, 2.0, 3.0),
    ]
    df = spark.createDataFrame(pairs, SCHEMA)
    at = [F.col(c) for c in COLUMNS]
    got = df.select(*COLUMNS, G.geodesic_m(*at).alias("d"), G.haversine_m(*at).alias("sphere")).collect()
    for r in got[:-3]:
        if r["sphere"] < 19_000_000:
            assert abs(r["d"] - vincenty(r["lat"], r["lon"], r["lat2"], r["lon2"])) < 1e-2
        else:
            assert abs(r["d"] / r["sphere"] - 1) < 0.006
    # Nearly antipodal: the geodesic of (0, 0) and (0.5, 179.7) is 19,936.289 km.
    assert abs(got[-3]["d"] / 19_936_289 - 1) < 0.006 and abs(got[-2]["d"] / 20_003_931 - 1) < 0.006
    assert got[-1]["d"] is None
    # Published values: a degree of the equator, a quarter of a meridian.
    assert abs(got[400]["d"] - 111319.4908) < 1e-3 and got[401]["d"] == 0 and abs(got[402]["d"] - 10001965.729) < 1e-2
