import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from poilake.operators import names as N
from poilake.operators import resolve as R
from tests.conftest import plan_of
from tests.test_geodesy import vincenty


def grams(key):
    padded = f" {key} "
    return {padded[i : i + 3] for i in range(max(1, len(padded) - 2))}


def jaccard(a, b):
    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("abcé ", max_size=9), max_size=25), st.lists(st.text("abcé ", max_size=9), max_size=25), st.sampled_from([0.3, 0.5, 0.8, 1.0]))
def test_pairs_equal_all_pairs(spark, left, right, least):
    rows = [spark.createDataFrame([(k,) for k in [*side, None]], "key string") for side in (left, right)]
    got = sorted((r.left_key, r.right_key, r.similarity) for r in N.similar_keys(*rows, least).collect())
    want = sorted((a, b, jaccard(a, b)) for a in set(left) for b in set(right) if a and b and jaccard(a, b) >= least)
    assert got == want


def test_common_grams_are_in_no_prefix(spark):
    """Names that all begin alike: pairs meet in what is rare, not in the common beginning."""
    keys = spark.range(400).select(F.concat(F.lit("cafe "), F.lpad(F.hex(F.col("id") * 7919), 6, "x")).alias("key"))
    assert N.similar_keys(keys, keys, 0.9).count() == 400
    rank = keys.select(F.explode(N.grams(F.col("key"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    prefixes = N._prefixed(keys, rank, 0.9)
    assert prefixes.where("gram = 'caf'").count() == 0


def test_lookup_equals_all_pairs(spark):
    rng = random.Random(4)
    words = ["cafe", "sen", "hoan", "kiem", "museum", "lake"]

    def name():
        out = rng.sample(words, rng.randint(1, 3))
        if rng.random() < 0.5:
            at = rng.randrange(len(out))
            out[at] = out[at][:-1] or "x"
        return " ".join(out)

    places = [(i, name(), 21.0 + rng.random() / 50, 105.0 + rng.random() / 50, rng.randint(0, 5)) for i in range(60)]
    places += [(90, "cafe sen", None, 105.0, 9), (91, None, 21.0, 105.0, 9), (92, "...", 21.0, 105.0, 9)]
    asked = [(i, name(), 21.0 + rng.random() / 50, 105.0 + rng.random() / 50) for i in range(40)] + [(50, "Sen Café, Hà Nội", 21.0, None), (51, None, 21.0, 105.0)]
    asked += asked[:3]
    p = spark.createDataFrame(places, "pid long, name string, lat double, lon double, reviews long")
    c = spark.createDataFrame(asked, "id long, name string, lat double, lon double")
    order = [-F.col("reviews"), F.col("pid")]

    def key(text):
        flat = (text or "").lower().replace("é", "e").replace("à", "a").replace("ộ", "o").replace(",", " ").replace(".", " ")
        return " ".join(sorted(set(flat.split()) - {"ha", "noi"}))

    def best(row, within):
        hits = []
        for pid, text, lat, lon, reviews in places:
            if not key(row[1]) or not key(text) or jaccard(key(row[1]), key(text)) < 0.6:
                continue
            if within:
                if None in (lat, lon, row[2], row[3]):
                    continue
                meters = vincenty(row[2], row[3], lat, lon)
                if meters > within:
                    continue
                hits.append((-jaccard(key(row[1]), key(text)), meters, -reviews, pid))
            else:
                hits.append((-jaccard(key(row[1]), key(text)), -reviews, pid))
        return min(hits)[-1] if hits else None

    for within in (None, 900.0):
        got = sorted((r["id"], r["google_data"]["pid"]) for r in R.enrich(c, p, "Hà Nội", order, within=within).collect())
        assert got == sorted((r[0], best(r, within)) for r in asked if best(r, within) is not None)
    assert R.enrich(c.where("false"), p, "Hà Nội", order).count() == 0 == R.enrich(c, p.where("false"), "Hà Nội", order, within=5.0).count()


def test_frequent_grams_are_split(spark, monkeypatch):
    """Keys that share a gram are compared in several parts, and no pair is lost or repeated."""
    monkeypatch.setattr(N, "GROUP", 3)
    keys = [f"cafe {a}{b}" for a in "abcdef" for b in "uvwxyz"]
    rows = spark.createDataFrame([(k,) for k in keys], "key string")
    got = sorted((r.left_key, r.right_key, r.similarity) for r in N.similar_keys(rows, rows, 0.4).collect())
    assert got == sorted((a, b, jaccard(a, b)) for a in keys for b in keys if jaccard(a, b) >= 0.4)


def test_lookup_joins_no_broadcast_table(spark):
    """Stored tables of names are compressed, so their size says little of what a broadcast takes."""
    p = spark.range(50).select(F.col("id").alias("pid"), F.concat(F.lit("cafe "), F.col("id") % 3).alias("name"), F.lit(21.0).alias("lat"), F.lit(105.0).alias("lon"))
    for within in (None, 500.0):
        plan = plan_of(R.enrich(p.drop("pid"), p, "Hà Nội", [F.col("pid")], within=within))
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan
