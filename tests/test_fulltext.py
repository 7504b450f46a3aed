"""The stored index against a plain scan, and merged profiles against exact ones."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from poilake.operators import fulltext, profiles, report
from poilake.sources.tables import write_partitions
from tests.conftest import plan_of

TEXTS = ["The cat, the dog", "dog dog DOG", None, "", "été à l'été_2 the", "a b c d e f g the cat", "the"]


def plain(rows, query):
    words = {i: re.findall(r"\w+", (t or "").lower()) for i, t in rows}
    asked = set(re.findall(r"\w+", query.lower()))
    df = Counter(w for ws in words.values() for w in set(ws))
    mean = sum(map(len, words.values())) / len(words)
    out = []
    for i, ws in words.items():
        tf = Counter(w for w in ws if w in asked)
        if tf:
            weight = sum(
                math.log(1 + (len(words) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ws) / mean))
                for w, n in tf.items()
            )
            out.append((i, len(tf), round(weight, 6)))
    return sorted(out, key=lambda r: (-r[2], r[0]))


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")


def found(spark, path, query, k=100):
    return [(r["id"], r["matches"], round(r["weight"], 6)) for r in fulltext.search_index(spark, path, query, k).collect()]


def test_segments_answer_like_one_scan(spark, docs, folder):
    rows = list(enumerate(TEXTS))
    fulltext.index_texts(docs.where("id < 4"), folder, "1", "id", "text", buckets=4)
    for query in ("the dog", "Dog", "none", "", "the the THE"):
        assert found(spark, folder, query) == plain(rows[:4], query)
    for _ in range(2):  # given again it replaces itself; what segment 1 has stays there
        fulltext.index_texts(docs, folder, "02", "id", "text", buckets=16)
        for query in ("the dog", "été", "l ÉTÉ_2 cat", "g", "?!"):
            assert found(spark, folder, query) == plain(rows, query)
    assert found(spark, folder, "the cat", 1) == plain(rows, "the cat")[:1]
    assert spark.read.parquet(f"{folder}/totals").agg(F.sum("documents")).first()[0] == len(TEXTS)


def test_only_the_folders_of_the_words_are_read(spark, docs, folder):
    fulltext.index_texts(docs, folder, "s", "id", "text", buckets=16)
    own = sorted(zlib.crc32(w.encode()) % 16 for w in ("cat", "dog"))
    plan = plan_of(fulltext.search_index(spark, folder, "cat dog", 5))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(%d,%d\)" % tuple(own), plan), plan
    assert re.search(r"PushedFilters: \[[^\]]*In\(term, \[cat,dog\]\)", plan), plan


def test_empty_table(spark, docs, folder):
    fulltext.index_texts(docs.where("id < 0"), folder, "s", "id", "text")
    assert found(spark, folder, "the") == []
    fulltext.index_texts(docs, folder, "t", "id", "text")
    assert found(spark, folder, "the") == plain(list(enumerate(TEXTS)), "the")


def test_ids_of_null_and_stored_columns(spark, folder):
    df = spark.createDataFrame([(None, "x y", "n"), (2**60 + 1, "x", "big")], "k long, t string, note string")
    fulltext.index_texts(df, folder, "s", "k", "t", ["note"])
    fulltext.index_texts(df, folder, "t", "k", "t", ["note"])
    got = {(r["id"], r["note"], r["matches"]) for r in fulltext.search_index(spark, folder, "x y", 9).collect()}
    assert got == {(None, "n", 2), (2**60 + 1, "big", 1)}


def profile_table(spark):
    return spark.range(20000).select(
        (F.col("id") % 7).cast("int").alias("day"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 0.5).alias("v"),
        F.concat(F.lit("n"), F.col("id") % 3000).alias("name"),
        F.lit(None).cast("int").alias("nothing"),
        F.when(F.col("id") % 2 == 0, F.array(F.col("id") % 3)).alias("list"),
        F.lit(float("nan")).alias("nan"),
    )


def test_merged_profiles_keep_counts_and_their_error(spark, folder):
    df = profile_table(spark)
    write_partitions(profiles.partial_profiles(df, "day"), folder, "day")
    stored = spark.read.parquet(folder)
    assert stored.count() == 7 * 5
    for days in (range(7), (2, 5)):
        part = df.where(F.col("day").isin(*days))
        exact = {r["column"]: r for r in report.profile(part, ["v", "name", "nothing", "list"]).collect()}
        got = {r["column"]: r for r in profiles.merged_profiles(stored.where(F.col("day").isin(*days))).collect()}
        for name, want in exact.items():
            for field in ("rows", "present", "null_pct", "min_value", "max_value", "mean_value"):
                assert got[name][field] == want[field], (name, field)
            assert abs(got[name]["distinct_values"] - want["distinct_values"]) <= 0.05 * want["distinct_values"]
        assert got["nan"]["present"] == part.count() and got["nan"]["q50"] is None and got["nan"]["mean_value"] is None
        assert got["name"]["q50"] is None and got["nothing"]["distinct_values"] == 0
        n = part.where("v is not null").count()
        for q in (25, 50, 75):
            assert abs(part.where(F.col("v") <= got["v"][f"q{q}"]).count() / n - q / 100) < 0.02


def test_profiles_of_an_empty_table(spark):
    partials = profiles.partial_profiles(profile_table(spark).where("false"), "day")
    assert profiles.merged_profiles(partials).collect() == []


def test_words_are_counted_in_their_row(spark):
    """No shuffle of words: equal ones are runs of the sorted row."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, "b a b", " , "])], "id long, text string")
    counted = df.select("id", F.inline(fulltext._counted(fulltext.terms_of(F.col("text")))))
    assert "Exchange" not in plan_of(counted)
    got = {(r["id"], r["term"], r["n"]) for r in counted.collect()}
    want = {(r["id"], w, n) for r in df.collect() for w, n in Counter(re.findall(r"\w+", (r["text"] or "").lower())).items()}
    assert got == want


def test_rows_of_one_id_and_length_are_one_document(spark, folder):
    df = spark.createDataFrame([(1, "a b"), (1, "a c"), (1, "a"), (None, "b"), (None, "b"), (None, None)], "id long, text string")
    fulltext.index_texts(df, folder, "s", "id", "text", buckets=2)
    got = sorted((r["id"] or 0, r["length"], r["term"], r["n"]) for r in spark.read.parquet(f"{folder}/postings").collect())
    assert got == [(0, 1, "b", 2), (1, 1, "a", 1), (1, 2, "a", 2), (1, 2, "b", 1), (1, 2, "c", 1)]
    assert spark.read.parquet(f"{folder}/documents").count() == 6
