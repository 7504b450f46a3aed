import random

import numpy as np
from pyspark.sql import functions as F

from poilake.llm import decontaminate as d


def plain(a, b):
    """Smith-Waterman cell by cell."""
    h = np.zeros((len(b) + 1, len(a) + 1), dtype=int)
    for i in range(1, len(b) + 1):
        for j in range(1, len(a) + 1):
            s = d.MATCH if a[j - 1] == b[i - 1] else d.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + d.GAP, h[i, j - 1] + d.GAP)
    return int(h.max())


def test_alignment_equals_the_plain_one():
    rng = random.Random(2)
    for _ in range(60):
        a = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 25))]
        b = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 25))]
        assert d.align(a, b)[0] == plain(a, b)


def test_edited_copies_are_found_like_by_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(12)]
    docs = []
    for n in range(60):
        body = rng.choices(vocabulary, k=120)
        if n % 2:
            copy = items[rng.randrange(12)][1].split()
            for _ in range(n % 8):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], ["new"], [copy[at], "more"]])
            body[40:40] = copy
        docs.append((n, " ".join(body)))
    docs += [(90, None), (91, ""), (92, items[0][1]), (92, items[0][1]), (93, "x " * 60_000 + items[1][1].upper())]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)).withColumn("gram", F.lit(1))
    bench = spark.createDataFrame([*items, (70, None), (71, ""), (72, "w1 w2"), (0, items[0][1])], "item_id long, text string")
    got = {(r.doc, r.item): r.score for r in d.leaks(frame, bench.withColumn("doc", F.lit(2))).collect()}
    want = {}
    for doc, text in docs:
        for item, passage in items:
            w = d.words(passage)
            score = d.align(d.words(text), w)[0] / (d.MATCH * len(w))
            if score >= 0.5:
                want[doc, item] = score
    assert got == want and (92, 0) in got and (93, 1) in got


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some, item = spark.createDataFrame([(1, "a b c d")], docs.schema), spark.createDataFrame([(1, "a b c d")], bench.schema)
    assert d.leaks(docs, item).collect() == [] and d.leaks(some, bench).collect() == []
    assert [r.score for r in d.leaks(some, item).collect()] == [1.0]


def test_single_edited_copies_are_found_down_to_the_threshold(spark):
    rng = random.Random(5)
    items, docs = [], []
    for i in range(40):
        item = [f"i{i}w{j}" for j in range(rng.randint(16, 45))]
        # One word in eight, so that an edit falls into every four trigrams, or words at random.
        edits = range(4, len(item), 8) if i < 8 else rng.sample(range(len(item)), rng.randint(1, len(item) * 2 // 5))
        copy = [f"new{i}n{j}" if j in edits else w for j, w in enumerate(item)]
        items.append((i, " ".join(item)))
        docs.append((i, " ".join([f"a{i}", f"b{i}"] * 20 + copy + [f"c{i}"] * 30)))
    got = {
        (r.doc, r.item): r.score
        for r in d.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    }
    want = {}
    for (i, item), (_, text) in zip(items, docs):
        w = d.words(item)
        score = d.align(d.words(text), w)[0] / (d.MATCH * len(w))
        if score >= 0.5:
            want[i, i] = score
    assert got == want and {(i, i) for i in range(8)} <= set(want) and 10 < len(want) < 40
    assert min(want.values()) < 0.6


def test_large_ids_beside_null_are_kept(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([((1 << 60) + 1, text), ((1 << 60) + 3, text), (None, text)], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([((1 << 60) + 5, text), (None, "x y z " * 9)], "item_id long, text string").coalesce(1)
    found = {(r.doc, r.item) for r in d.leaks(docs, bench).collect()}
    assert found == {(i, (1 << 60) + 5) for i in ((1 << 60) + 1, (1 << 60) + 3, None)}


def test_a_long_item_leaves_the_reach_of_others(spark):
    short, long = " ".join(f"s{i}" for i in range(30)), " ".join(f"l{i}" for i in range(600))
    docs = spark.createDataFrame([(1, "a b " * 90 + short), (2, long + " c d" * 90)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")
    assert {(r.doc, r.item, r.score) for r in d.leaks(docs, bench).collect()} == {(1, 1, 1.0), (2, 2, 1.0)}
    items = {r["item"]: r["reach"] for r in d._items(bench, "item_id", "text", 0.5).collect()}
    assert items == {1: 128, 2: 0}


def test_common_words_of_an_item_are_no_seeds(spark):
    """Of an item's n-grams those far more common than its rarest quarter are left out, a copied passage's are not."""
    copied = " ".join(f"p{i}" for i in range(24))
    docs = [(i, "so it is that it was so " * 3 + (copied if i % 3 == 0 else f"q{i} r{i} t{i}")) for i in range(150)]
    mixed = "m0 m1 m2 m3 m4 m5 m6 m7 so it is that it was so m8 m9 m10 m11 m12"
    docs.append((999, mixed))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, copied), (2, mixed)], "item_id long, text string")
    assert {(r.doc, r.item) for r in d.leaks(frame, bench).collect()} == {(i, 1) for i in range(0, 150, 3)} | {(999, 2)}
    items = d._items(bench, "item_id", "text", 0.5)
    hits = d._hits(frame, "doc_id", "text", spark.sparkContext.broadcast(d._filters(items)), d._vocabulary(bench, "text"))
    seeds = {(r["item"], r["place"]) for r in d._rare(items, hits).collect()}
    assert {p for i, p in seeds if i == 1} == set(range(22)) and not {10, 11, 12} & {p for i, p in seeds if i == 2}
