import random

import numpy as np
from pyspark.sql import functions as F

from poilake.llm import cover_tree as t
from poilake.llm import negatives as n

KIND = "vec_id long, label int, embedding array<long>"


def test_search_equals_brute_force():
    rng = np.random.default_rng(0)
    for rows, dim, scale in [(1, 3, 5), (9, 1, 3), (500, 2, 40), (3000, 3, 100), (600, 32, 30), (300, 4, 1)]:
        x = np.floor(rng.normal(size=(rows, dim)) * scale)
        if rows > 100:
            x[rng.integers(0, rows, rows // 3)] = x[0]
        tree, ids, labels = t.build(x), rng.permutation(rows).astype(np.int64), rng.integers(0, 3, rows)
        assert sorted(tree.order.tolist()) == list(range(rows))
        queries = np.floor(rng.normal(size=(30, dim)) * scale)
        wanted, asks = [], []
        for q in queries:
            low, high = sorted(rng.choice(x @ q, 2))
            asks.append(t.Ask(3, [(low, high), (high, high), (5, 4)]))
            wanted.append([(low, high), (high, high)])
        t.search(tree, x, ids, queries, asks, lambda q, some: labels[some] != q % 3)
        for i, (q, ask) in enumerate(zip(queries, asks)):
            s = x @ q
            for (low, high), best in zip(wanted[i], ask.best):
                at = np.flatnonzero((labels != i % 3) & (s >= low) & (s <= high))
                assert list(zip((-best.scores).tolist(), best.ids.tolist())) == sorted((-int(s[j]), int(ids[j])) for j in at)[:3]
            assert not len(ask.best[2].ids)


def test_covering_radii_hold():
    x = np.floor(np.random.default_rng(1).normal(size=(800, 2)) * 50)
    tree = t.build(x)
    extra = np.sqrt((x**2).sum(1).max() - (x**2).sum(1))
    y = np.column_stack([x, extra])

    def below(node):
        rows = tree.order[tree.row_from[node] : tree.row_to[node]].tolist()
        for child in range(tree.child_from[node], tree.child_to[node]):
            rows += below(child)
        far = np.sqrt(((y[rows] - y[tree.point[node]]) ** 2).sum(1).max())
        assert far <= tree.radius[node] + 1e-6
        return rows

    assert sorted(below(0)) == list(range(800)) and len(tree.point) > 20


def plain(rows):
    whole = sorted({(i, l, tuple(v)) for i, l, v in rows if l is not None and v is not None and None not in v}, key=str)

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))  # the shorter one is filled up with zeros

    def key(pair):
        return -pair[0], pair[1] is None, pair[1] or 0

    out = []
    for a in whole:
        if a[0] is None or a[0] % 10:
            continue
        near = sorted(((dot(a[2], b[2]), b[0]) for b in whole if b != a and b[1] == a[1]), key=key)[:5]
        for p, i in near:
            hard = sorted(((dot(a[2], b[2]), b[0]) for b in whole if b[1] != a[1] and 50 * p <= 100 * dot(a[2], b[2]) <= 95 * p), key=key)
            out += [(a[0], i, r, j, p, s) for r, (s, j) in enumerate(hard[:3], 1)]
    return sorted(out, key=str)


def test_mining_equals_brute_force_in_many_blocks(spark, monkeypatch):
    rng = random.Random(5)

    def vector():
        return rng.choice([None, [], [1, None], [3, 3, 3], [3, 3, 3], [rng.randint(-3, 6) for _ in range(3)], [rng.randint(-3, 6) for _ in range(2)]])

    rows = [(rng.choice([None, *range(-20, 120)]), rng.choice([None, 0, 1, 2]), vector()) for _ in range(400)]
    rows += rows[:30]
    frame = spark.createDataFrame(rows, KIND).withColumn("id", F.lit(0)).withColumn("vec", F.lit("x")).withColumn("anchor", F.lit(1)).repartition(3)
    for name, size in (("TREE", 16), ("BLOCK", 32), ("CHUNK", 5)):
        monkeypatch.setattr(n, name, size)
    got = sorted(map(tuple, n.mine(frame, F.col("vec_id") % 10 == 0).collect()), key=str)
    assert got == plain(rows) and len(got) > 100
    assert n.mine(frame.where("false"), F.lit(True)).collect() == [] == n.mine(frame, F.lit(False)).collect()
