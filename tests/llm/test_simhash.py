import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from poilake.llm import components, simhash
from poilake.llm.scratch import Scratch


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(values, bits):
    """Root of each value by comparing all pairs."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_fingerprint_counts_bits():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one two", "É É é", "a\x0bb\x0cc d e f", "x " * 50_000]
    texts += [" ".join(rng.choices(["the", "Of", "and", "da", "ß"], k=rng.randint(1, 40))) for _ in range(40)]
    assert [simhash.fingerprint(t) for t in texts] == [plain(t) for t in texts]


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("añb c")).alias("h")).first()
    assert np.uint64(row.h % (1 << 64)) == xxhash.xxh64_intdigest("añb c".encode(), 42)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_blocks_and_centres_meet_every_close_pair(bits):
    rng = random.Random(bits)
    masks = simhash.block_masks(bits, 3)
    near, far = (set(m) for m in simhash.centre_masks(bits))
    for _ in range(300):
        flips = [1 << b for b in rng.sample(range(64), rng.randint(0, bits))]
        x = sum(flips)
        assert any(x & m == 0 for m in masks)
        # x apart from 0: a centre is reached by near flips of one and near or far flips of the other.
        assert any((n ^ x) in near or (n ^ x) in far for n in near)


def test_components_equal_all_pairs(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(40)]
    for v in list(values[:10]):
        for _ in range(rng.randint(1, 6)):
            for b in rng.sample(range(64), rng.randint(0, 4)):
                v ^= 1 << b
            values.append(v)
    base = rng.getrandbits(64)  # a crowd that shares blocks
    values += [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(260)]
    distinct = sorted(set(values))
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in distinct], "fp long")
    scratch = Scratch(spark, "test")
    found = {r.node: r.root for r in components.components(simhash.links(fps, scratch), scratch).collect()}
    signed = [int(np.uint64(v).view(np.int64)) for v in distinct]
    want = closed(distinct, 3)
    groups, got = {}, {}
    for s, r in zip(signed, want):
        groups.setdefault(r, set()).add(s)
        got.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_rows_of_every_kind(spark):
    long = "word and other " * 30_000
    rows = [(5, "one two three four"), (3, "ONE two  three\nfour"), (5, "one two three four"), (9, None), (7, "  "), (8, ""),
            (None, "one two three four"), (11, long), (10, long), (12, "quite another text altogether here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("component", F.lit(1))
    got = sorted(((r.id, r.component) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (5, 3), (None, 3), (9, 7), (7, 7), (8, 7), (11, 10), (10, 10), (12, 12)], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []


def test_large_ids_beside_null_are_kept(spark):
    docs = spark.createDataFrame([((1 << 60) + 1, "a b c d"), ((1 << 60) + 3, "e f g h"), (None, "i j k l")], "doc_id long, text string").coalesce(1)
    assert {r.id for r in simhash.near_duplicates(docs).collect()} == {(1 << 60) + 1, (1 << 60) + 3, None}
