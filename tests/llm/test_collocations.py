import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from poilake.llm import collocations as c

KIND = "lang string, text string"


def plain(rows, least, longest, top, subsumed):
    counts = {}
    for lang, text in rows:
        lowered = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts.setdefault("und" if lang is None else lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        found = {k: v for k, v in f.items() if len(k) > 1 and v >= least}
        scored = []
        for k, a in found.items():
            inside = (q for q, b in found.items() if len(q) > len(k) and 100 * b >= subsumed * a)
            if any(q[i : i + len(k)] == k for q in inside for i in range(len(q))):
                continue
            score, cut = min((10**6 * a * a // (f[k[:i]] * f[k[i:]]), i) for i in range(1, len(k)))
            scored.append((-score, -a, " ".join(k).encode(), f[k[:cut]], f[k[cut:]]))
        out += [(lang, r, p.decode(), -a, l, rest, n, -s) for r, (s, a, p, l, rest) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("block, longest", [(64, 3), (1 << 20, 4)])
def test_equals_plain_counting(spark, block, longest):
    rng = random.Random(1)
    words = ["The", "of", "é", "zz", "a b", "İx", "q", "the", "\x1f", "x,y"]
    rows = [
        (rng.choice(["en", None, "de", ""]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n", " "]) for _ in range(rng.choice([0, 1, 5, 300]))))
        for _ in range(60)
    ] + [("en", None), ("en", ""), ("en", "x " * 400), ("en", "x " * 400)]
    docs = spark.createDataFrame(rows, KIND).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("a")).repartition(3)
    got = sorted(map(tuple, c.collocations(docs, least=3, longest=longest, top=40, block=block).collect()))
    assert got == plain(rows, 3, longest, 40, 50) and len(got) > 100


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**16 - 1
    a, left, right = big - 12_345, big, big - 7
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(c._score(F.col("a"), F.col("l"), F.col("r"), 10**6)).first()
    assert row[0] == 10**6 * a * a // (left * right)


def test_empty_table(spark):
    assert c.collocations(spark.createDataFrame([], KIND)).collect() == []
