import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from poilake.llm import toxicity as t


def plain_segments(values):
    """All maximal segments by their definition: split around the best one, again and again."""
    out = []

    def walk(lo, hi):
        best, where = 0.0, None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += values[j]
                if total > best + 1e-12:
                    best, where = total, (i, j)
        if where:
            walk(lo, where[0])
            out.append((best, *where))
            walk(where[1] + 1, hi)

    walk(0, len(values))
    return out


def test_segments_are_the_maximal_ones():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 25)
        # Sums that differ in every subset, so that no two segments tie.
        scores = {i: rng.uniform(-3, 3) for i in range(n) if rng.random() < 0.6}
        values = [scores.get(i, -0.25) for i in range(n)]
        got = t.segments(sorted(scores.items()), 0.25, n)
        assert [(i, j) for _, i, j in got] == [(i, j) for _, i, j in plain_segments(values)]
        assert all(abs(a[0] - b[0]) < 1e-9 for a, b in zip(got, plain_segments(values)))
    assert t.segments([], 0.1, 5) == []


def corpus(n, seed):
    rng = random.Random(seed)
    words = [a + b + c for a, b, c in itertools.product(["ba", "do", "ki", "lu"], ["me", "no", "ra"], ["", "s", "tum"])]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 120))
        toxic = int(rng.random() < 0.2)
        for _ in range(toxic * rng.randint(2, 6)):
            text[rng.randrange(len(text))] = rng.choice(["idiot", "scum", "moron", "zzork" + rng.choice(["a", "en", "ig", "ung"])])
        rows.append((i, " ".join(text).capitalize(), toxic))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(500, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return docs, labels, t.fit(docs, labels)


def test_held_out_documents(spark, fitted):
    rows = corpus(300, 3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.id: r for r in t.score(docs, fitted[2]).collect()}
    right = sum((got[i].score >= 0.3) == bool(y) for i, _, y in rows)
    assert right >= 0.97 * len(rows)
    toxic = [got[i] for i, _, y in rows if y]
    assert sum(r.passages > 0 and r.worst is not None for r in toxic) >= 0.9 * len(toxic)
    # An ending that was never seen inherits from the word's beginning.
    assert fitted[2].odds("zzorklos") > 0 and fitted[2].odds("bames") <= 0.5


def test_rows_of_every_kind(spark, fitted):
    model = fitted[2]
    long = "bame dono " * 50_000
    rows = [(1, None), (2, ""), (3, " .,!"), (4, long), (4, long), (None, "you idiot scum moron"), (6, "IDIOT, scum! moron idiot"), (7, long + "idiot scum idiot moron scum idiot " * 5)]
    docs = spark.createDataFrame(rows, "id long, body string").withColumns({c: F.lit(1) for c in ("score", "passages", "j")})
    got = t.score(docs, model, "id", "body").collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
        assert 0 <= r.score <= 1
    assert len(by[4]) == 2 and by[4][0].score == by[4][1].score
    assert by[1][0].score == by[2][0].score == by[3][0].score < 0.3 and by[1][0].passages == 0
    assert by[None][0].score > 0.3 and by[6][0].score > 0.3 and by[7][0].score > 0.3
    assert t.score(docs.limit(0), model, "id", "body").collect() == []


def test_labels_of_one_kind_or_none(spark, fitted):
    docs, labels, _ = fitted
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        model = t.fit(docs, some)
        assert {r.score < 0.3 for r in t.score(docs, model).collect()} == {True}


def test_the_sample_is_bounded(spark, fitted):
    docs, labels, _ = fitted
    n = t.labelled(docs, labels.unionByName(labels), "doc_id", "text", "toxic", 100).count()
    assert 60 <= n <= 140


def test_only_copies_leave_the_sample(spark):
    shared = "all rights reserved"
    rows = [f"{w}a {w}b {w}c {w}d {w}e {shared}." for w in ("ka", "lo", "mi", "nu", "pe", "ri", "su", "ta")]
    rows += [f"{w}." for w in ("yes", "no", "so")] + ["", "12", "good day!", "fine day!"]
    copies = ["good day?", "Good  day", rows[0].upper()]  # equal in all but case and punctuation
    texts = [*rows, *copies]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(0).alias("toxic"))
    got = sorted(r.text for r in t.labelled(docs, labels, "doc_id", "text", "toxic", 1000).collect())
    kept = {tuple(t.tokens(x)) for x in got}
    assert kept == {tuple(t.tokens(x)) for x in texts} and len(got) == len(kept)


def test_a_passage_scores_alike_wherever_it_is(spark, fitted):
    model = fitted[2]
    passage, filler = "you idiot scum moron zzorken", "bame dono " * 1500
    # Copies and stray words that lie before a passage take nothing from it.
    text = ("idiot " + filler + "scum " + filler) + (passage + " " + filler) * 12
    docs = spark.createDataFrame([(1, passage), (2, text)], "doc_id long, text string")
    got = {r.id: r for r in t.score(docs, model).collect()}
    assert got[2].passages == 12 and len(got[2].spans) == 12 and len(got[1].spans) == 1
    words = t.tokens(text)
    best = got[1].spans[0].score
    for s in got[2].spans:
        assert abs(s.score - best) < 1e-9 and words[s.first : s.last + 1] == t.tokens(got[1].worst)
    # The evidence is that of all segments, not of some of the best.
    weak = [(1.0 / model.rate + math.log(model.scale * 1000) / model.rate, i, i) for i in range(40)]
    assert model.evidence(weak, 1000) > model.evidence(weak[:10], 1000) + 1
