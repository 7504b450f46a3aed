import random
import re

from pyspark.sql import functions as F

from poilake.llm import queries, spotsigs as s


def plain(text):
    """Signatures as (anchors and word, next word)."""
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    glued, held = [], ["^"]
    for w in words:
        if w in s.ANCHORS:
            held.append(w)
        else:
            glued.append((tuple(held), w))
            held = []
    if held and words:
        glued.append((tuple(held), ""))
    return {(a, w, glued[i + 1][1] if i + 1 < len(glued) else "") for i, (a, w) in enumerate(glued) if a}


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def texts(n, seed):
    rng = random.Random(seed)
    pool = ["the", "of", "and", "The", "der", "la", "house", "Tree", "stone,", "ríver", "42", "old.", "it's", "new"]
    return [" ".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(n)]


def test_signatures_equal_the_plain_ones(spark):
    rows = [None, "", " .,- ", "the", "house", "the of", "THE House of the Tree", *texts(60, 1), "the big house " * 40_000]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("spots", F.lit(1)).withColumn("id", F.lit(2))
    got = {r.id: r for r in s.signatures(df).collect()}
    sets = [plain(t) for t in rows]
    for i, a in enumerate(sets):
        assert len(got[i].spots) == len(a), rows[i]
        for j in range(i):
            same = len(set(got[i].spots) & set(got[j].spots))
            assert same == len(a & sets[j])
            assert (got[i].fingerprint == got[j].fingerprint) == (a == sets[j])


def test_likeness_and_its_pruning(spark):
    df = spark.createDataFrame([([], []), ([1], []), ([1, 2, 3, 4], [3, 4, 5, 6]), ([1], [1, 2, 3, 4])], "a array<long>, b array<long>")
    rows = df.select(s.likeness(F.col("a"), F.col("b")), s.likeness(F.col("a"), F.col("b"), 0.3)).collect()
    assert [round(r[0], 6) for r in rows] == [1.0, 0.0, 0.333333, 0.25] and [r[1] for r in rows][3] == 0.0


def test_matches_equal_all_pairs(spark):
    rng = random.Random(4)
    base = texts(30, 5)
    rows = base + [" ".join(w if rng.random() > 0.04 else "changed" for w in t.split()) for t in base for _ in range(3)] + base[:3] + ["", None]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    signed = s.signatures(df)
    asked = signed.where("id % 10 = 0")
    got = {(r.query, r.id): round(r.likeness, 9) for r in s.matches(asked, signed, 0.6).collect()}
    sets = [plain(t) for t in rows]
    want = {(i, j): round(jaccard(sets[i], sets[j]), 9) for i in range(0, len(rows), 10) for j in range(len(rows)) if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.6}
    assert got == want and len(want) > 30


def test_neighbours_beside_null_repeated_and_text_ids(spark):
    rng = random.Random(9)
    ids = [None, None, 1 << 60, (1 << 60) + 1, -5, 3, 3, 700]
    rows = [(i, f"text {n}") for n, i in enumerate(ids)]
    for kind, shown in (("long", lambda i: i), ("string", lambda i: i if i is None else f"{i + (1 << 61):020d}")):
        shuffled = [(shown(i), t) for i, t in rows]
        rng.shuffle(shuffled)
        paired, _ = s.with_next(spark.createDataFrame(shuffled, f"doc_id {kind}, text string"))
        got = {r.text: (r.id, r.next_text) for r in paired.where("ghost = 0").collect()}
        assert {t: i for t, (i, _) in got.items()} == {t: i for i, t in shuffled} and len(got) == len(rows)
        # One circle through all documents, in the order of ids, null ids first.
        at, walk = next(t for t, (i, _) in got.items() if i is not None and got[t][0] == shown(1 << 60)), []
        for _ in rows:
            at = got[at][1]
            walk.append(got[at][0])
        assert sorted(walk, key=repr) == sorted((shown(i) for i in ids), key=repr)
        first = walk.index(None)
        walk = walk[first:] + walk[:first]
        walk = walk if walk[1] is None else walk[-1:] + walk[:-1]
        assert walk == [shown(i) for i in (None, None, -5, 3, 3, 700, 1 << 60, (1 << 60) + 1)]


def test_neighbours_across_runs(spark):
    ids = [5, 255, 256, 3000, 3001, 90_000, -7]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    paired, _ = s.with_next(df)
    got = {r.id: r.next_text for r in paired.where("ghost = 0").collect()}
    order = sorted(ids)
    assert got == {i: f"text {order[(k + 1) % len(ids)]}" for k, i in enumerate(order)}
    one, _ = s.with_next(df.where("doc_id = 5"))
    assert [r.next_text for r in one.where("ghost = 0").collect()] == ["text 5"]
    assert s.with_next(df.limit(0))[0].where("ghost = 0").collect() == []


def test_query_over_a_small_table(spark, folder):
    import hashlib

    rows = list(enumerate([*texts(25, 9), None, "", "x", "é" * 9, "twin text of the house", "twin text of the house"]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_spotsigs(spark, folder).collect()}
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(got[i].near_edited - jaccard(plain(text), plain(edited))) < 1e-9
        assert abs(got[i].near_next - jaccard(plain(text), plain(following))) < 1e-9
    plan = s.signatures(spark.createDataFrame(rows, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
