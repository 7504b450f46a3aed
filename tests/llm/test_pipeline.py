import random

import corpus_pipeline
from poilake.llm import decontaminate, linededup, simhash


def corpus(spark, folder):
    rng = random.Random(7)
    words = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "ma", "ne") for b in ("ra", "so", "ti", "vu", "wo", "xa", "ye")]
    bench = [(i, " ".join(rng.choices(words, k=30))) for i in range(5)]
    rows, labels = [], []
    for i in range(160):
        text = " ".join(rng.choices(words, k=rng.randint(40, 90)))
        toxic = i % 8 == 0
        if toxic:
            text += " idiot scum moron idiot scum"
        elif i % 8 == 1:
            text = rows[i - 5][1].removeprefix("Cookie notice\n") if i > 5 else text
        elif i % 8 == 2:
            text += " " + bench[i % 5][1]
        rows.append((i, f"Cookie notice\n{text}", "en", f"src{i % 2}", 0))
        labels.append((i, 1, int(toxic)))
    rows.append((900, None, None, None, None))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, bench


def test_stages_one_by_one(spark, folder):
    rows, bench = corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < 4:
            assert out.columns == docs.columns, name
            out.write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
            kept.append({r.doc_id: r.text for r in docs.collect()})
    toxic = {r[0] for r in rows if r[1] and "idiot" in r[1]}
    assert set(kept[0]) == {r[0] for r in rows} - toxic
    assert kept[1] == {d: t if t is None else t.removeprefix("Cookie notice\n") for d, t in kept[0].items()}
    groups = {}
    prints = {d: simhash.fingerprint(t) for d, t in kept[1].items()}
    for d in sorted(prints):
        near = [g for g in groups if any((prints[d] ^ prints[e]).bit_count() <= 3 for e in groups[g])]
        merged = sum((groups.pop(g) for g in near), [d])
        groups[min(merged)] = merged
    assert set(kept[2]) == set(groups) and len(groups) < len(kept[1])
    leaked = {d for d, t in kept[2].items() if any(t and decontaminate.align(decontaminate.words(t), decontaminate.words(p))[0] >= len(p.split()) for _, p in bench)}
    assert leaked and set(kept[3]) == set(kept[2]) - leaked
    packed = out.collect()
    assert {r.doc_id for r in packed} == set(kept[3])
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.start, bytes(r.ids)) for r in whole) == sorted((r.doc_id, r.start, bytes(r.ids)) for r in packed)


def test_extra_columns_and_empty_tables(spark, folder):
    kind = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, row string, _judged int"
    docs = spark.createDataFrame([], kind)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.collect() == [], name
        if name != "packing":
            assert out.columns == docs.columns
    assert linededup.SALTS and corpus_pipeline.ORACLE_SQL is None


def test_null_and_repeated_ids(spark, folder):
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in ("ba", "do", "ki", "lu") for b in ("ra", "so", "ti", "vu") for c in ("m", "n", "p")]
    a, b, c, leak = (" ".join(rng.choices(words, k=60)) for _ in range(4))
    item = " ".join(rng.choices(words, k=30))
    rows = [(9, a), (10, a), (None, a), (None, b), (None, b), (-3, c), (-3, c), (5, "x " + leak), (5, leak + " y " + item)]
    docs = spark.createDataFrame([(*r, "en", "src", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, docs, folder)
    assert got.columns == docs.columns
    want = [(9, a), (None, b), (-3, c), (5, "x " + leak), (5, leak + " y " + item)]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, want))

    # A null id that holds an item goes, also an item of a null id; other rows of the id stay.
    spark.createDataFrame([(None, item), (1, b)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(None, a), (None, b), (None, a + " " + item), (5, c), (5, c), (5, c + " " + item)]
    docs = spark.createDataFrame([(*r, "en", "src", 0) for r in rows], docs.schema)
    got = corpus_pipeline.drop_leaks(spark, docs, folder)
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, [(None, a), (5, c), (5, c)]))
    found = decontaminate.leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()
    assert {(r.doc, r.item) for r in found} == {(None, None), (None, 1), (5, None)}


def test_repeated_rows_with_columns_that_have_no_order(spark, folder):
    kind = "doc_id long, text string, lang string, source string, n_chars long, extra map<string,int>"
    rows = [(1, "a b c d", "en", "s", 7, {"x": 1}), (1, "a b c d", "en", "s", 7, {"x": 2}), (2, "e f g h", "en", "s", 7, None)]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, kind), folder).collect()
    assert sorted(r.doc_id for r in got) == [1, 2]


def test_texts_are_shuffled_once_for_near_copies(spark, folder):
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in ("ba", "do", "ki", "lu") for b in ("ra", "so", "ti", "vu") for c in ("m", "n", "p")]
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(600)]
    rows += [(1000 + i, text) for i, text in rows] + [(7, rows[7][1])]
    docs = spark.createDataFrame([(*r, "en", "src", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12k")  # below the keys of 600 copies
    try:
        got = corpus_pipeline.drop_near_copies(spark, docs, folder)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert sorted(r.doc_id for r in got.collect()) == list(range(600))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1, plan
