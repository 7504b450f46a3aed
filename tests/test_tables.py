"""Quality rules, landing, stored tables, maintenance, the whole run and its stream."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import bronze
from poilake import schemas
from poilake.operators import quality as Q
from poilake.plans import marts
from poilake.plans.medallion import Paths, QualityError, run_medallion
from poilake.plans.silver import build_silver
from poilake.sources import bronze as B
from poilake.sources import tables as T
from poilake.streaming import incremental as I
from tests.conftest import plan_of

DAY = date(2024, 6, 1)


def record(i, name="place", rating=4.0, stamp="2024-06-01T00:00:00Z"):
    return (
        (i, "node", f"{name} {i}", {"tourism": "museum"}, 21.0 + i / 1000, 105.8),
        (f"{name} {i}", "street", ((21.0 + i / 1000, 105.8),), rating, 5, None, None, ["museum"], None, None, None),
        stamp,
    )


def records(spark, rows):
    fields = schemas.ENRICHED.split("ingested_at string")[0] + "ingested_at string"
    return spark.createDataFrame(rows, fields)


def test_suite(spark):
    df = spark.createDataFrame([(1, 4.0, "a"), (1, 6.0, "b"), (None, None, None)], "k int, r double, c string")
    rules = [
        Q.not_null("k"), Q.accepted_range("r", 0, 5), Q.accepted_values("c", ["a"]), Q.unique("k"), Q.not_null("gone"),
        Q.unique("k", "gone"), Q.accepted_range("r", 5.0), Q.accepted_range("r", high=10.0),
    ]
    got = [(r["rule"], r["column"], r["failed"], r["success"]) for r in Q.run_suite(df, rules).collect()]
    assert sorted(got) == sorted([
        ("not_null", "k", 1, False), ("accepted_range", "r", 1, False), ("accepted_values", "c", 1, False),
        ("unique", "k", 1, False), ("not_null", "gone", 3, False), ("unique", "k,gone", 3, False),
        ("accepted_range", "r", 1, False), ("accepted_range", "r", 0, True),
    ])
    assert not Q.suite_passes(Q.run_suite(df, rules))
    empty = df.where("1 = 0")
    assert all(r["total"] == 0 for r in Q.run_suite(empty, rules).collect())
    assert Q.suite_passes(Q.run_suite(empty, rules))
    assert Q.run_suite(df, []).count() == 0


def test_suite_scans_once(spark, folder):
    spark.range(10).withColumn("r", F.col("id") / 2).write.parquet(folder)
    rules = [Q.not_null("id"), Q.accepted_range("r", 0, 5), Q.accepted_values("id", [1])]
    assert plan_of(Q.run_suite(spark.read.parquet(folder), rules)).count("FileScan") == 1


def test_quarantine(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 9.0), (None, None)], "k int, r double")
    good, bad = Q.quarantine(df, [Q.not_null("k"), Q.accepted_range("r", 0, 5)])
    assert [r["k"] for r in good.collect()] == [1]
    assert sorted(r["reasons"] for r in bad.collect()) == [["accepted_range:r"], ["not_null:k"]]


def test_content_hash(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b")], "x int, y string, z string")
    same = Q.content_hash(df.select("z", "y", "x").repartition(3)).first()
    assert Q.content_hash(df).first() == same
    moved = spark.createDataFrame([(1, None, "a"), (2, None, "b")], "x int, y string, z string")
    assert Q.content_hash(moved).first() != same
    twice = df.unionByName(df)
    assert Q.content_hash(twice).first()["content_hash"] == 2 * same["content_hash"]
    assert Q.content_hash(df.where("1 = 0")).first()["n_rows"] == 0


def test_idempotent_and_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    row = Q.idempotent(a, a.repartition(2), ["k"]).first()
    assert row["equal_content"] and row["duplicate_keys"] == 0
    row = Q.idempotent(a, b, ["k"]).first()
    assert not row["equal_content"] and row["duplicate_keys"] == 1 and row["rows_second"] == 3
    assert Q.reconcile(a, b).first()["alert"] and not Q.reconcile(a, a).first()["alert"]
    assert not Q.reconcile(a.where("1=0"), a.where("1=0")).first()["alert"]


def test_landing(spark, folder):
    df = records(spark, [record(1), record(2)])
    assert B.land_if_absent(df, folder, "s", DAY, "r1").endswith("source=s/snapshot_date=2024-06-01/run_id=r1")
    assert B.land_if_absent(df, folder, "s", DAY, "r2") == "SKIPPED"
    B.land_bronze(df, folder, "s", DAY, "r2")
    B.land_bronze(df.limit(1), folder, "s", DAY, "r2")
    raw = B.read_bronze(spark, folder, "s", schemas.ENRICHED)
    assert raw.count() == 3 and {r["run_id"] for r in raw.collect()} == {"r1", "r2"}
    assert dict(raw.dtypes)["snapshot_date"] == "date"
    assert B.read_bronze(spark, folder, "none", schemas.ENRICHED).count() == 0
    listed = B.list_partitions(spark, folder).collect()
    assert {(r["source"], r["snapshot_date"], r["run_id"]) for r in listed} == {("s", DAY, "r1"), ("s", DAY, "r2")}
    assert Q.bad_paths(spark, folder).count() == 0
    # A filter on the landing columns prunes folders.
    assert "PartitionFilters: [isnotnull(run_id" in plan_of(raw.where("run_id = 'r1'"))


def test_array_file_reads_as_rows(spark, folder):
    # One run may be a single JSON array on one line.
    text = '[{"osm_data":{"osm_id":1}},{"osm_data":{"osm_id":2},"unknown":1}]'
    path = B.run_path(folder, "s", DAY, "r1")
    spark.createDataFrame([(text,)], "value string").write.text(path)
    assert sorted(r[0] for r in B.read_bronze(spark, folder, "s", schemas.ENRICHED).select("osm_data.osm_id").collect()) == [1, 2]


def test_partition_overwrite_keeps_history(spark, folder):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "k int, snapshot_date date")
    T.write_silver(df, folder)
    T.write_silver(spark.createDataFrame([(9, date(2024, 1, 2))], "k int, snapshot_date date"), folder)
    assert sorted(r["k"] for r in spark.read.parquet(folder).collect()) == [1, 9]
    read = spark.read.parquet(folder).where("snapshot_date = date'2024-01-02'")
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan_of(read)


def test_processed_day_partition(spark, folder):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 5))], "k int, silver_processed_at timestamp")
    T.write_silver(df, folder, by="processed_day")
    assert spark.read.parquet(folder).first()["processed_day"] == date(2024, 1, 1)


def test_storage_stats(spark, folder):
    spark.range(100000).repartition(2).write.parquet(f"{folder}/a")
    got = T.storage_stats(spark, {"silver": f"{folder}/a", "gold": f"{folder}/none"}).collect()
    sizes = {r["layer"]: (r["object_count"], r["total_size_mb"]) for r in got}
    assert sizes["silver"][0] == 2 and sizes["silver"][1] > 0 and sizes["gold"] == (0, 0.0)


def test_run_ids_are_listed_as_they_are_read(spark, folder):
    for run in ("scheduled__2024-06-01T00:00:00+00:00", "50% off"):
        spark.createDataFrame([(1, "s", DAY, run)], "k int, source string, snapshot_date date, run_id string").write.mode(
            "append"
        ).partitionBy("source", "snapshot_date", "run_id").json(folder)
    read = {r["run_id"] for r in B.read_bronze(spark, folder, "s", "k int").collect()}
    assert {r["run_id"] for r in B.list_partitions(spark, folder).collect()} == read
    assert read == {"scheduled__2024-06-01T00:00:00+00:00", "50% off"}


def test_no_record_is_lost(spark, folder):
    """Nodes and ways that share numbers, broken lines and places nowhere: all in Silver or in quarantine."""
    paths = lake(folder)
    both = [record(i) for i in range(6)]
    both += [((i, "way", *r[0][2:]), *r[1:]) for i, r in enumerate(both[:3])]
    nowhere = ((90, "node", "lost", {}, None, None), None, "2024-06-01T00:00:00Z")
    path = B.land_bronze(records(spark, [*both, nowhere]), paths.bronze, "src", DAY, "r1")
    spark.createDataFrame([("{broken",), ('{"osm_data": [1',)], "value string").write.mode("append").text(path)
    made = run_medallion(spark, paths, T.districts_dim(spark), DAY, "src")
    reasons = {r["reason"]: r["count"] for r in made["quarantine"].groupBy("reason").count().collect()}
    assert reasons == {"malformed": 2, "no_coordinates": 1}
    assert made["attractions_enriched"].count() == len(both) == 9
    assert {r["record"] for r in made["quarantine"].where("reason = 'malformed'").collect()} == {"{broken", '{"osm_data": [1'}


def test_places_outside_the_box_are_quarantined(spark, folder):
    paths = lake(folder)
    B.land_bronze(records(spark, [record(i) for i in range(10)]), paths.bronze, "src", DAY, "r1")
    made = run_medallion(spark, paths, T.districts_dim(spark), DAY, "src", box=(21.0, 21.0035, 105.0, 106.0))
    assert made["attractions_enriched"].count() == 4
    outside = made["quarantine"].where("reason = 'outside_box'").collect()
    assert len(outside) == 6 and all('"latitude":21.00' in r["record"] and r["run_id"] == "r1" for r in outside)


def test_gold_is_refreshed_for_the_touched_dates_only(spark, folder):
    days, dim = [date(2024, 6, 1), date(2024, 6, 2)], T.districts_dim(spark)
    stamp = datetime(2024, 6, 3)

    def sync():
        I.upsert_stream(
            I.bronze_stream(spark, f"{folder}/bronze", "src", schemas.ENRICHED), f"{folder}/silver", f"{folder}/state",
            lambda b: build_silver(b, stamp, scope=["snapshot_date"]),
            refresh=lambda touched: I.refresh_gold(spark, f"{folder}/silver", f"{folder}/gold", dim, touched, stamp),
        ).awaitTermination()

    def files(day):
        every = [f for n in ("gold_partials", "gold_attractions") for f in spark.read.parquet(f"{folder}/gold/{n}").inputFiles()]
        return sorted(f for f in every if f"snapshot_date={day}" in f)

    for day in days:
        B.land_bronze(records(spark, [record(i, rating=None if i % 3 == 0 else 4.0) for i in range(30)]), f"{folder}/bronze", "src", day, "r1")
    sync()
    before = [files(d) for d in days]
    B.land_bronze(records(spark, [record(i, rating=2.0, stamp="2024-06-02T00:00:00Z") for i in range(40)]), f"{folder}/bronze", "src", days[1], "r2")
    sync()
    assert files(days[0]) == before[0] and not set(files(days[1])) & set(before[1])
    parts, gold = (T.read_table(spark, f"{folder}/gold/{n}") for n in ("gold_partials", "gold_attractions"))
    assert gold.count() == 70
    for small, full in (
        (marts.overview_of, marts.executive_overview), (marts.benchmarking_of, marts.district_benchmarking),
        (marts.accessibility_of, marts.service_accessibility),
    ):
        def shown(df):
            rows = [{k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in df.collect()]
            return sorted(map(repr, rows))

        assert shown(small(parts)) == shown(full(gold))
    both = marts.overview_of(parts, by=()).first()
    assert both["total_pois"] == 70 and abs(both["city_avg_rating"] - (20 * 4.0 + 40 * 2.0) / 60) < 1e-9


def test_upsert_reads_only_the_batchs_dates(spark, folder, monkeypatch):
    days = [date(2024, 1, d) for d in range(1, 6)]
    kind = "k int, v string, at int, snapshot_date date"
    I.upsert(spark.createDataFrame([(i, "old", 1, d) for d in days for i in range(3)], kind), folder, ["k"], ["at"], "snapshot_date")
    plans = []
    monkeypatch.setattr(I, "write_partitions", lambda df, *a: plans.append(df) or T.write_partitions(df, *a))
    kept = I.store
    monkeypatch.setattr(I, "store", lambda df, path: plans.append(plan_of(df)) or kept(df, path))
    I.upsert(spark.createDataFrame([(1, "new", 2, days[2]), (9, "new", 2, None)], kind), folder, ["k"], ["at"], "snapshot_date")
    assert "PartitionFilters: [" in plans[1] and "2024-01-03" in plans[1]
    assert "dynamicpruning" not in plans[1]
    rows = {(r["k"], r["snapshot_date"]): r["v"] for r in spark.read.parquet(folder).collect()}
    assert len(rows) == 16 and rows[1, days[2]] == "new" and rows[1, days[1]] == "old" and rows[9, None] == "new"


def lake(folder):
    return Paths(f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold")


def test_medallion_is_idempotent_and_keeps_history(spark, folder):
    paths, dim = lake(folder), T.districts_dim(spark)
    stamp = datetime(2024, 6, 1, 3)
    for day, n in ((DAY, 20), (date(2024, 6, 2), 30)):
        B.land_bronze(records(spark, [record(i) for i in range(n)]), paths.bronze, "src", day, "r1")
    first = run_medallion(spark, paths, dim, DAY, "src", stamp)
    assert first["gold_attractions"].count() == 20
    assert first["gold_executive_overview"].first()["total_pois"] == 20
    before = Q.content_hash(first["gold_attractions"]).first()
    run_medallion(spark, paths, dim, date(2024, 6, 2), "src", stamp)
    again = run_medallion(spark, paths, dim, DAY, "src", stamp)
    assert Q.content_hash(again["gold_attractions"]).first() == before
    assert T.read_table(spark, f"{paths.gold}/gold_attractions").count() == 50
    assert T.read_table(spark, f"{paths.gold}/gold_executive_overview").count() == 2


def test_rerun_without_rows_leaves_nothing_behind(spark, folder):
    paths, dim = lake(folder), T.districts_dim(spark)
    B.land_bronze(records(spark, [record(1, rating=2.0)]), paths.bronze, "src", DAY, "r1")
    assert run_medallion(spark, paths, dim, DAY, "src")["gold_quality_alerts"].count() == 1
    B.land_bronze(records(spark, [record(1, rating=5.0)]), paths.bronze, "src", DAY, "r1")
    assert run_medallion(spark, paths, dim, DAY, "src")["gold_quality_alerts"].count() == 0
    empty = run_medallion(spark, lake(folder + "-empty"), dim, DAY, "src")
    assert all(table.count() == 0 for table in empty.values())


def test_medallion_stops_at_the_gate(spark, folder):
    paths = lake(folder)
    B.land_bronze(records(spark, [record(1, rating=9.0)]), paths.bronze, "src", DAY, "r1")
    with pytest.raises(QualityError, match=r"^silver: accepted_range\(rating\): 1$"):
        run_medallion(spark, paths, T.districts_dim(spark), DAY, "src")


def test_a_failed_run_leaves_the_published_layers(spark, folder):
    paths, dim = lake(folder), T.districts_dim(spark)
    B.land_bronze(records(spark, [record(i) for i in range(5)]), paths.bronze, "src", DAY, "r1")
    made = run_medallion(spark, paths, dim, DAY, "src")
    before = sorted(made["attractions_enriched"].inputFiles())
    B.land_bronze(records(spark, [record(1, rating=9.0, stamp="2024-06-02T00:00:00Z")]), paths.bronze, "src", DAY, "r2")
    with pytest.raises(QualityError):
        run_medallion(spark, paths, dim, DAY, "src")
    left = spark.read.parquet(f"{paths.silver}/attractions_enriched")
    assert sorted(left.inputFiles()) == before and left.count() == 5


def test_rules_are_judged_while_rows_are_written(spark, folder):
    rules = [Q.not_null("k"), Q.accepted_range("v", 0.0, 5.0), Q.unique("k"), Q.not_null("none")]
    df = spark.createDataFrame([(1, 2.0), (1, 9.0), (None, None)], "k int, v double")
    stored, failed = Q.store_observed(df, f"{folder}/a", rules)
    assert stored.count() == 3
    assert failed == ["not_null(k): 1", "accepted_range(v): 1", "not_null(none): 3", "unique(k): 1"]
    assert Q.store_observed(df.where("k = 7"), f"{folder}/b", rules)[1] == []
    assert Q.store_observed(df.where("v < 5"), f"{folder}/c", rules[:3])[1] == []


def test_incremental_silver_equals_the_batch(spark, folder):
    paths = lake(folder)

    def land(day, run, ids, name, stamp):
        B.land_bronze(records(spark, [record(i, name, stamp=stamp) for i in ids]), paths.bronze, "src", day, run)

    def sync():
        stream = I.bronze_stream(spark, paths.bronze, "src", schemas.ENRICHED, files_per_trigger=3)

        def build(batch):
            return build_silver(batch, datetime(2024, 6, 1), scope=["snapshot_date"])

        I.upsert_stream(stream, paths.silver, f"{folder}/state", build).awaitTermination()

    land(DAY, "r1", range(10), "old", "2024-06-01T00:00:00Z")
    land(date(2024, 6, 2), "r1", range(5), "other day", "2024-06-02T00:00:00Z")
    sync()
    land(DAY, "r2", range(5, 15), "new", "2024-06-01T09:00:00Z")
    land(DAY, "r0", range(3), "late and stale", "2024-05-01T00:00:00Z")
    sync()
    sync()  # nothing new
    silver = spark.read.parquet(paths.silver)
    raw = B.read_bronze(spark, paths.bronze, "src", schemas.ENRICHED)
    batch = build_silver(raw, datetime(2024, 6, 1), scope=["snapshot_date"])
    assert silver.count() == 20
    assert Q.content_hash(silver.select(*batch.columns)).first() == Q.content_hash(batch).first()


def test_history_has_one_file_a_year_by_many_tasks(spark, folder):
    """As input of ``storage_stats``: no task writes all years."""
    rows = [(k, 1, 1, 1, 5.0, datetime(year, 1 + k % 12, 1)) for year in range(1992, 2000) for k in range(40)]
    shape = "l_partkey long, l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp"
    spark.createDataFrame(rows, shape).write.parquet(f"{folder}/lineitem.parquet")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    stored = spark.read.parquet(bronze._file_a_year(spark, folder))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = stored.select("snapshot_date", F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == len({r["snapshot_date"] for r in files}) == 8 and stored.count() == 8 * 40
    assert len({r["f"].split("part-")[1][:5] for r in files}) > 1
