import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from poilake.llm import warc


def b32(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


@pytest.fixture(scope="module")
def archive(spark):
    from poilake.session import scratch_path

    rows = [(i, f"http://h/{i}", "same body") for i in (7, 5, 9)]
    rows += [(20, None, None), (21, "http://h/\r\nX: y", ""), (30, "http://h/ü", "é\r\n\r\nWARC/1.1\r\n" * 3), (31, "http://h/31", "x" * 300_000)]
    rows += [(40, "http://h/40", "twice"), (40, "http://h/40", "twice"), (None, "http://h/n", "no id")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit("i")).withColumn("digest", F.lit("d"))
    path = scratch_path(spark, "warc-test")
    warc.write_warc(pages.repartition(3), path)
    return path, rows


def test_round_trip(spark, archive):
    path, rows = archive
    got = {}
    for r in warc.read_warc(spark, path, verify="true").collect():
        got.setdefault(r.record_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, url, html in rows:
        r = got[f"<urn:x-page:{'' if i is None else i}>"][0]
        body = (html or "").encode()
        assert r.payload_digest == "sha1:" + b32(body) and r.http_length == len(body)
        assert r.target_uri == (None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"))
        if i in (7, 9, 21):
            assert r.record_type == "revisit" and r.payload is None
            assert r.refers_to == f"<urn:x-page:{5 if i != 21 else 20}>"
        else:
            assert r.record_type == "response" and bytes(r.payload) == body and r.refers_to is None
    assert [r.record_type for r in got["<urn:x-page:40>"]] == ["response", "response"]


def test_small_payloads_are_not_revisited(spark):
    from poilake.session import scratch_path

    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_warc(pages, path, min_bytes=3)
    types = {r.record_id[-2]: r.record_type for r in warc.read_warc(spark, path).collect()}
    assert types == {"1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_predicates_skip_payloads(spark, archive, tmp_path):
    path, _ = archive
    some = warc.read_warc(spark, path).where("record_type = 'revisit' and target_uri like 'http://h/%' and content_length > 10")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "record_type" not in plan.split("Filter", 1)[-1].split("BatchScan")[0].split("\n")[0]
    assert {r.record_id for r in some.collect()} == {"<urn:x-page:7>", "<urn:x-page:9>", "<urn:x-page:21>"}
    heads = warc.read_warc(spark, path, payload=False)
    assert heads.where("payload is not null").count() == 0 and heads.count() == 10
    # Every test that the reader takes, against the same test by Spark.
    every = warc.read_warc(spark, path).drop("headers").toPandas()
    for test in ("refers_to is null", "refers_to is not null", "record_type in ('response', 'x')", "target_uri like '%/5'", "target_uri like '%h%'", "record_type <=> 'revisit'", "not (record_type = 'revisit')", "date > '2030'"):
        n = warc.read_warc(spark, path).where(test).count()
        assert n == spark.createDataFrame(every, warc.read_warc(spark, path).drop("headers").schema).where(test).count(), test


def test_reader_skips_without_reading(archive):
    import glob

    path, _ = archive
    reader = warc.WarcReader({"path": path.removeprefix("file:")}, ["record_id", "payload"])
    reader.tests = [("record_type", "=", "nothing")]
    assert not any(list(reader.read(p)) for p in reader.partitions())
    small = warc.WarcReader({"path": path.removeprefix("file:"), "partitionBytes": "1"}, ["record_id"])
    assert len(small.partitions()) == len([f for f in glob.glob(path.removeprefix("file:") + "/part-*")])


def test_gz_and_broken_archives(spark, archive, tmp_path):
    import glob

    path, rows = archive
    whole = b"".join(open(f, "rb").read() for f in sorted(glob.glob(path.removeprefix("file:") + "/part-*")))
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(whole[:0]) + gzip.compress(whole))
    assert warc.read_warc(spark, str(tmp_path / "a.warc.gz")).count() == len(rows)
    (tmp_path / "b.warc").write_bytes(b"nonsense\r\n")
    with pytest.raises(Exception, match="no record at 0"):
        warc.read_warc(spark, str(tmp_path / "b.warc")).count()
    with pytest.raises(Exception, match="FileNotFound|none"):
        warc.read_warc(spark, str(tmp_path / "none")).count()


def test_empty_table(spark):
    from poilake.session import scratch_path

    path = scratch_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_warc(spark, path).count() == 0
