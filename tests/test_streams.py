from pathlib import Path

import pytest

from checks import bronze, streams
from checks.core import QUERIES
from poilake.session import scratch_path


@pytest.mark.parametrize("module, name, top", [(streams, "stream_dedup", "in"), (bronze, "bad_paths", "")])
def test_no_single_task_writes_the_input(spark, monkeypatch, module, name, top):
    roots = []
    monkeypatch.setattr(module, "scratch_path", lambda s, label: roots.append(scratch_path(s, label)) or roots[-1])
    poi = bronze.V.poi
    monkeypatch.setattr(bronze.V, "poi", lambda s, sf: poi(s, sf).repartition(4))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    folder = Path(roots[0].removeprefix("file:")) / top
    files = [f for f in folder.rglob("part-*") if name == "stream_dedup" or "20240601" in str(f)]
    assert len(files) > 2
