"""Session defaults and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str = "poilake", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="poilake-"))
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode.

    ``build_session`` sets it; the temporary folder is for local sessions that are made without.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="poilake-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; never reused, so reruns cannot see old files."""
    return f"{scratch_root(spark)}/poilake/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back, which cuts its lineage.

    In the shared folder the copy survives the loss of executors, and its file sizes give
    the optimizer a true size to choose join strategies by.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``store`` below the scratch root."""
    return store(df, scratch_path(df.sparkSession, label))
