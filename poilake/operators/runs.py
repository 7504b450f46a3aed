"""Queries on the pipeline's run log: dag_id, run_id, task_id, state, execution_date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.operators.dedup import latest_n_per_key

def _newest() -> list[Column]:
    return [F.desc_nulls_last("execution_date"), F.desc_nulls_last("run_id")]


def latest_runs(runs: DataFrame, n: int) -> DataFrame:
    """The latest ``n`` runs of each pipeline."""
    return latest_n_per_key(runs, ["dag_id"], _newest(), n)


def run_state_summary(runs: DataFrame, n: int = 50) -> DataFrame:
    """Counts by state over the latest ``n`` runs of each pipeline."""
    return latest_runs(runs, n).agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("state") == s).alias(s) for s in ("success", "failed", "running")],
    )


def run_counts(runs: DataFrame) -> DataFrame:
    """Counts by (pipeline, state) and by (pipeline, task, state) in one pass.

    The first level has a null task and ``level`` = run.
    """
    by_task = runs.groupBy("dag_id", "task_id", "state").agg(F.count("*").alias("n"))
    levels = F.array(
        F.struct(F.lit("task").alias("level"), F.col("task_id").alias("task")),
        F.struct(F.lit("run").alias("level"), F.lit(None).cast("string").alias("task")),
    )
    return (
        by_task.select("dag_id", "state", "n", F.inline(levels))
        .groupBy("level", "dag_id", F.col("task").alias("task_id"), "state")
        .agg(F.sum("n").alias("n"))
    )


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` runs of all pipelines.

    No more than ``n`` of one pipeline can be among them; the sort keeps ``n`` per task.
    """
    return runs.orderBy(*_newest()).limit(n)


def failed_since(runs: DataFrame, now: datetime, hours: int = 24) -> DataFrame:
    """Failed runs of the last ``hours`` before ``now``, a wall-clock time of the session's zone."""
    moment = F.lit(now.isoformat(" ")).cast(runs.schema["execution_date"].dataType)
    since = moment - F.expr(f"INTERVAL {int(hours)} HOURS")
    return runs.where((F.col("state") == "failed") & F.col("execution_date").between(since, moment))
