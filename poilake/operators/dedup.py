"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column]


def _first_rows(df: DataFrame, keys: Sequence[str], order: Order, n: int = 1) -> DataFrame:
    # Spark limits each key to n rows before the shuffle (WindowGroupLimit), so a key
    # that holds a large share of the rows sends only n rows per task.
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def row_hash(df: DataFrame) -> Column:
    """A stable last tie-break: equal only for (nearly surely) equal rows."""
    parts = [
        F.to_json(F.col(f"`{f.name}`")) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return F.xxhash64(*parts)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The first row of each key in ``order``, ties broken by row content."""
    return _first_rows(df, keys, [*order, row_hash(df).asc()])


def latest_n_per_key(df: DataFrame, keys: Sequence[str], order: Order, n: int) -> DataFrame:
    """The first ``n`` rows of each key in ``order``."""
    return _first_rows(df, keys, [*order, row_hash(df).asc()], n)


def first_per_key(df: DataFrame, key: Column, order: Order) -> DataFrame:
    """Concatenated query results, the earliest row per key kept.

    ``key`` is typically the place id, else the title.
    """
    return latest_per_key(df.withColumn("_key", key), ["_key"], order).drop("_key")


def union_sources(*sources: DataFrame) -> DataFrame:
    """Union by name; a column a source lacks is null."""
    union = sources[0]
    for source in sources[1:]:
        union = union.unionByName(source, allowMissingColumns=True)
    return union


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
