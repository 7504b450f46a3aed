"""Quality rules and checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from poilake import constants as K
from poilake.operators.dedup import duplicate_keys
from poilake.sources.files import list_files


@dataclass(frozen=True)
class Rule:
    """One rule: ``violation`` builds a column that is true for a failing row; ``keys`` marks uniqueness."""

    name: str
    columns: tuple[str, ...]
    violation: Callable[[], Column] | None = None
    keys: bool = False


def not_null(column: str) -> Rule:
    """The column has a value."""
    return Rule("not_null", (column,), lambda: F.col(column).isNull())


def unique(*columns: str) -> Rule:
    """No two rows share the columns, e.g. key or key and snapshot date."""
    return Rule("unique", columns, keys=True)


def accepted_values(column: str, values: Sequence) -> Rule:
    """The column is null or one of the values."""
    return Rule("accepted_values", (column,), lambda: ~F.col(column).isin(*values))


def accepted_range(column: str, low: float | None = None, high: float | None = None) -> Rule:
    """The column is null or within the range, edges included."""

    def outside() -> Column:
        below = F.col(column) < low if low is not None else F.lit(False)
        above = F.col(column) > high if high is not None else F.lit(False)
        return below | above

    return Rule("accepted_range", (column,), outside)


def gold_rules(id_column: str = "osm_id") -> list[Rule]:
    """The mart suite: id and name present, coordinates and rating in range."""
    return [
        not_null(id_column),
        not_null("name"),
        accepted_range("latitude", 20.0, 22.0),
        accepted_range("longitude", 105.0, 107.0),
        accepted_range("rating", 0.0, 5.0),
    ]


_RESULT = "rule string, column string, failed bigint, total bigint, success boolean"


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rule, column, failed, total, success.

    All row rules share one scan and one aggregate. Uniqueness counts the surplus rows of
    its keys, after combining equal keys before the shuffle. A missing column fails its
    rule; an empty table passes every other.
    """
    have = set(df.columns)
    parts = []
    rows = [r for r in rules if not r.keys and set(r.columns) <= have]
    if rows:
        counts = df.agg(
            F.count("*").alias("total"),
            *[F.count_if(r.violation()).alias(f"failed_{i}") for i, r in enumerate(rows)],
        )
        results = [
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.columns[0]).alias("column"),
                F.col(f"failed_{i}").alias("failed"),
                F.col("total").alias("total"),
                (F.col(f"failed_{i}") == 0).alias("success"),
            )
            for i, r in enumerate(rows)
        ]
        parts.append(counts.select(F.inline(F.array(*results))))
    for r in rules:
        if r.keys and set(r.columns) <= have:
            groups = df.groupBy(*r.columns).agg(F.count("*").alias("n"))
            failed = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
            parts.append(
                groups.agg(failed.alias("failed"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).select(
                    F.lit(r.name).alias("rule"),
                    F.lit(",".join(r.columns)).alias("column"),
                    "failed",
                    "total",
                    (F.col("failed") == 0).alias("success"),
                )
            )
    missing = [r for r in rules if not set(r.columns) <= have]
    if missing:
        total = df.agg(F.count("*").alias("total"))
        results = [
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(",".join(r.columns)).alias("column"),
                F.col("total").alias("failed"),
                F.col("total").alias("total"),
                F.lit(False).alias("success"),
            )
            for r in missing
        ]
        parts.append(total.select(F.inline(F.array(*results))))
    if not parts:
        return df.sparkSession.createDataFrame([], _RESULT)
    suite = parts[0]
    for part in parts[1:]:
        suite = suite.unionByName(part)
    return suite


def suite_passes(results: DataFrame) -> bool:
    """Whether no rule failed; an empty table passes."""
    return results.where(~F.col("success") & (F.col("total") > 0)).isEmpty()


def store_observed(df: DataFrame, path: str, rules: Sequence[Rule]) -> tuple[DataFrame, list[str]]:
    """Write ``df`` to a new ``path`` and judge it on the way: the stored rows, and the failures.

    Row rules are counted by the tasks that write, so the stored table is not scanned for them.
    Uniqueness reads the stored key columns alone, unless there are no rows. A missing column
    fails its rule if there are rows.
    """
    spark, have = df.sparkSession, set(df.columns)
    rows = [r for r in rules if not r.keys and set(r.columns) <= have]
    seen = Observation()
    counts = [F.count_if(r.violation()).alias(f"failed_{i}") for i, r in enumerate(rows)]
    df.observe(seen, F.count("*").alias("total"), *counts).write.parquet(path)
    stored, got = spark.read.schema(df.schema).parquet(path), seen.get
    if not got["total"]:
        return stored, []
    failed = [(r, got[f"failed_{i}"]) for i, r in enumerate(rows)]
    failed += [(r, got["total"]) for r in rules if not set(r.columns) <= have]
    keys = [r for r in rules if r.keys and set(r.columns) <= have]
    failed += [(r, run_suite(stored.select(*r.columns), [r]).first()["failed"]) for r in keys]
    return stored, [f"{r.name}({','.join(r.columns)}): {n}" for r, n in failed if n]


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every row rule, and the others with their reasons."""
    reasons = F.array_compact(
        F.array(
            *[
                F.when(F.coalesce(r.violation(), F.lit(False)), F.lit(f"{r.name}:{r.columns[0]}"))
                for r in rules
                if not r.keys
            ]
        )
    )
    marked = df.withColumn("reasons", reasons)
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def bad_paths(spark: SparkSession, root: str, pattern: str = K.LANDING_PATTERN) -> DataFrame:
    """Landed objects whose path does not match the pattern."""
    return list_files(spark, root, "*.json").where(~F.col("path").rlike(pattern))


def content_hash(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Row count and an order-insensitive content hash of the columns in name order."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns) if c not in ignore]
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    parts = [F.to_json(c) if types[n] == "map" else c for c, n in zip(columns, sorted(set(df.columns) - set(ignore)))]
    # xxhash64 passes over nulls, so a null must not let neighbours trade places.
    hashed = F.xxhash64(*[p for c, p in zip(columns, parts) for p in (p, c.isNull())])
    # Summing as decimal cannot overflow, and equal rows do not cancel each other out.
    return df.select(hashed.alias("h")).agg(
        F.count("*").alias("n_rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias("content_hash")
    )


def idempotent(first: DataFrame, second: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Two runs on the same input: duplicate keys of the second, and whether contents are equal."""
    duplicates = duplicate_keys(second, keys).agg(F.count("*").alias("duplicate_keys"))
    hashes = [
        content_hash(run, ignore).select(F.lit(i).alias("run"), F.col("content_hash").cast("string").alias("hash"), "n_rows")
        for i, run in enumerate((first, second))
    ]
    both = hashes[0].unionByName(hashes[1]).agg(
        (F.count_distinct(F.coalesce("hash", F.lit(""))) == 1).alias("equal_content"),
        F.max(F.when(F.col("run") == 0, F.col("n_rows"))).alias("rows_first"),
        F.max(F.when(F.col("run") == 1, F.col("n_rows"))).alias("rows_second"),
    )
    return both.withColumn("duplicate_keys", duplicates.scalar())


def reconcile(a: DataFrame, b: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """Row counts of two layers and an alert when they differ by more than the tolerance."""
    sides = a.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        b.select(F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("rows_b")
    )
    gap = F.abs(F.col("rows_a") - F.col("rows_b")).cast("double")
    share = F.try_divide(gap, F.greatest(F.col("rows_a"), F.lit(1)).cast("double"))
    return counts.select("rows_a", "rows_b", F.round(share, 6).alias("difference"), (share > tolerance).alias("alert"))


def missing_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``a`` that ``b`` lacks."""
    return a.select(*keys).distinct().join(b.select(*keys), list(keys), "left_anti")
