"""Column profiles as stored partial aggregates that merge over any range of partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.functions.scores import percent

#: Size of the sketches: 2^12 registers (distinct values within about 3 %), quantile ranks within about 1 %.
LG_DISTINCT, K_QUANTILE = 12, 400
_NUMERIC = {"byte", "short", "integer", "long", "float", "double"}


def partial_profiles(df: DataFrame, by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per value of ``by`` and column: counts, extremes, sum and sketches.

    One pass; what is shuffled is a few kilobytes per task, partition and column, however
    many distinct values there are. Store it with ``write_partitions(..., by)``: a changed
    partition replaces its own rows. Numbers that are NaN count as present only.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    columns = [c for c in (columns or df.columns) if c != by]
    aggregates: list[Column] = [F.count("*").alias("_rows")]
    rows = []
    for i, c in enumerate(columns):
        column = F.col(f"`{c}`")
        number = column.cast("double") if types[c] in _NUMERIC else F.lit(None).cast("double")
        number = F.nanvl(number, F.lit(None).cast("double"))
        shown = F.to_json(column) if types[c] in ("struct", "array", "map", "variant") else column.cast("string")
        parts = {
            "present": F.count(column),
            "numbers": F.count(number),
            "low": F.min(number),
            "high": F.max(number),
            "total": F.sum(number),
            "distinct": F.hll_sketch_agg(shown, F.lit(LG_DISTINCT)),
            "quantiles": F.kll_sketch_agg_double(number, F.lit(K_QUANTILE)),
        }
        aggregates += [part.alias(f"_{name}{i}") for name, part in parts.items()]
        rows.append(
            F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"), *[F.col(f"_{n}{i}").alias(n) for n in parts])
        )
    return df.groupBy(by).agg(*aggregates).select(by, F.inline(F.array(*rows)))


def merged_profiles(partials: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile over all partitions in ``partials``, which the caller may filter; the base is not read.

    Per column: rows, present, null_pct, min, max and mean of its numbers, distinct_values
    and one column per quantile (``q25``), both estimates. Columns without numbers have nulls there.
    """
    merged = partials.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.sum("numbers").alias("numbers"),
        F.min("low").alias("min_value"),
        F.max("high").alias("max_value"),
        F.sum("total").alias("total"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"),
        F.kll_merge_agg_double(F.when(F.col("numbers") > 0, F.col("quantiles"))).alias("quantiles"),
    )
    return merged.select(
        "column",
        "rows",
        "present",
        F.round(percent(F.col("rows") - F.col("present"), F.col("rows")), 6).alias("null_pct"),
        "distinct_values",
        F.round("min_value", 4).alias("min_value"),
        F.round("max_value", 4).alias("max_value"),
        F.round(F.try_divide(F.col("total"), F.col("numbers")), 4).alias("mean_value"),
        *[
            F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q)))).alias(f"q{q * 100:g}")
            for q in quantiles
        ],
    )
