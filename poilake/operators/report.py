"""Reports and notebook statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poilake.functions.scores import percent, sentiment, source_type
from poilake.operators.dedup import latest_per_key


def _long_form(one_row: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*rows)))


def source_mix(df: DataFrame, rating: str = "rating", osm_id: str = "osm_id") -> DataFrame:
    """Rows per source pattern."""
    return df.groupBy(source_type(F.col(rating), F.col(osm_id)).alias("data_source_type")).agg(
        F.count("*").alias("n")
    )


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null count and percent per column, in one pass."""
    counts = df.agg(F.count("*").alias("_total"), *[F.count(c).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(
            F.lit(c).alias("field"),
            F.col(f"_{i}").alias("present"),
            F.round(percent(F.col(f"_{i}"), F.col("_total")), 6).alias("percentage"),
        )
        for i, c in enumerate(columns)
    ]
    return _long_form(counts, rows)


def sentiment_counts(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Rated rows per sentiment label."""
    rated = df.where(F.col(rating).isNotNull())
    return rated.groupBy(sentiment(F.col(rating)).alias("sentiment_label")).agg(F.count("*").alias("n"))


def per_source_counts(df: DataFrame) -> DataFrame:
    """Rows per source."""
    return df.groupBy("source").agg(F.count("*").alias("n"))


def rating_box(df: DataFrame, group: str, rating: str = "avg_rating", accuracy: int | None = None) -> DataFrame:
    """Minimum, quartiles and maximum per group over positive ratings.

    Exact by default: equal ratings of a group are counted first, so a group costs one row
    per distinct rating (a score from 0 to 5 with few decimals). For a continuous measure
    give ``accuracy`` to use a fixed-size sketch instead.
    """
    rated = df.where(F.col(rating) > 0)
    quarters = [0.25, 0.5, 0.75]
    if accuracy:
        boxes = rated.groupBy(group).agg(
            F.min(rating).alias("low"),
            F.percentile_approx(rating, quarters, accuracy).alias("q"),
            F.max(rating).alias("high"),
            F.count("*").alias("n"),
        )
    else:
        counted = rated.groupBy(group, rating).agg(F.count("*").alias("_n"))
        boxes = counted.groupBy(group).agg(
            F.min(rating).alias("low"),
            F.percentile(rating, quarters, F.col("_n")).alias("q"),
            F.max(rating).alias("high"),
            F.sum("_n").alias("n"),
        )
    points = [F.col("q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))]
    return boxes.select(group, "low", *points, "high", "n")


def rating_corr(df: DataFrame, rating: str = "rating", reviews: str = "review_count") -> DataFrame:
    """Correlation of rating and review count over positive ratings."""
    return df.where(F.col(rating) > 0).agg(
        F.corr(rating, reviews).alias("correlation"), F.count("*").alias("n")
    )


def rating_bins(
    df: DataFrame, rating_step: float = 0.5, review_step: int = 10, rating: str = "rating", reviews: str = "review_count"
) -> DataFrame:
    """Rows per (rating, review count) bin over positive ratings: the scatter plot's data."""
    return (
        df.where(F.col(rating) > 0)
        .groupBy(
            F.floor(F.col(rating) / rating_step).alias("rating_bin"),
            F.floor(F.col(reviews) / review_step).alias("review_bin"),
        )
        .agg(F.count("*").alias("n"))
    )


def rating_by_category(df: DataFrame, threshold: float = 4.0, category: str = "category", rating: str = "avg_rating") -> DataFrame:
    """Mean rating and share of high ratings per category; unrated rows do not count as high."""
    high = F.when(F.col(rating) >= threshold, 1.0).otherwise(0.0)
    return df.groupBy(category).agg(
        F.avg(rating).alias("avg_rating"),
        (F.avg(high) * 100).alias("high_rating_pct"),
        F.count("*").alias("n"),
    )


def accessibility_pct(df: DataFrame, website: Column, weekend_open: Column, by: Sequence[str] = ()) -> DataFrame:
    """Percent with a website and percent open at the weekend.

    ``weekend_open`` is a boolean column, e.g. ``opens_at_weekend``.
    """
    aggregates = [
        (F.avg(F.when(website.isNotNull(), 1.0).otherwise(0.0)) * 100).alias("website_pct"),
        (F.avg(F.when(weekend_open, 1.0).otherwise(0.0)) * 100).alias("weekend_pct"),
        F.count("*").alias("n"),
    ]
    return df.groupBy(*by).agg(*aggregates)


def opens_at_weekend(periods: Column) -> Column:
    """Whether any opening period starts on Saturday (6) or Sunday (0); null periods are not."""
    return F.coalesce(F.exists(periods, lambda p: p["open"]["day"].isin(0, 6)), F.lit(False))


def tier_counts(df: DataFrame, tier: str = "reliability_level") -> DataFrame:
    """Rows per reliability tier."""
    return df.groupBy(tier).agg(F.count("*").alias("n"))


_NUMERIC = {"byte", "short", "integer", "long", "float", "double"}


def profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Per column: rows, non-null, null percent, distinct, and min, max and mean of numbers.

    The exact distinct counts share one pass, in which the values of each column keep their
    type and are combined before the shuffle; ``approximate`` replaces it by sketches.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    columns = list(columns or df.columns)
    aggregates = [F.count("*").alias("_total")]
    for i, c in enumerate(columns):
        aggregates.append(F.count(c).alias(f"_n{i}"))
        if types[c] in _NUMERIC:
            aggregates += [
                F.min(c).cast("double").alias(f"_lo{i}"),
                F.max(c).cast("double").alias(f"_hi{i}"),
                F.avg(c).alias(f"_avg{i}"),
            ]
        distinct = F.approx_count_distinct if approximate else F.count_distinct
        aggregates.append(distinct(c).alias(f"_d{i}"))

    def number(name: str, i: int, c: str) -> Column:
        known = F.col(f"_{name}{i}") if types[c] in _NUMERIC else F.lit(None).cast("double")
        return F.round(known, 4)

    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("_total").alias("rows"),
            F.col(f"_n{i}").alias("present"),
            F.round(percent(F.col("_total") - F.col(f"_n{i}"), F.col("_total")), 6).alias("null_pct"),
            F.col(f"_d{i}").alias("distinct_values"),
            number("lo", i, c).alias("min_value"),
            number("hi", i, c).alias("max_value"),
            number("avg", i, c).alias("mean_value"),
        )
        for i, c in enumerate(columns)
    ]
    return _long_form(df.agg(*aggregates), rows)


def _per_snapshot(df: DataFrame, key: Sequence[str], day: str) -> DataFrame:
    # One row per key and day bounds a key's history by the number of days.
    return latest_per_key(df, [*key, day], [F.desc_nulls_last("review_count")] if "review_count" in df.columns else [])


def rating_delta(df: DataFrame, key: Sequence[str], rating: str = "rating", day: str = "snapshot_date") -> DataFrame:
    """Change of the rating since the key's previous snapshot."""
    history = Window.partitionBy(*key).orderBy(day)
    previous = F.lag(rating).over(history)
    return (
        _per_snapshot(df, key, day)
        .withColumn("previous_rating", previous)
        .withColumn("rating_delta", F.round(F.col(rating) - F.col("previous_rating"), 6))
        .select(*key, day, rating, "previous_rating", "rating_delta")
    )


def district_rank(stats: DataFrame, by: str, day: str = "snapshot_date") -> DataFrame:
    """Rank and dense rank of each district within its snapshot; one row per district."""
    window = Window.partitionBy(day).orderBy(F.desc_nulls_last(by))
    return stats.withColumns({"rank": F.rank().over(window), "dense_rank": F.dense_rank().over(window)})


def rating_drop(
    df: DataFrame, key: Sequence[str], drop: float, before: int = 3, rating: str = "rating", day: str = "snapshot_date"
) -> DataFrame:
    """Snapshots whose rating is at least ``drop`` below the mean of the ``before`` preceding ones."""
    history = Window.partitionBy(*key).orderBy(day).rowsBetween(-before, -1)
    return (
        _per_snapshot(df, key, day)
        .withColumn("baseline", F.round(F.avg(rating).over(history), 6))
        .withColumn("drop", F.round(F.col("baseline") - F.col(rating), 6))
        .where(F.col("drop") >= drop)
        .select(*key, day, rating, "baseline", "drop")
    )
