"""The queries behind the API and the dashboards."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poilake.functions.scores import round_mean


def search_attractions(
    fact: DataFrame,
    district: str | None = None,
    category: str | None = None,
    min_rating: float | None = None,
    min_reviews: int = 10,
    limit: int = 10,
    tie: Sequence[str] = ("place_id",),
) -> DataFrame:
    """Best rated attractions with more than ``min_reviews`` ratings."""
    if not 1 <= limit <= 50:
        raise ValueError("limit must be between 1 and 50")
    found = fact.where(F.col("rating").isNotNull() & (F.col("total_ratings") > min_reviews))
    if district is not None:
        found = found.where(F.col("district") == district)
    if category is not None:
        found = found.where(F.col("category") == category)
    if min_rating is not None:
        found = found.where(F.col("rating") >= min_rating)
    best = [F.desc_nulls_last("rating"), F.desc_nulls_last("total_ratings"), *[F.asc_nulls_last(t) for t in tie]]
    shown = [
        c
        for c in (
            "place_id", "name", "district", "category", "rating", "total_ratings",
            "avg_sentiment_score", "is_overcrowded", "latitude", "longitude",
        )
        if c in fact.columns
    ]
    return found.orderBy(*best).limit(limit).select(*shown).withColumn("rating", F.round("rating", 2))


_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)
_WRITES = re.compile(r"\binsert\s+(into|overwrite)\b", re.I)


def adhoc_sql(spark: SparkSession, sql: str, limit: int = 1000) -> DataFrame:
    """A read-only statement with a row cap; anything but SELECT or WITH ... SELECT is refused."""
    bare = _QUOTED.sub(" ", sql).strip()
    if not re.match(r"(select|with)\b", bare, re.I) or _WRITES.search(bare) or ";" in bare.rstrip("; \n"):
        raise ValueError("only a single SELECT statement is allowed")
    return spark.sql(sql.strip().rstrip(";")).limit(limit)


def search_text(
    df: DataFrame, query: str, k: int, text: str = "text", score: Sequence[Column] = (), tie: Sequence[str] = ()
) -> DataFrame:
    """Rows that contain most distinct words of the query, best ``k``.

    Adds ``matches``. One pass over the whole text finds the words inside its task: nothing is
    exploded or shuffled, and only ``k`` rows per task reach the final sort.
    """
    words = sorted({w for w in re.split(r"\W+", query.lower()) if w})
    if not words:
        return df.withColumn("matches", F.lit(0)).where(F.lit(False))
    letter = r"[\p{L}\p{N}_]"
    whole_word = f"(?<!{letter})({'|'.join(words)})(?!{letter})"
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(whole_word), F.lit(1))
    matches = F.coalesce(F.size(F.array_distinct(found)), F.lit(0))
    hits = df.withColumn("matches", matches).where(F.col("matches") > 0)
    return hits.orderBy(F.desc("matches"), *score, *[F.asc_nulls_last(t) for t in tie]).limit(k)


def dashboard_summary(fact: DataFrame) -> DataFrame:
    """Header cards over the rated attractions."""
    return fact.where(F.col("rating").isNotNull()).agg(
        F.count("*").alias("total_attractions"),
        round_mean(F.avg("rating"), 2).alias("avg_rating"),
        F.sum("total_ratings").alias("total_reviews"),
        F.count_if("is_overcrowded").alias("overcrowded_count"),
    )


def district_summary(fact: DataFrame) -> DataFrame:
    """Rated attractions per district, largest first."""
    return (
        fact.where(F.col("district").isNotNull() & F.col("rating").isNotNull())
        .groupBy("district")
        .agg(
            F.count("*").alias("attraction_count"),
            round_mean(F.avg("rating"), 2).alias("avg_rating"),
            F.sum("total_ratings").alias("total_reviews"),
        )
        .orderBy(F.desc("attraction_count"), "district")
    )


def lakehouse_stats(
    dim: DataFrame, rating: str = "rating", reviews: str = "total_ratings", density: str = "visitor_density_score"
) -> DataFrame:
    """Totals of the attraction dimension; rating and reviews are computed."""
    return dim.agg(
        F.count("*").alias("total_attractions"),
        F.count_distinct("district").alias("total_districts"),
        round_mean(F.avg(rating), 2).alias("avg_rating"),
        F.sum(reviews).alias("total_reviews"),
        F.count_if(F.col(density) > 0.8).alias("overcrowded_count"),
    )


def join_weather(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Facts with their weather snapshot; ``weather`` has one row per snapshot."""
    return fact.join(weather, fact["weather_snapshot_id"] == weather["snapshot_id"], "inner")


def weather_summary(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Rating and temperature per weather condition, best rated first.

    Facts are summed per snapshot before the join, so a snapshot that most facts share
    costs one row per task in the shuffle.
    """
    per_snapshot = fact.groupBy("weather_snapshot_id").agg(
        F.sum("rating").alias("_rating"), F.count("rating").alias("_rated"), F.count("*").alias("_n")
    )
    joined = join_weather(per_snapshot, weather)
    known = F.col("temperature_celsius").isNotNull()
    return (
        joined.groupBy("weather_condition")
        .agg(
            round_mean(F.try_divide(F.sum("_rating"), F.sum("_rated")), 2).alias("avg_rating"),
            F.sum("_n").alias("sample_count"),
            round_mean(
                F.try_divide(F.sum(F.col("temperature_celsius") * F.col("_n")), F.sum(F.when(known, F.col("_n")))), 1
            ).alias("avg_temp"),
        )
        .orderBy(F.desc_nulls_last("avg_rating"), "weather_condition")
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of an order that ends in a unique column."""
    return df.orderBy(*order).limit(k)


def ordered(df: DataFrame, *order: Column) -> DataFrame:
    """Sorted output; give each column its null order."""
    return df.orderBy(*order)


def hidden_gems(
    df: DataFrame, min_rating: float = 4.5, max_reviews: int = 50, k: int = 10,
    rating: str = "rating", reviews: str = "total_ratings", tie: str = "place_id",
) -> DataFrame:
    """High rating, few reviews."""
    gems = df.where((F.col(rating) >= min_rating) & (F.col(reviews) <= max_reviews))
    return gems.orderBy(F.desc_nulls_last(rating), F.asc_nulls_last(reviews), F.asc_nulls_last(tie)).limit(k)
