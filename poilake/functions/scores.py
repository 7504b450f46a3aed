"""Keys, scores, labels and small conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poilake import constants as K


def business_key(osm_id: Column, name: Column, lat: Column, lon: Column, osm_type: Column | None = None) -> Column:
    """The source id, else a SHA-256 of the lowered name and 4-digit coordinates.

    With ``osm_type`` the id is prefixed by the element type, so that a node and a way of
    the same number stay apart.
    """
    own = osm_id.cast("string")
    if osm_type is not None:
        own = F.when(osm_type.isNotNull() & own.isNotNull(), F.concat_ws("/", osm_type, own)).otherwise(own)
    return F.coalesce(own, F.sha2(F.concat_ws("_", F.lower(name), F.round(lat, 4), F.round(lon, 4)), 256))


def attraction_key(name: Column, lat: Column, lon: Column) -> Column:
    """MD5 of name, latitude and longitude without separator; null if any is null."""
    return F.md5(F.concat(name, lat.cast("string"), lon.cast("string")))


def popularity(rating: Column, count: Column) -> Column:
    """Rating weighted by the order of magnitude of its count."""
    return rating * F.log10(count + 1)


def reliability(count: Column, high: int = 3, medium: int = 2) -> Column:
    """Tier by number of ratings; an unknown number is Low."""
    return F.when(count >= high, "High").when(count >= medium, "Medium").otherwise("Low")


def health(rating: Column, critical: float = 3.0, warning: float = 4.0) -> Column:
    """Alert level; an unknown rating is HEALTHY."""
    return F.when(rating < critical, "CRITICAL").when(rating < warning, "WARNING").otherwise("HEALTHY")


def sentiment(rating: Column, labels: tuple[str, str, str] = K.SENTIMENT_LABELS) -> Column:
    """Three sentiment labels."""
    return F.when(rating >= 4.5, labels[0]).when(rating >= 4.0, labels[1]).otherwise(labels[2])


def color_band(rating: Column) -> Column:
    """Marker colour."""
    return F.when(rating >= 4.5, "green").when(rating >= 4.0, "orange").otherwise("red")


def source_type(rating: Column, osm_id: Column) -> Column:
    """Which sources a row came from, by what is present."""
    return (
        F.when(rating.isNotNull() & osm_id.isNotNull(), K.SOURCE_BOTH)
        .when(rating.isNotNull(), K.SOURCE_RATED_ONLY)
        .otherwise(K.SOURCE_UNRATED)
    )


def overcrowded(density: Column, limit: float = 0.8) -> Column:
    """Density above the limit."""
    return density > limit


def round_to(value: Column, digits: int) -> Column:
    """Half-up rounding (I15); six digits for coordinates."""
    return F.round(value, digits)


def round_mean(mean: Column, digits: int) -> Column:
    """Half-up rounding of a computed mean.

    Rounding to six digits first removes the noise of the summation order, so that a mean
    halfway between two results rounds up however the rows were partitioned.
    """
    return F.round(F.round(mean, 6), digits)


def percent(part: Column, total: Column) -> Column:
    """Share of the total in percent; null for an empty total."""
    return F.try_divide(part * F.lit(100.0), total.cast("double"))


def day_of_year(day: Column) -> Column:
    """Day number within the year (I16)."""
    return F.dayofyear(day)


def utc_stamp(ts: Column) -> Column:
    """ISO stamp in UTC with a Z (I16)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_stamp(text: Column) -> Column:
    """ISO stamp to timestamp; null when it does not parse (I16)."""
    return F.try_to_timestamp(text)


def first_category(labels: Column) -> Column:
    """First label, null for an empty list."""
    return F.get(labels, 0)


def labels_union(a: Column, b: Column, keep_null: bool = False) -> Column:
    """Distinct labels of both lists in order, ``a`` first."""
    empty = F.array().cast("array<string>")
    union = F.array_union(F.coalesce(a, empty), F.coalesce(b, empty))
    return union if keep_null else F.array_compact(union)
