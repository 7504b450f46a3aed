"""Nested source documents to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake import constants as K
from poilake import schemas
from poilake.functions.text import blank_to_null


def tag(name: str, tags: str = "tags") -> Column:
    """A tag's value, null when absent or empty."""
    return blank_to_null(F.try_element_at(F.col(tags), F.lit(name)))


def nonzero(coordinate: Column) -> Column:
    """Null for 0.0: the sources write an unknown coordinate as zero or leave it out."""
    return F.when(coordinate != 0, coordinate)


def fallback_coords(elements: DataFrame) -> DataFrame:
    """Own coordinates, else those of the centre, as ways have no own ones."""
    return elements.withColumns(
        {
            "lat": F.coalesce(nonzero(F.col("lat")), F.col("center.lat")),
            "lon": F.coalesce(nonzero(F.col("lon")), F.col("center.lon")),
        }
    )


def fallback_name(elements: DataFrame) -> DataFrame:
    """Adds name (local, Vietnamese, English) and category (tourism, amenity, historic)."""
    return elements.withColumns(
        {
            "name": F.coalesce(tag("name"), tag("name:vi"), tag("name:en")),
            "category": F.coalesce(tag("tourism"), tag("amenity"), tag("historic")),
        }
    )


def elements_of(areas: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per element of each area group, with its ``position`` in the group."""
    return areas.select(*carry, F.posexplode("elements").alias("position", "element")).select(
        *carry, F.col("position").cast("long").alias("position"), "element.*"
    )


# The normalisers give one shape, schemas.PLACES, and more columns of their own. ``position`` is
# the place of a record in its document; ``carry`` names columns of the document to keep, such as
# the query that found it and the time it was collected.


def google_places(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of a "places" search response."""
    place = F.col("place")
    kinds = place["types"]
    return df.select(*carry, F.posexplode("places").alias("position", "place")).select(
        *carry,
        F.lit("google").alias("source"),
        place["id"].alias("source_id"),
        F.coalesce(place["displayName"]["text"], F.lit("")).alias("name"),
        place["location"]["latitude"].alias("lat"),
        place["location"]["longitude"].alias("lon"),
        place["rating"].alias("rating"),
        place["userRatingCount"].alias("review_count"),
        F.when(F.size(kinds) > 0, F.get(kinds, 0)).otherwise("attraction").alias("category"),
        F.col("position").cast("long").alias("position"),
        kinds.alias("types"),
    )


def overpass(areas: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Named and located elements as places."""
    named = fallback_name(fallback_coords(elements_of(areas, carry)))
    located = named.where(
        F.col("name").isNotNull() & nonzero(F.col("lat")).isNotNull() & nonzero(F.col("lon")).isNotNull()
    )
    return located.select(
        *carry,
        F.lit("osm").alias("source"),
        F.concat_ws("/", "type", F.col("id").cast("string")).alias("source_id"),
        "name",
        "lat",
        "lon",
        F.lit(None).cast("double").alias("rating"),
        F.lit(None).cast("long").alias("review_count"),
        "category",
        "position",
    )


def overpass_flat(areas: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Tagged nodes and ways with their main tags as columns."""
    elements = elements_of(areas, carry).where(F.col("type").isin("node", "way") & F.col("tags").isNotNull())
    plain = [F.try_element_at(F.col("tags"), F.lit(t)).alias(t) for t in ("name", "amenity", "tourism", "historic")]
    return fallback_coords(elements).select(
        *carry,
        F.col("id").cast("string").alias("osm_id"),
        F.col("type").alias("osm_type"),
        "lat",
        "lon",
        "tags",
        F.try_element_at(F.col("tags"), F.lit("name:en")).alias("name_en"),
        *plain,
    )


def _local_items(raw: str) -> Column:
    """The result list of a local search; null if its text holds none."""
    text = F.col(raw)
    is_list = F.ltrim(text).startswith("[")
    as_list = F.from_json(F.when(is_list, text), schemas.LOCAL_LIST)
    as_object = F.from_json(F.when(~is_list, text), schemas.LOCAL_OBJECT)
    places = F.when(F.size(as_object["places"]) > 0, as_object["places"]).otherwise(as_object["results"])
    return F.coalesce(as_list, places)


def local_rejects(df: DataFrame, raw: str = "local_results") -> DataFrame:
    """Documents of a local search whose text is not null and holds no result list."""
    return df.where(F.col(raw).isNotNull() & _local_items(raw).isNull())


def _first(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.get(items, 0))


def google_local(df: DataFrame, raw: str = "local_results", carry: Sequence[str] = ()) -> DataFrame:
    """Rows of a local search, whose result text is a list or an object with a list in it.

    Texts that are neither are in ``local_rejects``.
    """
    item = F.col("item")
    place_id = F.coalesce(blank_to_null(item["place_id"]), item["data_id"])
    return df.select(*carry, F.posexplode(_local_items(raw)).alias("position", "item")).select(
        *carry,
        F.lit("google_local").alias("source"),
        place_id.alias("source_id"),
        F.coalesce(item["title"], F.lit("")).alias("name"),
        item["reviews"].alias("review_count"),
        F.coalesce(_first(item["types"]), item["type"]).alias("category"),
        F.col("position").cast("long").alias("position"),
        item["title"].alias("title"),
        place_id.alias("place_id"),
        item["data_id"].alias("data_id"),
        item["rating"].alias("rating"),
        item["reviews"].alias("reviews"),
        F.when(F.size(item["types"]) > 0, item["types"])
        .when(item["type"].isNotNull(), F.array(item["type"]))
        .alias("types"),
        item["address"].alias("address"),
        item["gps_coordinates"]["latitude"].alias("lat"),
        item["gps_coordinates"]["longitude"].alias("lon"),
        item["thumbnail"].alias("thumbnail"),
        item["description"].alias("description"),
        item["hours"].alias("hours"),
    )


def tripadvisor(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of a review-site search: ``places`` when it has any, else ``results``.

    The site gives no position on the map, so these places match nothing and stay on their own.
    """
    found = F.when(F.size("places") > 0, F.col("places")).otherwise(F.col("results"))
    item = F.col("item")
    reviews = F.coalesce(F.when(item["reviews"] != 0, item["reviews"]), item["num_reviews"])
    return df.select(*carry, F.posexplode(found).alias("position", "item")).select(
        *carry,
        F.lit("tripadvisor").alias("source"),
        item["place_id"].alias("source_id"),
        F.coalesce(item["title"], F.lit("")).alias("name"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
        reviews.alias("review_count"),
        F.lit(None).cast("string").alias("category"),
        F.col("position").cast("long").alias("position"),
        item["title"].alias("title"),
        item["place_id"].alias("place_id"),
        item["rating"].alias("rating"),
        reviews.alias("reviews_count"),
        item["location_string"].alias("location_string"),
        item["link"].alias("url"),
        item["thumbnail"].alias("thumbnail"),
        item["description"].alias("description"),
    )


def details(df: DataFrame, record: str = "google_data") -> DataFrame:
    """A place-details record as flat columns."""
    r = F.col(record)
    return df.where(r.isNotNull()).select(
        r["name"].alias("name"),
        r["formatted_address"].alias("address"),
        r["geometry"]["location"]["lat"].alias("latitude"),
        r["geometry"]["location"]["lng"].alias("longitude"),
        r["rating"].alias("rating"),
        r["user_ratings_total"].alias("review_count"),
        r["website"].alias("website"),
        r["international_phone_number"].alias("phone"),
        r["types"].alias("types"),
    )


def child_tables(df: DataFrame, key: str, record: str = "google_data") -> dict[str, DataFrame]:
    """Reviews, opening periods and photos of each record as child tables by ``key``."""
    r = F.col(record)

    def children(items: Column, *fields: tuple[str, str]) -> DataFrame:
        rows = df.select(F.col(key), F.posexplode(items).alias("position", "child"))
        return rows.select(key, "position", *[F.col(f"child.{path}").alias(name) for path, name in fields])

    return {
        "reviews": children(
            r["reviews"], ("author_name", "author_name"), ("rating", "rating"), ("text", "text"), ("time", "time")
        ),
        "opening_hours": children(
            r["opening_hours"]["periods"],
            ("open.day", "open_day"),
            ("open.time", "open_time"),
            ("close.day", "close_day"),
            ("close.time", "close_time"),
        ),
        "photos": children(
            r["photos"], ("photo_reference", "photo_reference"), ("height", "height"), ("width", "width")
        ),
    }


def select_by_tags(elements: DataFrame, clauses=tuple(K.ATTRACTION_CLAUSES)) -> DataFrame:
    """Elements that match any (type, tag, value or None) clause."""
    keep = F.lit(False)
    for kind, name, value in clauses:
        found = F.try_element_at(F.col("tags"), F.lit(name))
        matches = found.isNotNull() if value is None else found == value
        keep = keep | ((F.col("type") == kind) & F.coalesce(matches, F.lit(False)))
    return elements.where(keep)


def enrichment_candidates(elements: DataFrame, excluded=tuple(K.LODGING_KINDS), kind: str = "attraction") -> DataFrame:
    """Named attractions, museums and historic places that are not lodging."""
    tourism = F.coalesce(F.try_element_at(F.col("tags"), F.lit("tourism")), F.lit(""))
    wanted = (tourism == kind) | tourism.contains("museum") | tag("historic").isNotNull()
    chosen = elements.where(tag("name").isNotNull() & ~tourism.isin(*excluded) & wanted)
    return fallback_coords(chosen).select(
        F.col("id").alias("osm_id"), F.col("type").alias("osm_type"), tag("name").alias("name"), "tags", "lat", "lon"
    )
