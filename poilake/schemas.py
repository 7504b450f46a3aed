"""Explicit input schemas as DDL; a field missing from the JSON reads as null."""

TAGS = "map<string,string>"

ELEMENT = f"""struct<type:string, id:bigint, lat:double, lon:double,
    center:struct<lat:double,lon:double>, tags:{TAGS}>"""

# One area group per row, as an Overpass response holds it.
OVERPASS = f"elements array<{ELEMENT}>"

# A "places" search response.
PLACES_SEARCH = """places array<struct<displayName:struct<text:string>,
    location:struct<latitude:double,longitude:double>, rating:double, types:array<string>,
    id:string, userRatingCount:bigint>>"""

DETAILS = """struct<name:string, formatted_address:string,
    geometry:struct<location:struct<lat:double,lng:double>>, rating:double,
    user_ratings_total:bigint, website:string, international_phone_number:string,
    types:array<string>,
    opening_hours:struct<periods:array<struct<open:struct<day:int,time:string>,close:struct<day:int,time:string>>>>,
    reviews:array<struct<author_name:string,rating:int,text:string,time:bigint>>,
    photos:array<struct<photo_reference:string,height:int,width:int>>>"""

# One enriched record per row, with the partition columns of the landing path.
ENRICHED = f"""osm_data struct<osm_id:bigint, osm_type:string, name:string, tags:{TAGS}, lat:double, lon:double>,
    google_data {DETAILS},
    ingested_at string, source string, snapshot_date date, run_id string"""

LOCAL_ITEM = """struct<title:string, place_id:string, data_id:string, rating:double, reviews:bigint,
    types:array<string>, type:string, address:string,
    gps_coordinates:struct<latitude:double,longitude:double>, thumbnail:string,
    description:string, hours:string>"""
LOCAL_LIST = f"array<{LOCAL_ITEM}>"
LOCAL_OBJECT = f"struct<places:array<{LOCAL_ITEM}>, results:array<{LOCAL_ITEM}>>"

REVIEW_ITEM = """struct<title:string, place_id:string, rating:double, reviews:bigint, num_reviews:bigint,
    location_string:string, link:string, thumbnail:string, description:string>"""
REVIEW_SITE = f"places array<{REVIEW_ITEM}>, results array<{REVIEW_ITEM}>"

# Rows of the entity-resolution input.
PLACES = """source string, source_id string, name string, lat double, lon double, rating double,
    review_count bigint, category string, position bigint"""

SILVER = """osm_id bigint, name string, address string, latitude double, longitude double, rating double,
    review_count bigint, website string, phone string, poi_types array<string>, run_id string,
    snapshot_date date, source_ingested_at timestamp, silver_processed_at timestamp, business_key string"""
