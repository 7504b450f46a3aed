"""The results depend on these being exactly as written."""

# District name, centre latitude, centre longitude.
DISTRICT_CENTERS = [
    ("Ba Dinh", 21.0366, 105.8290),
    ("Hoan Kiem", 21.0287, 105.8524),
    ("Dong Da", 21.0131, 105.8262),
    ("Hai Ba Trung", 21.0125, 105.8546),
    ("Cau Giay", 21.0357, 105.7958),
    ("Thanh Xuan", 20.9941, 105.8078),
    ("Tay Ho", 21.0725, 105.8211),
    ("Hoang Mai", 20.9639, 105.8572),
    ("Long Bien", 21.0425, 105.9011),
    ("Ha Dong", 20.9630, 105.7640),
    ("Bac Từ Liêm", 21.0631, 105.7535),
    ("Nam Từ Liêm", 21.0185, 105.7628),
    ("Son Tay", 21.1394, 105.5039),
    ("Ba Vi", 21.2183, 105.4111),
    ("Chuong My", 20.8806, 105.6792),
    ("Dan Phuong", 21.1072, 105.6717),
    ("Dong Anh", 21.1442, 105.8503),
    ("Gia Lam", 21.0225, 105.9406),
    ("Hoai Duc", 21.0203, 105.7058),
    ("Me Linh", 21.1925, 105.7364),
    ("My Duc", 20.6975, 105.7442),
    ("Phu Xuyen", 20.7289, 105.9125),
    ("Phuc Tho", 21.1086, 105.5794),
    ("Quoc Oai", 20.9903, 105.6417),
    ("Soc Son", 21.2581, 105.8500),
    ("Thach That", 21.0064, 105.5564),
    ("Thanh Oai", 20.8753, 105.7797),
    ("Thanh Tri", 20.9500, 105.8500),
    ("Thuong Tin", 20.8367, 105.8550),
    ("Ung Hoa", 20.7264, 105.8039),
]

# District name, latitude range, longitude range: the two boxes that are published.
DISTRICT_BOXES = [
    ("Hoàn Kiếm", 21.02, 21.04, 105.84, 105.86),
    ("Ba Đình", 21.03, 21.05, 105.81, 105.83),
]
UNKNOWN_DISTRICT = "Unknown District"

# Latitude and longitude range of valid coordinates.
CITY_BOX = (20.5, 21.5, 105.0, 106.5)

# Element type, tag, value (None: any value) of the wide attraction selector.
ATTRACTION_CLAUSES = [
    ("node", "tourism", None),
    ("way", "tourism", None),
    ("node", "historic", None),
    ("way", "historic", None),
    ("node", "amenity", "place_of_worship"),
    ("way", "amenity", "place_of_worship"),
    ("node", "amenity", "museum"),
    ("node", "amenity", "arts_centre"),
    ("node", "amenity", "restaurant"),
    ("node", "leisure", "park"),
    ("way", "leisure", "park"),
    ("node", "leisure", "nature_reserve"),
    ("node", "leisure", "theme_park"),
    ("node", "shop", "craft"),
    ("node", "craft", None),
]

# The narrow selector.
HERITAGE_CLAUSES = [
    ("node", "tourism", "attraction"),
    ("way", "tourism", "attraction"),
    ("node", "historic", None),
    ("way", "historic", None),
    ("node", "tourism", "museum"),
    ("way", "tourism", "museum"),
]

# Tourism values that are never enriched.
LODGING_KINDS = ["hotel", "guest_house", "hostel", "information", "apartment"]

# Entity resolution: metres, metres, similarity (0-100, exclusive).
NEAR_METERS, FAR_METERS, MIN_SIMILARITY = 100.0, 300.0, 80

# Source labels by which identifiers and ratings are present.
SOURCE_BOTH, SOURCE_RATED_ONLY, SOURCE_UNRATED = "Hợp nhất (Google + OSM)", "Chỉ Google", "Chỉ OSM"

# Sentiment labels: rating >= 4.5, >= 4.0, else.
SENTIMENT_LABELS = (
    "Rất hài lòng (Excellent)",
    "Hài lòng (Good)",
    "Cần cải thiện (Needs Improvement)",
)

# Landed object names.
LANDING_PATTERN = r"snapshot_date=[0-9]{4}-[0-9]{2}-[0-9]{2}/run_id=[A-Za-z0-9_:+-]+/[^/]+\.json$"

# The raw category tag and the category it is shown as.
CATEGORY_MAP = [("restaurant", "Ẩm thực")]
