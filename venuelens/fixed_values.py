"""Word lists, lookup tables, labels, limits and patterns.

These must stay exactly as they are for results to be right, so they are kept
together here as plain text. Every operator takes them as default arguments;
callers with other data pass their own.
"""

# --- fixed values: placeholders ------------------------------------------------
UNKNOWN = "Unknown"
PLACEHOLDERS = ("", "unknown", "null", "none", "n/a", "nan")
DISTRICT_REPORT_PLACEHOLDERS = ("", "null", "Unknown")
TOP_DISTRICT_PLACEHOLDERS = ("Unknown", "")
MEAL_REPORT_PLACEHOLDERS = ("", "null")

DEFAULT_RESTAURANT_NAME = "Unnamed Restaurant"
DEFAULT_USER = "Anonymous"
MEAL_ID_PREFIX = "meal_"
RESTAURANT_ID_PREFIX = "rest_"
MEAL_INGREDIENT_COLUMNS = 20

# --- fixed values: place names -------------------------------------------------
AREA_ALIASES = {
    "an khanh": "An Khánh",
    "ben nghe": "Bến Nghé",
    "ben thanh": "Bến Thành",
    "binh tan": "Bình Tân",
    "binh thanh": "Bình Thạnh",
    "can gio": "Cần Giờ",
    "cu chi": "Củ Chi",
    "go vap": "Gò Vấp",
    "hoc mon": "Hóc Môn",
    "nha be": "Nhà Bè",
    "pham ngu lao": "Phạm Ngũ Lão",
    "phu my hung": "Phú Mỹ Hưng",
    "phu nhuan": "Phú Nhuận",
    "sai gon": "Sài Gòn",
    "saigon": "Sài Gòn",
    "tan binh": "Tân Bình",
    "tan dinh": "Tân Định",
    "tan phong": "Tân Phong",
    "tan phu": "Tân Phú",
    "thao dien": "Thảo Điền",
    "thu duc": "Thủ Đức",
    "vo thi sau": "Võ Thị Sáu",
    "xuan hoa": "Xuân Hòa",
}
DISTRICT_LABEL = "Quận"
WARD_LABEL = "Phường"

CITY_LABEL = "Ho Chi Minh City"
CITY_PATTERN = r"\b(ho\s+chi\s+minh\s+city|hcmc|tp\.?\s*hcm|tphcm|sai\s*gon|saigon)\b"
POSTCODE_PATTERN = r"\b\d{4,6}\b"
COUNTRY_PATTERN = r"\bVietnam\b"

# Matched in the order given, without regard to case.
DISTRICT_NUMBER_PATTERN = r"\b(?:Qu[aậ]n|Q\.|District|Dist\.|Dis\.?)\s*(\d{1,2})\b"
DISTRICT_LOCAL_PATTERN = r"\b(?:Qu[aậ]n|Q\.)\s*([A-Za-zÀ-ỹ][A-Za-zÀ-ỹ0-9\s-]{0,40}?)(?=,|$|\b(?:Vietnam|Ho Chi Minh|HCMC|Tp\.?\s*Hcm)\b)"
DISTRICT_PREFIX_PATTERN_LITERAL = r"\b(?:District|Dist\.|Dis\.?)\s*([A-Za-zÀ-ỹ][A-Za-zÀ-ỹ0-9\s-]{0,40}?)(?=,|$|\b(?:Vietnam|Ho Chi Minh|HCMC|Tp\.?\s*Hcm)\b)"
# The pattern above also reads the "Dis" of "District" as the short form; this one asks for a word end after it.
DISTRICT_PREFIX_PATTERN = r"\b(?:District\b|Dist\.|Dis\.|Dis\b)\s*([A-Za-zÀ-ỹ][A-Za-zÀ-ỹ0-9\s-]{0,40}?)(?=,|$|\b(?:Vietnam|Ho Chi Minh|HCMC|Tp\.?\s*Hcm)\b)"
DISTRICT_SUFFIX_PATTERN = r"\b([A-Za-zÀ-ỹ][A-Za-zÀ-ỹ\s-]{0,40}?)\s+District\b"
WARD_LOCAL_PATTERN = r"\b(?:Phường|P\.|W\.)\s*([A-Za-zÀ-ỹ0-9][A-Za-zÀ-ỹ0-9\s-]{0,40}?)(?=,|$|\b(?:Vietnam|Ho Chi Minh|HCMC|Tp\.?\s*Hcm|District|Dis\.?|Qu[aậ]n|Q\.)\b)"
WARD_SUFFIX_PATTERN = r"\b([A-Za-zÀ-ỹ][A-Za-zÀ-ỹ0-9\s-]{0,40}?)\s+Ward\b(?=,|$|\b(?:Vietnam|Ho Chi Minh|HCMC|Tp\.?\s*Hcm|District|Dis\.?|Qu[aậ]n|Q\.)\b)"
WARD_PREFIX_PATTERN = r"\bWard\s+([A-Za-zÀ-ỹ0-9][A-Za-zÀ-ỹ0-9\s-]{0,40}?)(?=,|$|\b(?:Vietnam|Ho Chi Minh|HCMC|Tp\.?\s*Hcm|District|Dis\.?|Qu[aậ]n|Q\.)\b)"

STREET_WORDS_PATTERN = r"\b(?:street|st\.|road|rd\.|avenue|ave\.|boulevard|blvd|lane|hotel|building|tower|floor|level|port|block|đường|đ\.)\b"
STREET_WORDS_PATTERN_ASCII = r"\b(?:street|st\.|road|rd\.|avenue|ave\.|boulevard|blvd|lane|hotel|building|tower|floor|level|port|block|duong|d\.)\b"
HOUSE_NUMBER_PATTERN = r"^[\d\-/]+"
AREA_SUFFIX_PATTERN = r"\b(?:ward|district)\b$"

# --- fixed values: word lists --------------------------------------------------
POSITIVE_WORDS = (
    "good", "excellent", "delicious", "tasty", "friendly", "great", "nice",
    "amazing", "best", "perfect", "love", "wonderful", "satisfied", "clean",
    "beautiful", "fresh", "helpful", "like", "awesome", "fantastic", "deliciously",
)
NEGATIVE_WORDS = (
    "bad", "slow", "poor", "dirty", "rude", "expensive", "worst", "cold",
    "average", "disappointed", "terrible", "horrible", "overpriced", "dislike",
    "angry", "hate", "unfriendly", "waste", "soggy",
)
DELIVERY_WORDS = (
    "delivery", "deliver", "ship", "takeaway", "carryout", "grab",
    "shopeefood", "gojek", "foody", "mang ve", "giao hang", "shipment",
)
DELIVERY_LIKE_PATTERNS = (
    "%delivery%", "%giao h%ng%", "%ship%", "%takeaway%", "%take away%",
    "%mang ve%", "%shopeefood%", "%grab food%",
)
INGREDIENTS = (
    "beef", "chicken", "pork", "duck", "shrimp", "prawn", "fish", "crab", "squid", "lobster",
    "rice", "noodle", "noodles", "egg", "eggs", "cheese", "garlic", "ginger", "onion", "chili",
    "pepper", "salt", "sugar", "sauce", "basil", "mint", "cilantro", "lime", "lemon", "coconut",
)

# --- fixed values: report labels and limits ------------------------------------
RATING_BUCKET_HIGH = "4-5 Stars"
RATING_BUCKET_MIDDLE = "3 Stars"
RATING_BUCKET_LOW = "1-2 Stars"
HISTOGRAM_BINS = (
    (2.0, "1-2 sao (Kem)"),
    (3.0, "2-3 sao (Duoi TB)"),
    (4.0, "3-4 sao (Trung binh)"),
    (4.5, "4-4.5 sao (Tot)"),
)
HISTOGRAM_TOP = (5.0, "4.5-5 sao (Xuat sac)")
HISTOGRAM_OTHER = "Chua co danh gia"
VENUE_DELIVERY = "Delivery-Friendly"
VENUE_DINE_IN = "Dine-In-Only"
REVIEW_DELIVERY = "Delivery"
REVIEW_DINE_IN = "Dine-in"
TOP_REVIEWED = 10
DISTRICT_REPORT_ROWS = 20
CATEGORY_REPORT_ROWS = 15
TOP_DISTRICT_REPORT_ROWS = 20
PAGE_SIZES = (10, 20, 50, 100)
UNKNOWN_SHARE_WARNING = 0.8

# --- fixed values: crawl rules and text lengths --------------------------------
LIST_URL_PATTERN = r"-oa\d+-Ho_Chi_Minh_City\.html"
DETAIL_URL_PATTERN = r"Restaurant_Review-g293925-d\d+-Reviews-"
SHORT_ID_PATTERN = r"-(d\d+)-"
REVIEW_PAGE_SIZE = 15
MAX_REVIEWS = 75
RESTAURANT_TEXT_LIMITS = {
    "id": 255, "name": 255, "address": 500, "district": 255, "district_parsed": 100, "city": 100,
}
REVIEW_TEXT_LIMITS = {"restaurant_id": 255, "user": 255}
MEAL_TEXT_LIMITS = {"id": 255, "name": 255, "category": 100, "area": 100}
INT_MIN, INT_MAX = -2147483648, 2147483647

# --- fixed values: names that existing SQL refers to ---------------------------
NESTED_RESTAURANTS_TABLE = "mongodb_restaurants"
NESTED_MEALS_TABLE = "mongodb_meals"
RESTAURANTS_TABLE = "mysql_restaurants"
REVIEWS_TABLE = "mysql_reviews"
MEALS_TABLE = "mysql_meals"
BACKUP_NAME_PREFIX = "backup_"
BACKUP_TIME_FORMAT = "%Y%m%d_%H%M%S"
