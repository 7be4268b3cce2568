import unicodedata

from helpers import evaluate
from pyspark.sql import functions as F

from venuelens.functions import documents, numbers, places, sql, text, urls



def test_parse_review_count(spark):
    values = ["(112)", "1,234", "128", None, "7.9", "", "none", "-3", "99999999999", "9" * 30]
    assert evaluate(spark, numbers.parse_review_count(F.col("v")), values) == [
        112, 1234, 128, 0, 7, 0, 0, -3, 99999999999, None
    ]


def test_parse_review_rating(spark):
    values = ["5 of 5 bubbles", "4 OF 5", "4.5 of 5 bubbles", None, "3.5", "4", " 4 ", "rated 4", "nan", "-2", ""]
    assert evaluate(spark, numbers.parse_review_rating(F.col("v")), values) == [
        5.0, 4.0, 4.5, None, 3.5, 4.0, 4.0, None, None, -2.0, None
    ]


def test_extract_float(spark):
    values = ["4.5", "5 of 5", "about 3.25 stars", "-2.5", "x", None, "", "1e2", "v2.", "a -7"]
    assert evaluate(spark, numbers.extract_float(F.col("v")), values) == [
        4.5, 5.0, 3.25, -2.5, None, None, None, 100.0, 2.0, 7.0
    ]


def test_strict_float(spark):
    values = ["4.5", " 4\n", "4.", ".5", "4 of 5", "1d", "nan", "inf", "", None]
    assert evaluate(spark, numbers.strict_float(F.col("v")), values) == [
        4.5, 4.0, 4.0, 0.5, None, None, None, None, None, None
    ]


def test_make_short_id(spark):
    url = "https://www.example.com/Restaurant_Review-g293925-d33215720-Reviews-Bun.html"
    assert evaluate(spark, text.make_short_id(F.col("v")), [url, "rest_d1", "meal_3", "", None]) == [
        "rest_d33215720", "rest_d1", "meal_3", "", ""
    ]


def test_clean_location_text(spark):
    values = [" a \n b ,", ",,", "Unknown", "NULL", "n/a", " None ", "NaN", None, "a  b", "a, b"]
    assert evaluate(spark, places.clean_location_text(F.col("v")), values) == ["a b", "", "", "", "", "", "", "", "a b", "a, b"]
    assert evaluate(spark, places.is_unknown_location(F.col("v")), ["x", "unknown,", None]) == [False, True, True]


def test_strip_accents(spark):
    values = ["Quận Bình Thạnh", "Đa Kao", "café ñ ü", "plain", "phở 日本", None, unicodedata.normalize("NFD", "Quận")]
    assert evaluate(spark, places.strip_accents(F.col("v")), values) == [
        "Quan Binh Thanh", "Da Kao", "cafe n u", "plain", "pho ", None, "Quan"
    ]
    assert evaluate(spark, places.strip_accents(F.col("v"), literal=True), ["Đa Kao"]) == ["a Kao"]


def test_strip_accents_follows_decomposition(spark):
    words = ["".join(chr(c) for c in range(start, start + 32)) for start in (0xC0, 0x100, 0x1EA0, 0x1EC0, 0x1EE0)]
    words = [w.replace("Ĳ", "").replace("ĳ", "").replace("Đ", "").replace("đ", "") for w in words]
    want = [unicodedata.normalize("NFKD", w).encode("ascii", "ignore").decode() for w in words]
    assert evaluate(spark, places.strip_accents(F.col("v")), words) == want


ADDRESSES = [
    # text, intended, literal
    ("18B/17 Đ. Nguyễn Thị Minh Khai Quận 1, Ho Chi Minh City 70000 Vietnam", "Quận 1", "Unknown"),
    ("Phường Bến Nghé, Quận 1", "Quận 1", "Phường Bến Nghé"),
    ("District 1, HCMC", "Quận 1", "Quận Trict 1"),
    ("Q. Bình Thạnh", "Quận Bình Thạnh", "Quận Bình Thạnh"),
    ("Quận Tân Bình, Vietnam", "Quận Tân Bình", "Quận Tân Bình"),
    ("Binh Thanh District, Ho Chi Minh City", "Quận Bình Thạnh", "Quận Trict"),
    ("22 - 22 Bis Le Thanh Ton street, Ben Nghe Ward, District 1 Lancaster Building, Ho Chi Minh City",
     "Quận 1", "Phường Bến Nghé"),
    ("Level 3 - 68 Nguyễn Huệ, Quận 1, Ho Chi Minh City 700000 Vietnam", "Quận 1", "Unknown"),
    ("", "Unknown", "Unknown"),
    (None, "Unknown", "Unknown"),
    ("Q.1", "Quận 1", "Unknown"),
    ("QUẬN THỦ ĐỨC, HCMC", "Quận Thủ Đức", "Quận Thủ Đức"),
]


def test_extract_admin_area(spark):
    texts = [a[0] for a in ADDRESSES]
    assert evaluate(spark, places.extract_admin_area(F.col("v")), texts) == [a[1] for a in ADDRESSES]
    assert evaluate(spark, places.extract_admin_area(F.col("v"), literal=True), texts) == [a[2] for a in ADDRESSES]


def test_extract_admin_area_ascii(spark):
    texts = ["Quận Bình Thạnh", "Phường Đa Kao", "saigon ward", "Quận 10"]
    assert evaluate(spark, places.extract_admin_area(F.col("v"), ascii=True), texts) == [
        "Quan Binh Thanh", "Phuong Da Kao", "Phuong Sai Gon", "Quan 10"
    ]


def test_kind_of_area_goes_before_source(spark):
    df = spark.createDataFrame([("Ben Nghe Ward", "Quận 3", "n/a"), ("x", "Thao Dien Ward", "Q. Go Vap")], "a string, b string, c string")
    got = [r[0] for r in df.select(places.extract_admin_area(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["Quận 3", "Quận Gò Vấp"]


def test_trim_noise_and_names(spark):
    assert evaluate(spark, places.trim_noise(F.col("v")), ["12 Main street Foo District", "12", "Đường Lê Lợi", "9/3 tan-phu", "none"]) == [
        "Foo", "12", "Lê Lợi", "tan-phu", ""
    ]
    assert evaluate(spark, places.trim_noise(F.col("v"), literal=True), ["12"]) == [""]
    assert evaluate(spark, places.normalize_area_name(F.col("v")), ["ben nghe", "tan-phu x", "FOO bar", "7"]) == [
        "Bến Nghé", "Tan-phu X", "Foo Bar", "7"
    ]


def test_normalize_city(spark):
    values = ["Ho Chi Minh City 70000 Vietnam", "TP.HCM", "Sài Gòn", "Hà Nội 10000, Vietnam", "Vietnam", None, "70000"]
    assert evaluate(spark, places.normalize_city(F.col("v")), values) == [
        "Ho Chi Minh City", "Ho Chi Minh City", "Ho Chi Minh City", "Hà Nội", "Unknown", "Unknown", "Unknown"
    ]


def test_address_parts_and_defaults(spark):
    district, city = text.split_address(F.col("v"))
    values = ["12 Main, Foo , Bar", "Bar", "", None]
    assert evaluate(spark, city, values) == ["Bar", "Bar", None, None]
    assert evaluate(spark, district, values) == ["Foo", None, None, None]
    assert evaluate(spark, text.default_if_blank(F.col("v"), "d"), ["a", "", None]) == ["a", "d", "d"]
    assert evaluate(spark, text.first_present(F.col("v"), F.lit(None), F.lit("z")), ["a", "", None]) == ["a", "z", "z"]


def test_lists(spark):
    values = [[" a ", "", None, "\tb\n"], [], None]
    assert evaluate(spark, text.trimmed_list(F.col("v")), values, "array<string>") == [["a", "b"], [], []]
    assert evaluate(spark, text.array_to_csv(F.col("v")), [["a", "", "b"], None], "array<string>") == ["a, b", ""]
    assert evaluate(spark, text.csv_to_array(F.col("v")), ["a, b", ""]) == [["a", "b"], []]


def test_clean_reviews(spark):
    kind = "array<struct<user:string,rating:string,comment:string>>"
    values = [
        [("Ann", "5 of 5 bubbles", " good\n"), ("", "4 of 5", ""), (None, None, None), (" ", None, "x"), ("u", "rated 3", None)],
        [],
        None,
    ]
    got = evaluate(spark, documents.clean_reviews(F.col("v")), values, kind)
    assert [tuple(r) for r in got[0]] == [
        ("Ann", 5.0, "good"), ("Anonymous", 4.0, None), ("Anonymous", None, "x"), ("u", None, None)
    ]
    assert got[1:] == [[], []]
    crawled = evaluate(spark, documents.clean_reviews(F.col("v"), any_number=True), values[:1], kind)
    assert crawled[0][-1]["rating"] == 3.0


def test_tokens_and_keywords(spark):
    assert evaluate(spark, text.tokenize(F.col("v")), ["Phở bò rất GOOD, café_1!"]) == [["phở", "bò", "rất", "good", "café_1"]]
    values = ["a friendship", "Ship it", "GIAO HÀNG nhanh", "", None]
    assert evaluate(spark, text.contains_any(F.col("v"), ["ship"]), values) == [True, True, False, False, None]
    assert evaluate(spark, text.contains_any(F.col("v"), ["ship"], whole_word=True), values) == [False, True, False, False, None]
    assert evaluate(spark, text.like_any(F.col("v"), ["%giao h%ng%"]), values) == [False, False, True, False, None]


def test_links(spark):
    values = [
        "https://x/Restaurants-g1-oa30-Ho_Chi_Minh_City.html", "https://x/Restaurant_Review-g293925-d2-Reviews-or15-a.html", "https://x/"
    ]
    assert evaluate(spark, urls.link_class(F.col("v")), values) == ["list", "detail", None]

    def following(cards, total, **stop):
        return urls.next_page_url(F.col("v"), F.lit(cards), F.lit(total), **stop)

    pages = ["x-Reviews-a", "x-Reviews-or15-a", "x-Reviews-or60-a"]
    assert evaluate(spark, following(15, 0), pages) == ["x-Reviews-or15-a", "x-Reviews-or30-a", "x-Reviews-or75-a"]
    assert evaluate(spark, following(15, 0, max_reviews=75), pages) == ["x-Reviews-or15-a", "x-Reviews-or30-a", None]
    assert evaluate(spark, following(15, 30), pages) == ["x-Reviews-or15-a", None, None]
    assert evaluate(spark, following(14, 100), pages) == [None, None, None]


def test_sql_functions_agree_with_column_functions(spark):
    names = sql.register(spark)
    values = ["(112)", "1,234", "7.9", None, "", "none", "-3", "9" * 30, "5 of 5 bubbles", " 4 ", "rated 3.5", "1e2", "x-d12-y", "."]
    columns = {
        "strict_float": numbers.strict_float, "extract_float": numbers.extract_float,
        "parse_review_rating": numbers.parse_review_rating, "parse_review_count": numbers.parse_review_count,
        "make_short_id": text.make_short_id,
    }
    assert set(names) == set(columns)
    for name, function in columns.items():
        assert evaluate(spark, F.expr(f"{name}(v)"), values) == evaluate(spark, function(F.col("v")), values), name
