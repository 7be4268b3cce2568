import random
import re
from collections import Counter

import pytest
from helpers import as_set, plan_of
from pyspark.sql import functions as F

from venuelens import fixed_values as fv
from venuelens import schemas
from venuelens.operators import jobs, quality, terms
from venuelens.plans import reports, views

REVIEW = "array<struct<user:string,rating:string,comment:string>>"


def restaurants(spark, rows):
    return spark.createDataFrame(
        [tuple(r.get(f) for f in schemas.RESTAURANTS_RAW.fieldNames()) for r in rows], schemas.RESTAURANTS_RAW
    )


def venue(id, **fields):
    return {"id": id, **fields}


def test_rating_by_area_golden(spark):
    df = restaurants(spark, [
        venue("rest_1", rating="5.0", district="18B/17 Đ. Nguyễn Thị Minh Khai Quận 1", city="Ho Chi Minh City"),
        venue("rest_2", rating="4.0", district="Phường Bến Nghé, Quận 1", city="Ho Chi Minh City"),
        venue("rest_3", rating="3.0", district="Quận 3, HCMC", city="Ho Chi Minh City"),
    ])
    assert as_set(jobs.rating_by_area(df)) == {("Quận 1", 4.5, 2), ("Quận 3", 3.0, 1)}
    assert as_set(jobs.rating_by_area(df, ascii=True, literal=True)) == {("Phuong Ben Nghe", 4.0, 1)}


def test_rating_by_area_edges(spark):
    df = restaurants(spark, [
        venue("a", rating="4", district_parsed="X"), venue("b", rating=None, district_parsed="X"),
        venue("c", rating="abc", district_parsed="X"), venue("d", rating="5", district_parsed="", district="Quận 2"),
        venue("e", rating="5", district_parsed="Unknown"), venue("f", rating="1", district="nowhere"),
    ])
    assert as_set(jobs.rating_by_area(df)) == {("X", 4.0, 1), ("Quận 2", 5.0, 1)}


def test_tag_count(spark):
    df = spark.createDataFrame(
        [("Beef", "Thai"), (" Beef ", None), ("Thai", "Thai"), ("", "  "), ("Unknown", "Unknown")], "category string, area string"
    )
    assert as_set(jobs.tag_count(df)) == {("Beef", 2), ("Thai", 3), ("Unknown", 2)}


def test_rating_bucket(spark):
    values = [None, "", "abc", "nan", "2.0", "2.99", "3.0", "3.5", "4.0", "4.5", "5.5"]
    df = spark.createDataFrame([(v,) for v in values], "rating string")
    assert as_set(jobs.rating_bucket(df)) == {("Unknown", 4), ("1-2 Stars", 2), ("3 Stars", 2), ("4-5 Stars", 3)}
    numeric = spark.createDataFrame([(4.0,), (None,), (float("nan"),)], "rating double")
    assert as_set(jobs.rating_bucket(numeric)) == {("4-5 Stars", 1), ("Unknown", 2)}


def test_lexicon_sentiment(spark):
    r = lambda c: (None, None, c)
    df = restaurants(spark, [
        venue("1", name="A", reviews=[r("Good good food"), r("bad, SLOW"), r(""), r(None)]),
        venue("2", name="A", reviews=[r("goodness")]),
        venue("3", name="B", reviews=[r("best but overpriced")]),
        venue("4", name="", reviews=[r("good")]),
        venue("5", name="C", reviews=None), venue("6", name="D", reviews=[]),
    ])
    assert as_set(jobs.lexicon_sentiment(df)) == {("A", 0.0, 3), ("B", 0.0, 1)}
    flat = df.select("name", F.explode("reviews.comment").alias("c"))
    assert as_set(jobs.positive_negative_ratio(flat, "name", "c")) == {("A", 2, 2, 0.5), ("B", 1, 1, 0.5)}


def test_top_reviewed(spark):
    rows = [venue(f"{i:02}", name=f"N{i:02}", review_count=str(i)) for i in range(12)]
    rows += [venue("x", name="N11", review_count="(1,234)"), venue("y", name="A", review_count="11"),
             venue("z", name="", review_count="9999"), venue("w", name="Q", review_count=None)]
    got = [tuple(r) for r in jobs.top_reviewed(restaurants(spark, rows)).collect()]
    assert got[:4] == [("N11", 1234), ("A", 11), ("N11", 11), ("N10", 10)]
    assert len(got) == 10
    assert "TakeOrderedAndProject" in plan_of(jobs.top_reviewed(restaurants(spark, rows)))


def test_star_distribution_rounds_half_even_and_clamps(spark):
    ratings = ["2.5", "3.5", "4.5", "5 of 5 bubbles", "0", "9", "none", None, "-3"]
    df = restaurants(spark, [venue("1", reviews=[(None, r, None) for r in ratings]), venue("2", reviews=None)])
    got = jobs.review_star_distribution(df)
    assert as_set(got) == {("2 Stars", 1), ("4 Stars", 2), ("5 Stars", 2), ("1 Star", 2)}
    assert {(r["stars"], r["share"]) for r in jobs.with_share(got).collect()} == {
        ("2 Stars", 0.1429), ("4 Stars", 0.2857), ("5 Stars", 0.2857), ("1 Star", 0.2857)
    }


def test_delivery_per_venue(spark):
    r = lambda c: (None, None, c)
    df = restaurants(spark, [
        venue("1", rating="4", reviews=[r("nice"), r("great FRIENDSHIP")]),
        venue("2", rating="3", reviews=[r(None), r("quiet")]),
        venue("3", rating="5", reviews=None), venue("4", rating=None, reviews=[r("delivery")]),
    ])
    assert as_set(jobs.delivery_vs_dinein_venue(df)) == {("Delivery-Friendly", 4.0, 1), ("Dine-In-Only", 4.0, 2)}
    assert as_set(jobs.delivery_vs_dinein_venue(df, whole_word=True)) == {("Dine-In-Only", 4.0, 3)}


# --- terms -----------------------------------------------------------------------

TEXTS = [
    "Rice noodles and rice. RICE-noodles", "  ricey price rice", "fried rice noodles soup, noodles soup!", "c++ and c+ (rice)",
    "phở bò phở", "", None, "noodles", "rice  noodles rice noodles rice", "soup noodles soup rice noodles soup",
]
DICTIONARY = ["rice", "rice noodles", "noodles soup", "noodles", "phở bò", "phở", "soup rice noodles", "rice-noodles", "and"]


def brute_force(texts, dictionary):
    pattern = re.compile(r"\b(" + "|".join(re.escape(t) for t in sorted(dictionary, key=len, reverse=True)) + r")\b")
    return set(Counter(m for t in texts if t for m in pattern.findall(t.lower())).items())


@pytest.mark.parametrize("dictionary", [DICTIONARY, ["rice", "noodles", "phở"], ["rice", "c++", "(rice)", "rice."], ["zzz"]])
def test_terms_match_brute_force(spark, dictionary):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, c string")
    want = brute_force(TEXTS, dictionary)
    assert as_set(terms.term_match_count(df, "c", dictionary)) == want
    table = spark.createDataFrame([(t,) for t in dictionary + dictionary[:1] + [""]], "term string")
    assert as_set(terms.term_match_count_joined(df, "id", "c", table)) == want
    assert as_set(terms.term_match_count_joined(df, "id", "c", table, broadcast_bytes=0)) == want


def test_terms_match_brute_force_on_random_texts(spark):
    import random

    rng = random.Random(7)
    words, gaps = ["a", "b", "c", "ab", "é"], [" ", "  ", "-", ", ", "."]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    dictionary = ["a", "a b", "b c a", "c", "ab-ab", "b  c", "é a", "a b c", "c a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, c string")
    want = brute_force(texts, dictionary)
    assert as_set(terms.term_match_count(df, "c", dictionary)) == want
    table = spark.createDataFrame([(t,) for t in dictionary], "term string")
    assert as_set(terms.term_match_count_joined(df, "id", "c", table)) == want


def test_nested_terms_and_dictionary(spark):
    df = restaurants(spark, [venue("1", reviews=[(None, None, "Beef, beef and pork"), (None, None, None)]), venue("2")])
    assert as_set(terms.nested_term_match_count(df)) == {("beef", 2), ("pork", 1)}
    seed = spark.createDataFrame([(" Beef ", None), ("", "Lime"), (None, "beef")], "strIngredient string, name string")
    assert as_set(terms.dictionary_terms(seed, "strIngredient", "name")) == {("beef",), ("lime",)}


def test_terms_broadcast_only_the_dictionary(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, c string")
    table = spark.createDataFrame([(t,) for t in DICTIONARY], "term string")
    assert "BuildRight" in plan_of(terms.term_match_count_joined(df, "id", "c", table))
    assert "Broadcast" not in plan_of(terms.term_match_count_joined(df, "id", "c", table, broadcast_bytes=0))


# --- views -----------------------------------------------------------------------

FLAT = [("Quận 1", 4.0), ("Quận 1", 5.0), ("Quận 2", None), ("", 3.0), ("null", 3.0), ("Unknown", 3.0), (None, 3.0)]


def flat(spark):
    return spark.createDataFrame(FLAT, "district_parsed string, rating double")


def test_district_views_differ_in_filters(spark):
    assert [tuple(r) for r in views.rating_by_district(flat(spark)).collect()] == [("Quận 1", 4.5, 2)]
    assert as_set(views.top_districts(flat(spark))) == {("Quận 1", 2, 4.5), ("Quận 2", 1, None), ("null", 1, 3.0)}
    assert [tuple(r) for r in views.best_districts(flat(spark)).collect()] == [("Quận 1", 4.5, 2)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (1.99, 2.0, 3.0, 4.0, 4.49, 4.5, 5.0, 5.5, None)], "rating double")
    assert as_set(views.rating_histogram(df)) == {
        ("1-2 sao (Kem)", 1), ("2-3 sao (Duoi TB)", 1), ("3-4 sao (Trung binh)", 1), ("4-4.5 sao (Tot)", 2),
        ("4.5-5 sao (Xuat sac)", 2), ("Chua co danh gia", 1),
    }
    assert views.raw_rating_histogram(df).collect()[0]["rating"] == 5.5


def test_stars_truncate_while_the_job_rounds(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.0, 3.5, 4.5, 5.0, 5.5, None)], "rating double")
    assert [tuple(r) for r in views.review_distribution(df).collect()] == [(1, 1), (3, 1), (4, 1), (5, 1)]
    assert as_set(jobs.review_star_distribution_flat(df, "rating")) == {("1 Star", 2), ("4 Stars", 2), ("5 Stars", 2)}


def test_delivery_per_review(spark):
    df = spark.createDataFrame(
        [("Giao hàng nhanh", 5.0), ("giao hang", 4.0), ("a friendship", 3.0), ("great", 2.0), ("", 1.0), (None, 1.0), ("x", None)],
        "comment string, rating double",
    )
    assert as_set(views.delivery_sentiment(df)) == {("Delivery", 4.0, 3), ("Dine-in", 2.0, 1)}


def test_meal_views(spark):
    df = spark.createDataFrame([("Beef", "Thai"), ("Beef", "null"), ("", None), ("Unknown", "Thai")], "category string, area string")
    assert [tuple(r) for r in views.category_frequency(df).collect()] == [("Beef", 2), ("Unknown", 1)]
    assert [tuple(r) for r in views.area_frequency(df).collect()] == [("Thai", 2)]


def test_report_bundle_survives_a_failing_table(spark):
    def missing():
        return spark.table("no_such_table")

    meals = spark.createDataFrame([(f"c{i:02}",) for i in range(30)], "category string")
    bundle = reports.report_bundle(lambda: flat(spark), missing, lambda: meals)
    assert bundle["view_review_distribution"].count() == 0
    assert bundle["view_delivery_sentiment"].count() == 0
    assert bundle["view_cuisine_frequency"].count() == fv.CATEGORY_REPORT_ROWS
    assert bundle["view_rating_by_district"].count() == 1
    assert len(bundle) == 6
    frames = reports.report_frames(bundle)
    assert len(frames["view_cuisine_frequency"]) == 15 and frames["view_review_distribution"].empty


def test_quality(spark):
    got = quality.table_counts({"a": flat(spark), "b": flat(spark).limit(0)})
    assert as_set(got) == {("a", 7, False), ("b", 0, True)}
    assert as_set(quality.parse_ratio(flat(spark))) == {(7, 6, 1 / 7, False)}
    assert as_set(quality.parse_ratio(flat(spark).filter("district_parsed = 'Unknown'"))) == {(1, 0, 1.0, True)}
    assert as_set(quality.parse_ratio(flat(spark).limit(0))) == {(0, 0, None, False)}
    counted, seen = quality.observed(flat(spark), "load", rated=F.col("rating").isNotNull())
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7, "rated": 6}


def test_reports_have_no_python_and_one_exchange_before_sorting(spark, tmp_path):
    flat(spark).write.parquet(str(tmp_path / "r"))
    df = spark.read.parquet(str(tmp_path / "r"))
    plan = plan_of(views.top_districts(df).limit(20))
    assert "TakeOrderedAndProject" in plan and "Python" not in plan
    assert plan.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(district_parsed)" in plan


def walked(text, terms):
    """Counts of whole-word terms, leftmost and longest first, by walking over the pieces of a text."""
    parts = re.findall(r"\w+|\W+", text.lower().strip(" .,"))
    longest, i, found = max(len(t) for t in terms), 0, []
    while i < len(parts):
        n = next((n for n in range(min(longest, len(parts) - i), 0, -1) if tuple(parts[i : i + n]) in terms), 0)
        found += ["".join(parts[i : i + n])] if n else []
        i += max(n, 1)
    return found


@pytest.mark.parametrize("slots", [1 << 17, 1])
def test_any_number_of_phrases(spark, monkeypatch, slots):
    monkeypatch.setattr(terms, "SLOTS", slots)  # with one slot every place meets the dictionary
    rng = random.Random(3)
    words = ["w%d" % i for i in range(60 if slots == 1 else 400)]
    size = 300 if slots == 1 else 100_000
    phrases = {" ".join(rng.choices(words, k=rng.choice([1, 2, 2, 3, 3, 4, 6]))) for _ in range(size)} | {"w1 w2", "w1", "w2 w3 w4"}
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 60))) + rng.choice(["", ".", ", w1 w2 w3 w4"]) for _ in range(300)] + ["", " . ", None, "W1, W2"]
    split = {tuple(re.findall(r"\w+|\W+", p)) for p in phrases}
    want = Counter(t for text in texts for t in walked(text or "", split))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, c string")
    table = spark.createDataFrame([(p,) for p in phrases], "term string")
    for limit in (terms.BROADCAST_BYTES, 0):
        assert as_set(terms.term_match_count_joined(df, "id", "c", table, broadcast_bytes=limit)) == set(want.items())


def test_plan_does_not_grow_with_the_dictionary(spark):
    df = spark.createDataFrame([(1, "a b c")], "id int, c string")

    def size(n, longest):
        table = spark.range(n).select(F.concat(F.lit("w"), F.col("id"), F.repeat(F.lit(" x"), (F.col("id") % longest).cast("int"))).alias("term"))
        plan = terms.term_match_count_joined(df, "id", "c", table, broadcast_bytes=0)._jdf.queryExecution().optimizedPlan()
        return re.sub("[0-9]+", "", plan.toString()).count("\n")

    assert size(10, 3) == size(3000, 40)

def test_long_lists_and_capitals(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, c string")
    phrases = [f"a {i}" for i in range(300)] + DICTIONARY
    assert as_set(terms.term_match_count(df, "c", phrases)) == brute_force(TEXTS, phrases)
    words = [f"a{i}" for i in range(5000)] + ["Soup "]
    assert as_set(terms.term_match_count(df, "c", words)) == {("soup", 5)}
    table = spark.createDataFrame([("SOUP",), ("soup",)], "term string")
    assert as_set(terms.term_match_count_joined(df, "id", "c", table)) == {("soup", 5)}
