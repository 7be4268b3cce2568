import pytest
from helpers import as_set, plan_of
from pyspark.sql import functions as F

from venuelens import schemas
from venuelens.operators import normalize, pages, tables
from venuelens.plans import ingest
from venuelens.sources import tables as stored


def rows(spark, data, ddl="id string, a string, b int"):
    return spark.createDataFrame(data, ddl)


def test_replace_upsert_is_idempotent(spark):
    base = rows(spark, [("1", "x", 1), ("2", "y", 2)])
    batch = rows(spark, [("2", "new", None, 1), ("2", "newer", 5, 2), ("3", "z", 3, 1)], "id string, a string, b int, seq int")
    once = tables.replace_upsert(base, batch, "id", ["seq"])
    assert as_set(once) == {("1", "x", 1), ("2", "newer", 5), ("3", "z", 3)}
    assert as_set(tables.replace_upsert(once, batch, "id", ["seq"])) == as_set(once)


def test_latest_by_key_ranks_before_the_shuffle(spark):
    df = rows(spark, [("1", "x", i) for i in range(10)])
    plan = plan_of(tables.latest_by_key(df, "id", ["b"]))
    assert plan.count("WindowGroupLimit") == 2


def test_merge_upsert_knows_absent_from_null(spark):
    base = rows(spark, [("1", "x", 1), ("2", "y", 2)])
    batch = rows(
        spark,
        [("1", None, None, 1, ["a"]), ("2", "q", 7, 1, ["a", "b"]), ("2", None, None, 2, ["b"]), ("3", "n", 9, 1, ["a"])],
        "id string, a string, b int, seq int, _present array<string>",
    )
    merged = tables.merge_upsert(base, batch, "id", ["seq"])
    assert as_set(merged) == {("1", None, 1), ("2", "q", None), ("3", "n", None)}
    assert as_set(tables.merge_upsert(merged, batch, "id", ["seq"])) == as_set(merged)


def test_merge_upsert_without_list_takes_the_columns(spark):
    base = rows(spark, [("1", "x", 1)])
    merged = tables.merge_upsert(base, rows(spark, [("1", None), ("2", "n")], "id string, a string"), "id", [])
    assert as_set(merged) == {("1", None, 1), ("2", "n", None)}


def test_insert(spark):
    base = rows(spark, [("1", "x", 1)])
    assert tables.insert_rows(base, rows(spark, [("2", "y", 2)]), "id").count() == 2
    with pytest.raises(ValueError, match="'1'"):
        tables.insert_rows(base, rows(spark, [("1", "y", 2)]), "id")
    with pytest.raises(ValueError, match="'2'"):
        tables.insert_rows(base, rows(spark, [("2", "y", 2), ("2", "z", 2)]), "id")


def test_patch(spark):
    base = rows(spark, [("1", "x", 1), ("2", "y", 2)])
    patch = rows(spark, [("1", "", 9), ("9", "q", 1)])
    assert as_set(tables.patch_rows(base, patch, "id")) == {("1", "x", 9), ("2", "y", 2)}
    assert as_set(tables.patch_rows(base, rows(spark, [("2", "new", 0)]), "id")) == {("1", "x", 1), ("2", "new", 2)}
    assert as_set(tables.affected_rows(base, patch, "id")) == {("1",)}
    assert tables.affected_rows(base, rows(spark, [("7", "", 0)]), "id").isEmpty()


def test_delete_and_parents(spark):
    parents = rows(spark, [("1", "x", 1), ("2", "y", 2)])
    children = spark.createDataFrame([(1, "1"), (2, "2"), (3, "9")], "id int, restaurant_id string")
    left, kids = tables.delete_rows(parents, children, spark.createDataFrame([("1",)], "id string"))
    assert as_set(left) == {("2", "y", 2)} and as_set(kids) == {(2, "2"), (3, "9")}
    kept, orphans = tables.check_parents(children, parents)
    assert as_set(kept) == {(1, "1"), (2, "2")} and as_set(orphans) == {(3, "9")}


def test_search(spark):
    df = spark.createDataFrame(
        [(f"r{i:03}", f"Quán {i}", "Quận 1" if i % 2 else "100%", "x") for i in range(50)],
        "id string, name string, district string, district_parsed string",
    )
    assert [r["id"] for r in tables.search(df, "QUAN 1", size=10).collect()][:3] == ["r001", "r003", "r005"]
    assert tables.search(df, "100%", size=100).count() == 25
    assert tables.search(df, "1__", size=100).count() == 0
    second = [r["id"] for r in tables.search(df, "", page=2, size=10).collect()]
    assert second == [f"r{i:03}" for i in range(10, 20)]
    assert [r["id"] for r in tables.search(df, "", size=10, after="r009").collect()] == second
    with pytest.raises(ValueError):
        tables.search(df, size=0)
    assert tables.search(df, size=7).count() == 7
    assert tables.sample_head(df).count() == 20


RAW = {
    "id": "https://x.example/Restaurant_Review-g293925-d33215720-Reviews-Bun_Cha.html", "name": "Bún Chả", "rating": "4.5",
    "review_count": "(112)", "address": "18B/17 Đ. Nguyễn Thị Minh Khai Quận 1, Ho Chi Minh City 70000 Vietnam",
    "district": "18B/17 Đ. Nguyễn Thị Minh Khai Quận 1", "city": "Ho Chi Minh City 70000 Vietnam",
    "reviews": [("Chloe C", "5 of 5 bubbles", "Excellent food"), ("Fearless", "4 of 5 bubbles", "")],
}


def raw(spark, records, extra=""):
    names = schemas.RESTAURANTS_RAW.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schemas.RESTAURANTS_RAW)


def test_clean_restaurant_golden(spark):
    row = normalize.clean_restaurants(raw(spark, [RAW])).collect()[0]
    assert (row["id"], row["rating"], row["review_count"]) == ("rest_d33215720", 4.5, 112)
    assert (row["district_parsed"], row["city"]) == ("Quận 1", "Ho Chi Minh City")
    assert [tuple(r) for r in row["reviews"]] == [("Chloe C", 5.0, "Excellent food"), ("Fearless", 4.0, None)]
    assert normalize.clean_restaurants(raw(spark, [RAW]), literal=True).collect()[0]["district_parsed"] == "Unknown"


def test_normalize(spark):
    records = [
        RAW,
        {"id": "r2", "name": "", "rating": "abc", "review_count": None, "address": None, "district": "Quận 2", "city": None},
        {"id": "", "name": "gone"}, {"id": None, "name": "gone"},
        {"id": "r3", "name": "n" * 256, "reviews": [("u", "1", "lost with its parent")]},
        {"id": "r4", "name": "ok", "review_count": "99999999999"},
        {"id": "r5", "name": "n" * 255, "address": "a" * 501, "city": "HCMC"},
        {"id": "r7", "name": "ok", "address": "a" * 101},
        {"id": "r6", "name": "ok", "reviews": [("u" * 256, "1", "x"), ("v", "2", "y")]},
    ]
    meals = spark.createDataFrame(
        [("m1", "Pho", None, "", "cook", ["a", "", "b"]), ("m2", None, "c", "a", "i", []), (None, "x", "c", "a", "i", []),
         ("m3", "Bun", "c" * 101, "a", "i", None)],
        schemas.MEALS_RAW,
    )
    result = normalize.normalize(raw(spark, records), meals)
    assert result.restaurants.columns == schemas.RESTAURANTS.fieldNames()
    assert result.restaurants.schema["review_count"].dataType.simpleString() == "int"
    by_id = {r["id"]: r for r in result.restaurants.collect()}
    assert set(by_id) == {"rest_d33215720", "r2", "r6"}
    assert tuple(by_id["r2"]) == ("r2", "Unnamed Restaurant", None, 0, "Quận 2", "Quận 2", "Quận 2", "Quận 2")
    assert as_set(result.reviews.drop("id")) == {
        ("rest_d33215720", "Chloe C", 5.0, "Excellent food"), ("rest_d33215720", "Fearless", 4.0, None), ("r6", "v", 2.0, "y")
    }
    assert as_set(result.meals) == {("m1", "Pho", "Unknown", "Unknown", "cook", "a, b")}
    assert as_set(result.rejects) == {
        ("restaurants", "r3", "name longer than 255"), ("restaurants", "r4", "review_count out of range"),
        ("restaurants", "r5", "address longer than 500"), ("restaurants", "r7", "city longer than 100"), ("reviews", "r6", "user longer than 255"),
        ("meals", "m3", "category longer than 100"),
    }
    assert "Python" not in plan_of(result.restaurants) and "Python" not in plan_of(result.reviews)


def test_last_accepted_document_wins(spark):
    records = [dict(RAW, name="first"), dict(RAW, name="second"), dict(RAW, name="x" * 300)]
    df = raw(spark, records).withColumn("seq", F.monotonically_increasing_id())
    split = normalize.restaurant_documents(df, ["seq"])
    assert [r["name"] for r in normalize.restaurants_table(split.accepted).collect()] == ["second"]
    assert normalize.reviews_table(split.accepted).accepted.count() == 2


def test_recipes(spark):
    wide = {f.name: None for f in schemas.RECIPES_RAW.fields}
    recipes = spark.createDataFrame(
        [tuple(dict(wide, idMeal="7", strMeal="Pho", strIngredient1=" Beef ", strIngredient2=" ", strIngredient20="Lime").values()),
         tuple(dict(wide, strMeal="no id").values())],
        schemas.RECIPES_RAW,
    )
    parsed = normalize.parse_meals(recipes)
    assert as_set(parsed.select("id", "name", F.array_join("ingredients", "|"))) == {("meal_7", "Pho", "Beef|Lime")}
    collection = spark.createDataFrame([("meal_7", "Old", "x", "y", "z", ["q"]), ("meal_1", "M", "x", "y", "z", [])], schemas.MEALS_RAW)
    merged = {r["id"]: r for r in ingest.ingest_meals(collection, recipes).collect()}
    assert merged["meal_7"]["name"] == "Pho" and merged["meal_7"]["area"] == "Unknown" and len(merged) == 2


def test_publish_replaces_a_table_read_by_its_own_input(spark):
    stored.publish(spark, "t_pub", rows(spark, [("1", "x", 1)]))
    stored.publish(spark, "t_pub", spark.table("t_pub").withColumn("b", F.col("b") + 1))
    stored.publish(spark, "t_pub", spark.table("t_pub").withColumn("b", F.col("b") + 1))
    assert as_set(spark.table("t_pub")) == {("1", "x", 3)}
    assert len(stored._versions(spark, "t_pub")) == 1


def test_create_evolve_load_wipe(spark):
    names = stored.create_tables(spark, "lake_test")
    assert names == ["lake_test.restaurants", "lake_test.reviews", "lake_test.meals"]
    old = rows(spark, [("old", 3.5, "$$")], "id string, rating double, price_range string")
    stored.publish(spark, "lake_test.restaurants", old)
    stored.evolve_tables(spark, "lake_test")
    assert spark.table("lake_test.restaurants").columns == schemas.RESTAURANTS.fieldNames()
    assert spark.table("lake_test.restaurants").collect()[0]["district_parsed"] == "Unknown"
    meals = spark.createDataFrame([("m1", "Pho", None, "", "cook", ["a"])], schemas.MEALS_RAW)
    long_name = {"id": "bad", "name": "n" * 300}
    for _ in range(2):
        counters = ingest.load_documents(spark, raw(spark, [RAW, long_name]), meals, "lake_test", (), ())
        assert counters == {"restaurants": 1, "reviews": 2, "meals": 1, "skipped": 1}
        assert {r["id"] for r in spark.table("lake_test.restaurants").collect()} == {"old", "rest_d33215720"}
        assert spark.table("lake_test.reviews").count() == 2
    stored.wipe(spark, "lake_test")
    assert not spark.catalog.databaseExists("lake_test")
    stored.create_tables(spark)
    stored.wipe(spark)
    assert not spark.catalog.tableExists("restaurants")


# --- pages -----------------------------------------------------------------------

PAGE = """<html><body><h1>Bún Chả <b>HN</b></h1><p class="rate">4.5</p><a class="n">(112)</a>
<button><span>12 Main, Foo, Bar</span></button>
<div data-automation="reviewCard"><a href="/Profile/ann">Ann</a><svg aria-label="logo"></svg>
 <svg><title>5 of 5 bubbles</title></svg><span data-automation="reviewText"><div>Good<br>food &amp; tea</div> now</span></div>
<div data-automation="reviewCard"><span data-automation="reviewText">  </span></div>
<div data-automation="reviewCard"><a href="/Profile/bob"> Bob </a></div></body></html>"""
RULES = pages.PageRules(
    card=pages.Rule("div", "data-automation", "reviewCard"), user=pages.Rule("a", "href", "/Profile/"),
    comment=pages.Rule("span", "data-automation", "reviewText"), rating=pages.Rule("p", "class", "rate"),
    review_count=pages.Rule("a", "class", "n"), address=pages.Rule("button"),
)


def test_extract_pages(spark):
    df = spark.createDataFrame([(1, "u1", PAGE), (2, "u2", ""), (3, "u3", None)], "page_id int, url string, html string")
    got = {r["page_id"]: r for r in pages.extract_pages(df, RULES).collect()}
    first = got[1]
    assert (first["name"], first["rating"], first["review_count"]) == ("Bún Chả", "4.5", "(112)")
    assert (first["district"], first["city"], first["cards"]) == ("Foo", "Bar", 3)
    assert [tuple(r) for r in first["reviews"]] == [("Ann", "5 of 5 bubbles", "Good\nfood & tea\nnow"), ("Bob", None, None)]
    assert got[2]["reviews"] == [] and got[3]["name"] is None


def test_merge_pages(spark):
    kind = "id string, offset int, name string, reviews array<struct<user:string,rating:string,comment:string>>"
    r = lambda i: (f"u{i}", "5", f"c{i}")
    df = spark.createDataFrame(
        [("a", 15, "later", [r(3)]), ("a", 0, "first", [r(1), r(2)]), ("b", 0, "b", []), ("c", 0, "c", [r(i) for i in range(80)])], kind
    )
    assert {x["id"]: len(x["reviews"]) for x in pages.merge_pages(df, header=["name"]).collect()} == {"a": 3, "b": 0, "c": 80}
    got = {x["id"]: x for x in pages.merge_pages(df, header=["name"], max_reviews=75).collect()}
    assert got["a"]["name"] == "first" and [x["user"] for x in got["a"]["reviews"]] == ["u1", "u2", "u3"]
    assert got["b"]["reviews"] == [] and len(got["c"]["reviews"]) == 75
    assert pages.page_reviews(df).count() == 83


def test_unseen_links(spark):
    links = spark.createDataFrame([("http://a/1",), ("http://A/1",), ("http://b",), ("http://c",)], "url string")
    seen = pages.unseen_links(links.filter("url = 'http://c'"), spark.createDataFrame([], "fingerprint string"))
    assert {r["url"] for r in pages.unseen_links(links, seen).collect()} == {"http://A/1", "http://b"}
