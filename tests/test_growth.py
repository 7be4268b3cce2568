"""Work that a row, a page or a piece costs: what is done once stays done once."""

from helpers import as_set, evaluate, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.operators import pages
from venuelens.sources import readers
from venuelens.streaming import grams


def test_a_line_is_parsed_once_and_judged_as_before(spark):
    lines = spark.createDataFrame([('{"a": 1}',)], "value string")
    judged = lines.select(readers._is_whole_object(F.col("value")).alias("x"))
    assert plan_of(judged).count("parseJson") == 1
    good = ["{}", ' {"a": 1}\t', '{"a": [{"b": "]}"}, null]}', '{"a": {"b": []}}']
    bad = ["", "[{}]", "{},", "{},{}", "{},null", '{"a": 1} x', '{"a": "b', '{"a": [1, 2]', "{'a': 1}", "null", "1", '"{}"', " {}", '{"a": 1, "a": 2}', None]
    assert evaluate(spark, readers._is_whole_object(F.col("v")), good + bad) == [True] * len(good) + [False] * len(bad)


def test_a_text_is_folded_once_for_its_trigrams(spark, tmp_path):
    index = grams.GramIndex(str(tmp_path / "names"), "id", ("name",))
    rows = spark.createDataFrame([("a", "Phở Đỏ"), ("b", "x​y"), ("c", None), ("d", "𝒜bc")], "id string, name string")
    posted = index._postings(rows, F.lit(0))
    text = F.col("id").cast("string")
    folds, plains = (plan_of(spark.range(1).select(x.alias("x"))).count("translate(") for x in (grams._folded(text), grams._plain(text)))
    assert plains == 1 and plan_of(posted).count("translate(") == folds + plains
    assert as_set(posted.select("id", "gram")) == {("a", "pho"), ("a", "ho "), ("a", "o d"), ("a", " do"), ("b", grams.ANY), ("d", grams.ANY)}


def test_texts_of_a_large_array_are_scanned_once_after_the_cut(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"id": 1, "t": "}{[\\""}, 7, {"id": 2, "t": "x", "l": [{"v": "]"}]}]')
    (tmp_path / "in" / "b.json").write_text(" [ ]\n")
    schema = T.StructType.fromDDL("id long, t string")
    found = readers.read_large_json_array(spark, str(tmp_path / "in"), schema, sequence=True)
    assert plan_of(found).count("FileScan") == 2  # the pieces, and the sums at the start of each split
    assert as_set(found.select("id", "t", "_seq.element")) == {(1, '}{["', 0), (2, "x", 1)}


def test_a_worker_gets_few_pages_at_a_time_and_parses_each_once(spark):
    html = "<h1>Place</h1><li><a>me</a></li><li><a>you</a></li>"
    stored = spark.createDataFrame([(1, "u1", html), (2, "u2", None)], "page_id long, url string, html string")
    rules = pages.PageRules(card=pages.Rule("li"), user=pages.Rule("a"), comment=pages.Rule("h6"))
    cards = pages.extract_pages(stored, rules).select("page_id", "name", "cards", F.explode("reviews").alias("r")).select("page_id", "name", "cards", "r.user")
    plan = plan_of(cards)
    assert "MapInPandas" not in plan and "Arrow" not in plan and plan.count("BatchEvalPython") == 1
    assert as_set(cards) == {(1, "Place", 2, "me"), (1, "Place", 2, "you")}
    assert as_set(pages.extract_pages(stored, rules).select("page_id", "name", "cards")) == {(1, "Place", 2), (2, None, 0)}
