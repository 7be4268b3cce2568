import json
from datetime import datetime

import pytest
from helpers import as_set, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens import fixed_values as fv
from venuelens import schemas
from venuelens.operators import tables
from venuelens.plans import ingest, reports, runner, views
from venuelens.session import shared_dir
from venuelens.sources import readers, snapshots, writers
from venuelens.sources import tables as stored
from venuelens.streaming import incremental
from venuelens.streaming.changelog import ChangeLog, Parking

LINES = [
    '{"id": "1", "name": "A", "rating": 4.50, "review_count": "(1,200)", "reviews": [{"user": "u", "rating": 4, "comment": "good beef"}]}',
    "not json", "", "[1, 2]",
    '{"id": "2", "name": "B", "rating": true, "reviews": "oops"}',
    '{"id": "3", "name": "C", "rating": "5 of 5", "district_parsed": "Quận 1", "reviews": null}', "{}",
]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "r.jsonl", "\n".join(LINES))
    got = {r["id"]: r for r in readers.read_json_lines(spark, path, schemas.RESTAURANTS_RAW, sequence=True).collect()}
    assert set(got) == {"1", "2", "3", None}
    assert got["1"]["rating"] == "4.5" and got["1"]["reviews"][0]["rating"] == "4"
    assert got["2"]["rating"] == "true" and got["2"]["reviews"] is None
    df = readers.read_json_lines(spark, path, schemas.RESTAURANTS_RAW)
    assert df.count() == 4 and df.select("rating").count() == 4
    assert "from_json(StructField(rating,StringType,true)" in plan_of(df.select("rating"))


def test_json_lines_are_whole_objects(spark, tmp_path):
    lines = ['{"id": "1"}', '{"id": "2"} trailing', '{"id": "3"', '{"id": "4"},{"id": "5"}', '{"id": "6"}{"id": "7"}', '[{"id": "8"}]', '"x"', " {} ", '{"id": {"a": 1}}']
    path = write(tmp_path / "l.jsonl", "\n".join(lines))
    got = [r["id"] for r in readers.read_json_lines(spark, path, schemas.RESTAURANTS_RAW).collect()]
    assert sorted(got, key=str) == ["1", None, '{"a":1}']


def test_order_over_files(spark, tmp_path):
    small, large = '{"id": "a", "name": "small"}', '{"id": "a", "name": "large"}\n' + "\n".join('{"id": "b%d", "name": "x"}' % i for i in range(5000))
    for names, last in (((small, large), "large"), ((large, small), "small")):
        folder = tmp_path / last
        for i, text in enumerate(names):
            write(folder / f"{i}.jsonl", text)
        lines = readers.read_json_lines(spark, str(folder), schemas.RESTAURANTS_RAW, sequence=True)
        assert tables.latest_by_key(lines.filter("id = 'a'"), "id", ["_seq"]).first()["name"] == last


def test_late_rows_and_old_files(spark, tmp_path):
    kind = "id string, ts int, v string"
    for name, batches in (("one", [[("a", 10, "new"), ("a", 5, "old")]]), ("two", [[("a", 10, "new")], [("a", 5, "old")], [("a", 10, "new")]])):
        for batch in batches:
            incremental.upsert_into(f"late_{name}", spark.createDataFrame(batch, kind), "id", ["ts"], str(tmp_path / name))
        assert as_set(spark.table(f"late_{name}")) == {("a", 10, "new")}
        assert len(list((tmp_path / name).iterdir())) == 1

def test_presence(spark, tmp_path):
    path = write(tmp_path / "p.jsonl", '{"id": "1", "name": null}\nbad\n{"id": "1", "city": "X"}')
    schema = schemas.struct(**{n: schemas.RESTAURANTS[n].dataType for n in ("id", "name", "city")})
    batch = readers.read_documents_with_presence(spark, path, schema)
    assert as_set(batch.select("id", F.array_join("_present", ","))) == {("1", "id,name"), ("1", "id,city")}
    base = spark.createDataFrame([("1", "old", "Y")], schema)
    assert as_set(tables.merge_upsert(base, batch, "id", [])) == {("1", None, "X")}


def test_json_array(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"_id": "x", "name": "A"}, {"_id": "y"}], indent=1))
    assert readers.read_json_array(spark, path, schemas.DOCUMENTS_RAW).count() == 2
    assert readers.read_json_array(spark, str(tmp_path / "none.json"), schemas.DOCUMENTS_RAW) is None
    with pytest.raises(ValueError):
        readers.read_json_array(spark, write(tmp_path / "o.json", '{"_id": "x"}'), schemas.DOCUMENTS_RAW)


def test_import_collection(spark, tmp_path):
    records = [{"_id": "x", "name": "A", "rating": "4.5"}, {"_id": "x", "name": "B"}, {"name": "no id"}]
    path = write(tmp_path / "a.json", json.dumps(records))
    got = ingest.import_collection(spark, path, schemas.DOCUMENTS_RAW, "collection_r")
    assert as_set(got.select("id", "name", "rating")) == {("x", "B", 4.5)}
    assert ingest.import_collection(spark, str(tmp_path / "none"), schemas.DOCUMENTS_RAW, "collection_r") is None


def test_seeds(spark, tmp_path):
    path = write(tmp_path / "areas.json", json.dumps([{"strArea": "Thai", "strCountry": "Thailand"}]))
    assert readers.read_seed(spark, path, schemas.AREAS).count() == 1
    assert readers.read_seed(spark, str(tmp_path / "none.json"), schemas.CATEGORIES).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_seed(spark, str(tmp_path / "none.json"), schemas.MEALS_RAW, required=True)
    writers.save_seed(spark.createDataFrame([("Thai", "Thailand")], schemas.AREAS), str(tmp_path / "out"))
    assert spark.read.schema(schemas.AREAS).json(str(tmp_path / "out")).count() == 1


def test_export_and_publish(spark, tmp_path):
    documents = spark.createDataFrame([(7, "A")], "_id bigint, name string")
    assert as_set(writers.export_documents(documents)) == {("7", "A")}
    prices = spark.createDataFrame([(1,)], "id int").select("id", F.lit("1.50").cast("decimal(9,2)").alias("price"))
    assert as_set(writers.export_table(prices, "meals")) == {(1, 1.5)}
    full = spark.createDataFrame([("1", "$")], "id string, price_range string")
    conformed = schemas.conform(full, schemas.RESTAURANTS, schemas.RESTAURANT_DEFAULTS)
    assert writers.export_table(conformed.withColumn("price_range", F.lit("$")), "restaurants").columns == conformed.columns
    path = str(tmp_path / "lake")
    assert writers.publish_files(documents, path)
    assert not writers.publish_files(documents.limit(0), path)
    assert spark.read.json(path).count() == 1
    assert schemas.conform(conformed, schemas.RESTAURANTS).collect() == conformed.collect()


def test_results_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('say "hi"\t', 4.5, 2), ("b", 1.0, 1)], "k string, avg_rating double, n bigint")
    writers.write_results(df, str(tmp_path / "two"), "k", ["avg_rating", "n"])
    got = dict(as_set(readers.read_results(spark, str(tmp_path / "two"))))
    assert json.loads(got["b"]) == {"avg_rating": 1.0, "n": 1}
    assert 'say "hi"\t' in got
    writers.write_results(df, str(tmp_path / "one"), "k", ["n"])
    assert dict(as_set(readers.read_results(spark, str(tmp_path / "one"))))["b"] == "1"
    path = write(tmp_path / "raw.txt", '"a"\t{"x": 1}\nplain\tnot json\n"q"\t"text"\nno tab')
    assert as_set(readers.read_results(spark, path)) == {("a", '{"x": 1}'), ("plain", "not json"), ("q", "text")}


def lake(spark, root):
    write(root / "restaurants" / "r.jsonl", "\n".join(LINES))
    write(root / "meals" / "m.jsonl", '{"id": "m1", "name": "Pho", "category": "Beef", "area": "Thai", "ingredients": ["a"]}')


def test_run_all(spark, tmp_path):
    lake(spark, tmp_path)
    summaries = runner.run_all(spark, str(tmp_path / "restaurants"), str(tmp_path / "meals"), str(tmp_path / "out"))
    assert {n: c for n, (c, _) in summaries.items()} == {
        "rating_by_area": 0, "tag_count": 2, "rating_bucket": 2, "lexicon_sentiment": 1, "term_match_count": 1,
        "top_reviewed": 1, "review_star_distribution": 1, "delivery_vs_dinein_venue": 1,
    }
    assert as_set(summaries["tag_count"][1]) == {("Beef", "1"), ("Thai", "1")}


def test_run_all_stops_at_the_first_failure(spark, tmp_path):
    lake(spark, tmp_path)
    broken = runner.Job("broken", "meals", lambda df: df.select("no_such_column"), "k", ("v",))
    with pytest.raises(Exception):
        runner.run_all(
            spark, str(tmp_path / "restaurants"), str(tmp_path / "meals"), str(tmp_path / "out"), [broken, *runner.JOBS]
        )
    assert not (tmp_path / "out" / "tag_count").exists()


def test_external_tables_and_views(spark, tmp_path):
    restaurants = spark.createDataFrame([("1", "A", 4.5, 3, "x", "y", "Quận 1", "z")], schemas.RESTAURANTS)
    reviews = spark.createDataFrame([(1, "1", "u", 4.0, "fast delivery")], schemas.REVIEWS)
    meals = spark.createDataFrame([("m1", "Pho", "Beef", "Thai", "i", ["a"])], schemas.MEALS_RAW)
    written = ingest.export_lake(
        {"meals": meals, "restaurants": restaurants.withColumnRenamed("id", "_id")},
        {"restaurants": restaurants, "reviews": reviews, "meals": meals.withColumn("ingredients", F.lit("a")).limit(0)},
        str(tmp_path),
    )
    assert written == {
        "meals": True, "restaurants": True, "mysql_restaurants": True, "mysql_reviews": True, "mysql_meals": False
    }
    (tmp_path / "mysql_meals").mkdir()
    readers.create_external_tables(spark, str(tmp_path), "lake_ext")
    assert spark.table("lake_ext.mongodb_restaurants").columns == schemas.NESTED_RESTAURANTS.fieldNames()
    assert spark.table("lake_ext.mysql_meals").count() == 0
    assert len(views.create_views(spark, "lake_ext")) == 7
    assert as_set(reports.query(spark, "SELECT district, avg_rating, total_count FROM lake_ext.view_rating_by_district")) == {("Quận 1", 4.5, 1)}
    assert as_set(reports.query(spark, "SELECT * FROM lake_ext.view_delivery_sentiment")) == {("Delivery", 4.0, 1)}
    assert as_set(reports.query(spark, "SELECT * FROM lake_ext.view_cuisine_area")) == {("Thai", 1)}
    assert as_set(reports.query(spark, "SELECT name FROM lake_ext.mongodb_restaurants")) == {("A",)}


def test_snapshot_and_restore(spark, tmp_path):
    stored.publish(spark, "snap_a", spark.createDataFrame([(1, "x")], "id int, v string"))
    name, complete, status = snapshots.snapshot(spark, ["snap_a", "snap_missing"], str(tmp_path), datetime(2024, 1, 2, 3, 4, 5))
    assert name == "backup_20240102_030405" and not complete
    assert as_set(status.select("table_name", "saved")) == {("snap_a", True), ("snap_missing", False)}
    stored.publish(spark, "snap_a", spark.createDataFrame([(2, "y"), (3, "z")], "id int, v string"))
    done = snapshots.restore(spark, ["snap_a", "snap_missing"], str(tmp_path), name)
    assert as_set(done) == {("snap_a", True), ("snap_missing", False)}
    assert as_set(spark.table("snap_a")) == {(1, "x")}
    with pytest.raises(FileNotFoundError):
        snapshots.restore(spark, ["snap_a"], str(tmp_path), "backup_none")


ORDER = (T.StructField("seq", T.LongType()),)


def arrive(folder, name, *records):
    write(folder / name, "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def reviews(*users):
    return [{"user": u, "rating": "5", "comment": "c"} for u in users]


def test_arrivals_give_the_rows_of_one_full_load(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    batches = [
        [{"id": "1", "name": "A", "seq": 5, "reviews": reviews("u", "v")}, {"id": "2", "name": "B", "seq": 1, "reviews": reviews("w")}, {"id": "9", "name": "n" * 300, "seq": 1}],
        [{"id": "1", "name": "late", "seq": 2, "reviews": reviews("x")}, {"id": "2", "name": "B2", "seq": 7}, {"id": "", "name": "none", "seq": 1}, '{"id": "4", "na'],
        [{"id": "1", "name": "A", "seq": 5, "reviews": reviews("u", "v")}, {"id": "3", "name": "C", "seq": 1, "reviews": reviews("y", "z" * 300)}, "[1]"],
    ]
    store = incremental.LakeStore(str(tmp_path / "store"), ORDER, buckets=4)
    assert store.table(spark, "reviews").count() == 0 and store.table(spark, "rejects").count() == 0
    told = []
    for n, records in enumerate(batches):
        arrive(folder, f"{n}.jsonl", *records)
        told += incremental.load_new_files(store, spark, str(folder), checkpoint)
    assert incremental.load_new_files(store, spark, str(folder), checkpoint) == []  # nothing new
    assert [t["restaurants"] for t in told] == [
        {"rows": 3, "accepted": 2, "refused": 1, "skipped": 0}, {"rows": 3, "accepted": 2, "refused": 0, "skipped": 1},
        {"rows": 2, "accepted": 2, "refused": 0, "skipped": 0},
    ]
    whole = incremental.LakeStore(str(tmp_path / "whole"), ORDER)
    schema = T.StructType([*schemas.RESTAURANTS_RAW.fields, *ORDER])
    whole.add_documents(readers.read_json_lines(spark, str(folder), schema), 0)
    for _ in range(2):
        for name in ("restaurants", "reviews"):
            assert as_set(store.table(spark, name)) == as_set(whole.table(spark, name))
        assert as_set(store.table(spark, "restaurants").select("id", "name")) == {("1", "A"), ("2", "B2"), ("3", "C")}
        assert sorted(r[0] for r in store.table(spark, "reviews").select("user").collect()) == ["u", "v", "y"]
        rejects = {(r.table, r.key, r._batch): r for r in store.table(spark, "rejects").collect()}
        assert set(rejects) == {("restaurants", "9", 0), ("reviews", "3", 2)}
        assert json.loads(rejects["restaurants", "9", 0].content)["name"] == "n" * 300
        assert store.compact(spark) or store.logs["reviews"].batches(spark) == []


def test_a_repeated_or_unfinished_batch(spark, tmp_path, monkeypatch):
    schema = T.StructType([*schemas.RESTAURANTS_RAW.fields, *ORDER])
    batch = lambda *rows: spark.createDataFrame([(*[r.get(f) for f in schema.fieldNames()],) for r in rows], schema)
    store = incremental.LakeStore(str(tmp_path / "store"), ORDER)
    first = batch({"id": "1", "name": "A", "seq": 1, "reviews": [("u", "5", "c")]})
    store.add_documents(first, 0)
    store.add_documents(first, 0)
    assert store.table(spark, "reviews").count() == 1 and store.table(spark, "restaurants").count() == 1
    second = batch({"id": "1", "name": "A2", "seq": 2, "reviews": [("v", "5", "c"), ("w", "5", "c")]})
    monkeypatch.setattr(incremental.LakeStore, "_refuse", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.add_documents(second, 1)
    assert [r.name for r in store.table(spark, "restaurants").collect()] == ["A"]  # seen as a whole or not at all
    assert store.compact(spark)["reviews"]
    monkeypatch.undo()
    store.add_documents(second, 1)
    assert [r.name for r in store.table(spark, "restaurants").collect()] == ["A2"] and store.table(spark, "reviews").count() == 2
    twice = batch({"id": "1", "name": "A", "seq": 1}, {"id": "1", "name": "B", "seq": 1})
    with pytest.raises(ValueError, match="repeat"):
        incremental.LakeStore(str(tmp_path / "other"), ()).add_documents(twice, 0)


def test_written_bytes_follow_the_batch(spark, tmp_path):
    log = ChangeLog(str(tmp_path / "log"), "k", ("v",), T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()), T.StructField("t", T.StringType())]), 32)
    row = lambda n, v: spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(v).cast("long").alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("t"))
    size = lambda part: {p: (p.stat().st_size, p.stat().st_mtime_ns) for p in (tmp_path / "log" / part).rglob("*.parquet")}
    log.append(row(20000, 1), 0)
    assert len(log.compact(spark)) == 32 and log.batches(spark) == []
    before = size("base")
    log.append(row(2, 2), 1)
    assert sum(s for s, _ in size("changes").values()) < 0.01 * sum(s for s, _ in before.values())
    assert log.current(spark).filter("v = 2").count() == 2 and log.current(spark).count() == 20000
    touched = log.compact(spark)
    assert 1 <= len(touched) <= 2
    after = size("base")
    assert {p.parent.name for p in before if before[p] != after.get(p)} == {f"_bucket={b}" for b in touched}
    assert log.current(spark).filter("v = 2").count() == 2 and log.current(spark).count() == 20000


def test_one_scan_of_the_raw_input(spark, tmp_path):
    write(tmp_path / "in" / "a.jsonl", "\n".join(json.dumps({"id": str(i), "name": "n" * (i % 400), "seq": 1, "reviews": reviews("u")}) for i in range(1000)))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = readers.read_json_lines(spark, str(tmp_path / "in"), schemas.RESTAURANTS_RAW)
    meals = spark.createDataFrame([], schemas.MEALS_RAW)
    outcomes = {}
    counters = ingest.load_documents(spark, raw.mapInArrow(count, raw.schema), meals, "one_scan", (), (), outcomes)
    assert seen.value == 1000 and counters["restaurants"] + counters["skipped"] == 1000
    assert outcomes["restaurants"] == {"rows": 1000, "accepted": counters["restaurants"], "refused": counters["skipped"], "skipped": 0}
    assert spark.table("one_scan.rejects").count() == counters["skipped"] > 0
    stored.wipe(spark, "one_scan")


def test_children_wait_for_their_parents(spark, tmp_path):
    schema = T.StructType([T.StructField("c", T.LongType()), T.StructField("p", T.StringType())])
    parking = Parking(str(tmp_path / "parked"), "c", "p", schema)
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    keys = lambda *ks: spark.createDataFrame([(k,) for k in ks], "id string")
    assert as_set(parking.arrive(frame((1, "a"), (2, "b"), (3, None)), keys("a"), keys("a"), 0)) == {(1, "a")}
    for _ in range(2):  # a repeated batch gives the same
        assert as_set(parking.arrive(frame((4, "c"), (5, "a")), keys("a", "b"), keys("b"), 1)) == {(5, "a"), (2, "b")}
    assert as_set(parking.waiting(spark, 1)) == {(3, None, 1, "no parent p = NULL"), (4, "c", 0, "no parent p = c")}
    assert as_set(parking.arrive(frame(), keys("a", "b"), keys(), 2)) == set()
    assert as_set(parking.waiting(spark, 2).select("c", "age")) == {(3, 2), (4, 1)}


def test_shared_dir_is_below_the_named_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(root)
    assert fv.BACKUP_NAME_PREFIX == "backup_"


def test_change_log(spark, tmp_path):
    log = str(tmp_path / "log")
    base = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    first = spark.createDataFrame([("2", "b1"), ("3", "c1")], "id string, v string")
    second = spark.createDataFrame([("2", "b2")], "id string, v string")
    incremental.append_changes(first, 0, log)
    incremental.append_changes(second, 1, log)
    incremental.append_changes(second, 1, log)  # a repeated batch replaces itself
    changes = spark.read.parquet(log)
    assert changes.count() == 3
    assert as_set(incremental.current_rows(base, changes, "id", [])) == {("1", "a"), ("2", "b2"), ("3", "c1")}


ELEMENTS = [
    {"id": 1, "t": 'a"}{[]\\', "l": []}, {"id": 2, "t": None, "l": [{"v": "}"}, {"v": '"'}]}, {}, {"id": 3, "t": "\\\"},{", "l": [{"v": "x\n\ny"}]}, {"id": 4, "t": "ü日\U0001f600" * 50},
]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split", ["600", "128m"])
def test_large_array_by_byte_ranges(spark, tmp_path, indent, split):
    schema = T.StructType.fromDDL("id int, t string, l array<struct<v:string>>")
    elements = [dict(e, id=e.get("id", 0) + 10 * n) for n in range(20) for e in ELEMENTS]
    write(tmp_path / "in" / "a.json", " \n" + json.dumps(elements, indent=indent, ensure_ascii=False) + "\n")
    write(tmp_path / "in" / "deep" / "b.json", "[]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = readers.read_large_json_array(spark, str(tmp_path / "in"), schema, sequence=True).orderBy("_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(e["id"], e.get("t"), None if e.get("l") is None else [tuple(x.values()) for x in e["l"]]) for e in elements]
    assert [(r.id, r.t, None if r.l is None else [tuple(x) for x in r.l]) for r in got] == want
    assert [r._seq.element for r in got] == list(range(len(elements)))


@pytest.mark.parametrize("text", ['{"id": 1}', '[{"id": 1}', '[{"id": "}"]', '"[{}]"', "x"])
def test_large_array_that_is_none(spark, tmp_path, text):
    with pytest.raises(ValueError, match="array"):
        readers.read_large_json_array(spark, write(tmp_path / "a.json", text), schemas.struct(id=T.StringType()))


def test_large_array_missing_or_empty(spark, tmp_path):
    assert readers.read_large_json_array(spark, str(tmp_path / "none"), schemas.AREAS) is None
    assert readers.read_large_json_array(spark, write(tmp_path / "a.json", "[]"), schemas.AREAS).count() == 0


def test_seed_of_many_rows_is_many_files(spark, tmp_path):
    seed = spark.range(25_000).select(F.concat(F.lit("a"), "id").alias("strArea"), F.lit(None).cast("string").alias("strCountry"))
    writers.save_seed(seed.coalesce(1), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").rglob("*.txt"))) == 3
    assert as_set(readers.read_seed(spark, str(tmp_path / "out"), schemas.AREAS)) == as_set(seed)
