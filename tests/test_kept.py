"""What follows a table's change log batch by batch: counts behind the views, postings behind the search."""

import random

import pytest
from helpers import as_set, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens import schemas
from venuelens.operators import tables
from venuelens.plans import reports, views
from venuelens.streaming import incremental
from venuelens.streaming.changelog import SIGN, ChangeLog
from venuelens.streaming.counts import ROWS

ORDER = (T.StructField("seq", T.LongType()),)
RAW = T.StructType([*schemas.RESTAURANTS_RAW.fields, *ORDER])
NAMES = ["Phở Hà Nội", "pho ha noi 24", "Straße ﬁn", "Café Đỏ", "", None, "Bún chả", "ÆTHER Bar", "Ａbc quán", "x​y pho", "100% \\\\ [a] 'q'"]


def documents(spark, rows):
    return spark.createDataFrame([tuple(r.get(f) for f in RAW.fieldNames()) for r in rows], RAW)


def made(chance, seq):
    """One document whose fields are drawn; some without reviews, some refused."""
    texts = ["giao hàng nhanh", "ship tận nơi", "ngon", "", None]
    reviews = [{"user": "u", "rating": chance.choice(["1", "4.5 of 5", "5", None]), "comment": chance.choice(texts)} for _ in range(chance.randrange(3))]
    return {
        "id": f"r{chance.randrange(12)}", "name": "n" * 300 if chance.random() < 0.1 else chance.choice(NAMES), "seq": seq,
        "rating": chance.choice(["3", "4.5", "2.5", None]), "district": chance.choice(["Quận 1", "Quận 10", "unknown", "Thủ Đức"]), "reviews": reviews,
    }


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Four batches, late and repeated rows, a batch given twice, a compaction between them."""
    chance = random.Random(5)
    order = list(range(60))
    chance.shuffle(order)
    store = incremental.LakeStore(str(tmp_path_factory.mktemp("kept") / "store"), ORDER, buckets=4)
    seen = []
    for number in range(4):
        rows = [made(chance, seq) for seq in order[number * 15:(number + 1) * 15]]
        batch = documents(spark, rows + (seen[:3] if number else []))
        seen += rows
        store.add_documents(batch, number)
        if number == 1:
            store.compact(spark)
            store.add_documents(batch, number)  # repeated after its rows have come to the base
        check_views(spark, store)
    return store


def check_views(spark, store):
    restaurants, reviews = store.table(spark, "restaurants"), store.table(spark, "reviews")
    kept, kept_reviews = store.counted(spark, "restaurants"), store.counted(spark, "reviews")
    for view in (views.rating_by_district, views.rating_histogram, views.top_districts, views.raw_rating_histogram, views.best_districts):
        assert view(kept, weight=ROWS).collect() == view(restaurants).collect()
    assert views.review_distribution(kept_reviews, weight=ROWS).collect() == views.review_distribution(reviews).collect()
    assert as_set(views.delivery_sentiment(kept_reviews, weight=ROWS)) == as_set(views.delivery_sentiment(reviews))
    assert kept.filter(F.col(ROWS) < 0).count() == 0
    assert kept.agg(F.sum(ROWS)).first()[0] == restaurants.count()


def test_views_follow_each_batch(spark, store):
    bundle = reports.kept_bundle(spark, store)
    whole = reports.report_bundle(*[lambda n=n: store.table(spark, n) for n in ("restaurants", "reviews", "meals")])
    assert {n: as_set(df) for n, df in bundle.items()} == {n: as_set(df) for n, df in whole.items()}
    assert "/restaurants/" not in plan_of(bundle["view_top_districts"]).replace("/counts/restaurants/", "")


def test_a_fold_and_a_new_count_change_nothing(spark, store):
    before = as_set(store.counted(spark, "restaurants"))
    store.compact(spark)
    assert as_set(store.counted(spark, "restaurants")) == before
    store.recount(spark)
    store.recount(spark)
    assert as_set(store.counted(spark, "restaurants")) == before


def test_changes_read_the_buckets_of_the_batch(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType()), T.StructField("t", T.StringType())])
    log = ChangeLog(str(tmp_path / "log"), "k", ("v",), schema, 32)
    rows = lambda low, high, v: spark.range(low, high).select(F.col("id").alias("k"), F.lit(v).cast("long").alias("v"), F.lit("t" * 50).alias("t"))
    log.append(rows(0, 500, 1), 0)
    assert log.changed(spark, 0, F.col("k")).agg(F.sum(SIGN)).first()[0] == 500
    log.compact(spark)
    log.append(rows(7, 8, 2).unionByName(rows(600, 601, 2)), 1)
    changed = log.changed(spark, 1, F.col("k"), F.col("v"))
    assert as_set(changed) == {(7, 2, 1), (7, 1, -1), (600, 2, 1)}
    log.append(rows(7, 8, 0), 2)  # late: older than what is there
    assert changed.sparkSession and log.changed(spark, 2, F.col("k")).count() == 0
    scans = [f for f in log.changed(spark, 1, F.col("k")).inputFiles() if "/base/" in f]
    assert "t" not in [c for c in log.changed(spark, 1, F.col("k"))._jdf.queryExecution().optimizedPlan().collectLeaves().head().output().mkString(",").split(",")]
    assert scans


TERMS = ["PHỞ", "ss", "strasse", "fin", "cafe", "đỏ", "quan 1", "aether", "abc", "xy", "\\", "phở hà nội"]


def test_search_by_postings_finds_what_a_scan_finds(spark, store):
    whole = store.table(spark, "restaurants")
    hits = 0
    for term in TERMS:
        want = as_set(tables.search(whole, term, size=10_000))
        assert as_set(store.search(spark, term)) == want, term
        hits += len(want)
    assert hits > 10
    store.reindex(spark)
    for term in ("pho", "strasse"):
        assert as_set(store.search(spark, term)) == as_set(tables.search(whole, term, size=10_000)), term


def test_a_search_reads_parts_of_the_postings_and_buckets_of_the_table(spark, store):
    found = store.names.candidates(spark, "ha noi", 3)
    assert "PartitionFilters: [isnotnull(_batch" in plan_of(found) and "_part" in plan_of(found)
    assert store.names.candidates(spark, "ab", 3) is None and store.names.candidates(spark, "日本語", 3) is None
    one = store.logs["restaurants"].current_of(spark, store.table(spark, "restaurants").limit(1).select("id", store.logs["restaurants"].bucket().alias("_bucket")), 3)
    assert one.count() == 1 and "_bucket" in plan_of(one)
    assert incremental.LakeStore(store.root + "-none", ORDER).search(spark, "pho").count() == 0
