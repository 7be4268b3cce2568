"""Numbers, links and backups that go on over runs."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from helpers import as_set, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuelens.operators.keys import DenseKeys
from venuelens.operators.seen import SeenLinks
from venuelens.sources import snapshots

KEY = T.StructType([T.StructField("r", T.StringType()), T.StructField("pos", T.IntegerType())])


def test_numbers_have_no_gaps_over_loads(spark, tmp_path):
    numbers = DenseKeys(str(tmp_path / "keys"), KEY)
    rows = lambda *pairs: spark.createDataFrame([(*p, "x") for p in pairs], "r string, pos int, other string")
    assert numbers.assign(rows(), 0).count() == 0
    first = numbers.assign(rows(("b", 1), ("a", 2), ("a", 2), ("a", 10), (None, 1)), 1)
    assert sorted(map(tuple, first.collect()), key=str) == [("a", 10, "x", 1), ("a", 2, "x", 0), ("a", 2, "x", 0), ("b", 1, "x", 2), (None, 1, "x", None)]
    again = as_set(numbers.assign(rows(("c", 0), ("a", 10), ("", 5)), 2))
    assert again == {("a", 10, "x", 1), ("", 5, "x", 3), ("c", 0, "x", 4)}
    assert as_set(numbers.assign(rows(("c", 0), ("a", 10), ("", 5)), 2)) == again  # the load repeated
    many = spark.range(5000).select(F.lit("hot").alias("r"), F.col("id").cast("int").alias("pos"))
    assert numbers.assign(many, 3).agg(F.min("number"), F.max("number"), F.countDistinct("number")).first() == (5, 5004, 5000)
    assert "SinglePartition" not in plan_of(numbers.known(spark))
    total = numbers.known(spark).agg(F.count("*"), F.countDistinct("number"), F.max("number") - F.min("number") + 1).first()
    assert total == (5005, 5005, 5005)


@pytest.mark.parametrize("words", [1, 1 << 10])  # a sketch of one word says "maybe" to all
def test_crawls_give_the_links_of_an_anti_join(spark, tmp_path, words):
    chance, met = random.Random(3), set()
    seen = SeenLinks(str(tmp_path / "seen"), buckets=4, words=words)
    for crawl in range(3):
        urls = [f"https://x.example/{'P' if chance.random() < 0.3 else 'p'}{chance.randrange(60)}" for _ in range(50)]
        links = spark.createDataFrame([(u,) for u in urls] + [(None,), ("",)], "url string")
        want = {}
        for u in [*urls, ""]:
            if u.lower() not in met:
                want[u.lower()] = min(u, want.get(u.lower(), u))
        for _ in range(2 if crawl == 1 else 1):  # a repeated crawl gives the same
            assert {r.url for r in seen.new_links(links, crawl).collect()} == set(want.values())
        met |= set(want)
    assert seen.new_links(spark.createDataFrame([], "url string"), 3).count() == 0


def test_only_buckets_with_possible_hits_are_read(spark, tmp_path):
    seen = SeenLinks(str(tmp_path / "seen"), buckets=32, words=1 << 10)
    links = spark.range(4000).select(F.concat(F.lit("https://x.example/"), "id").alias("url"))
    assert seen.new_links(links, 0).count() == 4000
    once = links.limit(0).unionByName(spark.createDataFrame([("https://x.example/7",), ("https://y.example/1",)], "url string"))
    assert [r.url for r in seen.new_links(once, 1).collect()] == ["https://y.example/1"]
    keyed = spark.createDataFrame([(f"{i:040x}",) for i in range(200)], "fingerprint string").withColumn("_bucket", F.lit(3))
    assert seen._maybe(keyed, 1).count() < 20  # links never met


def test_a_second_backup_writes_what_has_changed(spark, tmp_path):
    root, day = str(tmp_path / "backups"), datetime(2024, 5, 1, tzinfo=timezone.utc)
    rows = spark.range(1000).select("id", F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") % 3 > 0, F.col("id") / 2).alias("v"))
    states = [rows, rows.filter("id <> 11").withColumn("name", F.when(F.col("id") == 7, "new").otherwise(F.col("name"))), rows, rows.filter("id < 0"), rows.withColumn("more", F.lit(1))]
    names, written = [], []
    for n, state in enumerate(states):
        state.createOrReplaceTempView("kept_table")
        name, whole, report = snapshots.incremental_snapshot(spark, {"kept_table": ["id"], "no_such_table": []}, root, 16, day + timedelta(days=n))
        by_name = {r.table_name: r for r in report.collect()}
        assert not whole and not by_name["no_such_table"].saved and by_name["kept_table"].saved
        names.append(name)
        written.append((by_name["kept_table"].written, by_name["kept_table"].shared))
    assert written[0] == (16, 0) and sum(written[1]) == 16 and 1 <= written[1][0] <= 2
    assert written[2:] == [(0, 16), (0, 0), (16, 0)]  # back as it was; empty; another shape
    for name, state in zip(names, states):
        assert as_set(snapshots.snapshot_rows(spark, root, name, "kept_table")) == as_set(state)
    spark.catalog.dropTempView("kept_table")
    done = snapshots.restore_incremental(spark, ["kept_table", "no_such_table"], root, names[1], str(tmp_path / "tables"))
    assert as_set(done) == {("kept_table", True), ("no_such_table", False)}
    assert as_set(spark.table("kept_table")) == as_set(states[1])
    with pytest.raises(FileNotFoundError):
        snapshots.restore_incremental(spark, ["kept_table"], root, "backup_of_no_day")


def test_a_damaged_part_is_found(spark, tmp_path):
    root = str(tmp_path / "backups")
    spark.range(50).createOrReplaceTempView("whole_table")
    name, _, _ = snapshots.incremental_snapshot(spark, {"whole_table": []}, root, 4)
    one = next((tmp_path / "backups" / "parts").rglob("*.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "other"))
    one.write_bytes(next((tmp_path / "other").glob("*.parquet")).read_bytes())
    (one.parent / f".{one.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="not those"):
        snapshots.snapshot_rows(spark, root, name, "whole_table")
