"""Raw documents to stored tables and lake files in one go (R8 with R4/R5, R9, S4-S6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import is_present
from ..operators import normalize as norm
from ..operators.outcomes import needs_order, sort_out
from ..operators.quality import observed
from ..operators.tables import latest_by_key, merge_upsert
from ..session import shared_dir
from ..sources import readers, writers
from ..sources.tables import create_tables, evolve_tables, publish


def load_documents(
    spark: SparkSession,
    restaurants_raw: DataFrame,
    meals_raw: DataFrame,
    database: str | None,
    order: Sequence[str],
    meals_order: Sequence[str],
    outcomes: dict[str, dict[str, int]] | None = None,
) -> dict[str, int]:
    """Upsert restaurants and meals, reload reviews. Returns the load counters.

    The orders tell which of several documents of an id is the last; empty ones say that ids do not repeat, and it is an
    error if they do. Each raw input is read once: its rows are marked, written by outcome to the shared folder, and the
    tables, the refused rows and all counters derive from there. Refused rows are added to the table ``rejects`` with
    their table, key, reason and content. ``outcomes`` is filled with the rows read, accepted, refused and skipped (no
    id, or a meal without a name) of each table.
    """
    prefix = f"{database}." if database else ""
    create_tables(spark, database)
    evolve_tables(spark, database)
    counters, told = {}, {} if outcomes is None else outcomes

    def store(table: str, batch: DataFrame, keys: DataFrame | None = None) -> None:
        counted, seen = observed(batch, f"load_{table}")
        if keys is not None:  # R2: the batch is unique by id already
            counted = spark.table(prefix + table).join(keys, "id", "left_anti").unionByName(counted)
        publish(spark, prefix + table, counted)
        counters[table] = seen.get["rows"]

    found = sort_out(norm.mark_restaurants(restaurants_raw, order), "restaurants", "id")
    needs_order(found.accepted, "id", order, "restaurants")
    folder = shared_dir(spark, "documents")
    norm.latest_documents(found.accepted, order).write.parquet(folder)
    documents = spark.read.parquet(folder)
    reviews = sort_out(norm.mark_reviews(documents), "reviews", "restaurant_id")
    meals = sort_out(norm.mark_meals(meals_raw, meals_order), "meals", "id")
    needs_order(meals.accepted, "id", meals_order, "meals")
    latest = latest_by_key(meals.accepted, "id", meals_order).select(*schemas.MEALS.fieldNames())
    store("restaurants", norm.restaurants_table(documents), documents.select("id"))
    store("reviews", norm.stored_reviews(reviews.accepted))  # R4: reloaded as a whole
    store("meals", latest, latest.select("id"))
    parts = {"restaurants": found, "reviews": reviews, "meals": meals}
    told.update({table: part.counters for table, part in parts.items()})
    refused = found.refused.unionByName(reviews.refused).unionByName(meals.refused)
    refused.withColumn("loaded", F.current_timestamp()).write.mode("append").saveAsTable(f"{prefix}rejects")
    counters["skipped"] = sum(part.counters["refused"] for part in parts.values())
    return counters


def ingest_meals(collection: DataFrame, recipes: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Wide recipe records into the meal collection, field by field."""
    cleaned = norm.clean_meals(norm.parse_meals(recipes))
    return merge_upsert(collection, cleaned, "id", order)


def store_meals(spark: SparkSession, recipes: DataFrame, name: str, order: Sequence[str] = ()) -> dict[str, int]:
    """R9 into a stored collection, created by the first call. Returns the counters (V13): records read, merged into
    the collection, and skipped for lack of an id; all from the one pass that writes."""
    there = is_present(F.col("idMeal"))
    counted, seen = observed(recipes, f"store_{name}", merged=F.coalesce(there, F.lit(False)), skipped=~F.coalesce(there, F.lit(False)))
    folder = shared_dir(spark, "recipes")
    norm.clean_meals(norm.parse_meals(counted)).select(*schemas.MEALS_RAW.fieldNames(), *order).write.parquet(folder)
    cleaned = spark.read.parquet(folder)
    needs_order(cleaned, "id", order, "recipes")
    collection = spark.table(name) if spark.catalog.tableExists(name) else cleaned.select(*schemas.MEALS_RAW.fieldNames()).limit(0)
    publish(spark, name, merge_upsert(collection, cleaned, "id", order))
    return dict(seen.get)


def import_collection(spark: SparkSession, path: str, schema, name: str, counters: dict[str, int] | None = None) -> DataFrame | None:
    """Replace a document collection by a cleaned array file; None when there is no file.

    Records of one id are merged field by field: the last one that has a field gives it, where an explicit null counts
    like a missing field. ``counters`` is filled with the records read, merged, and skipped for lack of an id (V13).
    """
    raw = readers.read_json_array(spark, path, schema, sequence=True)
    if raw is None:
        return None
    there = lambda c: F.when(F.col(c).isNotNull(), F.col(readers.SEQUENCE))
    fields = [c for c in raw.columns if c not in ("_id", "id", "url", readers.SEQUENCE)]
    keyed = raw.withColumn("id", norm.short_id(raw))
    has_id = F.coalesce(F.col("id") != "", F.lit(False))
    counted, seen = observed(keyed, f"import_{name}", merged=has_id, skipped=~has_id)
    merged = counted.filter(has_id).groupBy("id").agg(*[F.max_by(F.col(c), there(c)).alias(c) for c in fields])
    publish(spark, name, norm.clean_restaurants(merged))
    if counters is not None:
        counters.update(seen.get)
    return spark.table(name)


def export_lake(
    collections: dict[str, DataFrame], tables: dict[str, DataFrame], root: str, file_format: str = "json"
) -> dict[str, bool]:
    """Collections and tables as files below ``root``; tells which ones were written.

    JSON Lines is what other tools expect; reports over large tables should read Parquet.
    """
    written = {}
    for name, df in collections.items():
        written[name] = writers.publish_files(writers.export_documents(df), f"{root}/{name}", file_format)
    for name, df in tables.items():
        folder = f"mysql_{name}"
        written[folder] = writers.publish_files(writers.export_table(df, name), f"{root}/{folder}", file_format)
    return written
