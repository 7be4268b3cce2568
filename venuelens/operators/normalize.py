"""Documents to flat tables.

Column expressions only. Rows that the tables would refuse are kept apart with
their reason, and the last accepted document of an id wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .. import schemas
from ..functions.documents import clean_reviews, default_label, wide_to_array
from ..functions.numbers import extract_float, parse_review_count
from ..functions.places import clean_location_text, extract_admin_area, normalize_city
from ..functions.text import array_to_csv, default_if_blank, first_present, is_present, make_short_id, trimmed_list
from .tables import latest_by_key


def _raw_id(df: DataFrame) -> Column:
    names = [c for c in ("_id", "id", "url") if c in df.columns]
    return F.coalesce(*[F.col(c) for c in names])


def short_id(raw: DataFrame) -> Column:
    """The short id of a raw document, '' if it has none."""
    return make_short_id(_raw_id(raw))


def clean_restaurants(raw: DataFrame, literal: bool = False, any_number: bool = False) -> DataFrame:
    """One pass over raw documents; the result is nested like the input, typed, plus any other columns."""
    # The three texts are cleaned once, in a step of its own that is used by several columns and so isn't written out again.
    place = F.struct(*[clean_location_text(F.col(c)).alias(c) for c in ("district", "address", "city")])
    placed = raw.withColumn("_place", place)
    district, address, city = (F.col("_place")[c] for c in ("district", "address", "city"))
    cleaned = {
        "id": make_short_id(_raw_id(raw)),
        "rating": extract_float(F.col("rating")),
        "review_count": parse_review_count(F.col("review_count")),
        "address": F.when((address == "") & (district != ""), district).otherwise(F.col("address")),
        "district_parsed": extract_admin_area(district, address, city, literal=literal, cleaned=True),
        "city": normalize_city(city, address, district, cleaned=True),
        "reviews": clean_reviews(F.col("reviews"), any_number),
    }
    return placed.withColumns(cleaned).drop("_id", "url", "_place")


def parse_meals(raw: DataFrame) -> DataFrame:
    """Wide recipe records to meal documents; records without an id are dropped."""
    numbered = [F.col(f"strIngredient{i}") for i in range(1, fv.MEAL_INGREDIENT_COLUMNS + 1)]
    return raw.filter(is_present(F.col("idMeal"))).select(
        F.concat(F.lit(fv.MEAL_ID_PREFIX), F.col("idMeal")).alias("id"),
        F.col("strMeal").alias("name"),
        F.col("strCategory").alias("category"),
        F.col("strArea").alias("area"),
        F.col("strInstructions").alias("instructions"),
        wide_to_array(*numbered).alias("ingredients"),
    )


def clean_meals(meals: DataFrame) -> DataFrame:
    """Defaults for area and category, ingredients trimmed and without empty ones."""
    return meals.withColumns(
        {
            "category": default_label(F.col("category")),
            "area": default_label(F.col("area")),
            "ingredients": trimmed_list(F.col("ingredients")),
        }
    )


def too_long(limits: dict[str, int]) -> Column:
    """Reason texts of all over-long columns, '' when the row is fine."""
    return F.concat_ws(
        "; ", *[F.when(F.length(F.col(c)) > n, F.lit(f"{c} longer than {n}")) for c, n in limits.items()]
    )


def _refused_restaurant(place: dict[str, Column]) -> Column:
    """R10 for raw restaurants with their short id: reason texts, '' when the row is fine.

    The rules hold for the stored values. Cleaning never makes a text longer, so
    it is only worked out here for a raw text over its limit. A parsed district
    is a label and at most 41 characters, so it always fits.
    """
    limits = fv.RESTAURANT_TEXT_LIMITS
    address = first_present(place["address"], place["district"])
    stored = {
        "id": (F.length("id"), F.col("id")),
        "name": (F.length("name"), F.col("name")),
        "address": (_longest("address", "district"), address),
        "district": (F.length("district"), place["district"]),
        "city": (
            _longest("city", "address", "district"),
            normalize_city(place["city"], place["address"], place["district"], cleaned=True),
        ),
    }
    reasons = [
        F.when(raw > limits[c], F.when(F.length(value) > limits[c], F.lit(f"{c} longer than {limits[c]}")))
        for c, (raw, value) in stored.items()
    ]
    count = parse_review_count(F.col("review_count"))
    may_overflow = (F.length("review_count") >= 10) | F.col("review_count").rlike("[eE]")
    in_range = count.isNotNull() & count.between(fv.INT_MIN, fv.INT_MAX)
    reasons.append(F.when(may_overflow, F.when(~in_range, F.lit("review_count out of range"))))
    return F.concat_ws("; ", *reasons)


def _longest(*columns: str) -> Column:
    return F.greatest(*[F.coalesce(F.length(c), F.lit(0)) for c in columns])


@dataclass(frozen=True)
class Split:
    """Accepted rows, and (id, reason) of refused ones."""

    accepted: DataFrame
    rejects: DataFrame


def _split(df: DataFrame, reason: Column, key: str, table: str) -> Split:
    marked = df.withColumn("_reason", reason)
    rejects = marked.filter("_reason <> ''").select(
        F.lit(table).alias("table"), F.col(key).cast("string").alias("key"), F.col("_reason").alias("reason")
    )
    return Split(marked.filter("_reason = ''").drop("_reason"), rejects)


def restaurant_documents(raw: DataFrame, order: Sequence[str] = (), literal: bool = False) -> Split:
    """Cleaned, accepted documents, one per id, shaped like the flat table plus ``reviews``.

    Rows are refused and the last row of each id is picked on the raw values; only
    the rows left are cleaned. Both flat tables derive from this result, so a load
    writes it once and reads it twice.
    """
    keep_order = [c for c in order if c not in ("_id", "url")]
    keyed = raw.withColumn("id", make_short_id(_raw_id(raw))).select(
        "id", "name", "rating", "review_count", "address", "district", "city", "reviews", *keep_order
    )
    raw_place = {c: clean_location_text(F.col(c)) for c in ("district", "address", "city")}
    split = _split(keyed.filter(is_present(F.col("id"))), _refused_restaurant(raw_place), "id", "restaurants")  # F5
    return Split(latest_documents(split.accepted, order, literal), split.rejects)


def latest_documents(accepted: DataFrame, order: Sequence[str] = (), literal: bool = False) -> DataFrame:
    """The last of the accepted raw documents of each id, cleaned, with the order columns."""
    latest = latest_by_key(accepted, "id", order)
    placed = latest.withColumn("_place", F.struct(*[clean_location_text(F.col(c)).alias(c) for c in ("district", "address", "city")]))
    district, address, city = (F.col("_place")[c] for c in ("district", "address", "city"))
    return placed.select(
        "id",
        default_if_blank(F.col("name"), fv.DEFAULT_RESTAURANT_NAME).alias("name"),
        extract_float(F.col("rating")).alias("rating"),
        parse_review_count(F.col("review_count")).try_cast("int").alias("review_count"),
        first_present(address, district).alias("address"),
        district.alias("district"),
        extract_admin_area(district, address, city, literal=literal, cleaned=True).alias("district_parsed"),
        normalize_city(city, address, district, cleaned=True).alias("city"),
        clean_reviews(F.col("reviews")).alias("reviews"),
        *[c for c in order if c not in ("_id", "url")],
    )


OUTCOME, REASON = "_outcome", "_reason"
ACCEPTED, REFUSED, SKIPPED = "accepted", "refused", "skipped"


def _marked(df: DataFrame, present: Column, reason: Column) -> DataFrame:
    """Every row with its outcome and reasons, so that one write can sort them out."""
    judged = df.withColumn(REASON, F.when(present, reason).otherwise(""))
    outcome = F.when(~present, SKIPPED).when(F.col(REASON) != "", REFUSED).otherwise(ACCEPTED)
    return judged.withColumn(OUTCOME, outcome)


def mark_restaurants(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Raw documents with their short id, none dropped; those without an id are skipped."""
    keep_order = [c for c in order if c not in ("_id", "url")]
    keyed = raw.withColumn("id", make_short_id(_raw_id(raw))).select(
        "id", "name", "rating", "review_count", "address", "district", "city", "reviews", *keep_order
    )
    place = {c: clean_location_text(F.col(c)) for c in ("district", "address", "city")}
    return _marked(keyed, F.coalesce(is_present(F.col("id")), F.lit(False)), _refused_restaurant(place))


def mark_reviews(documents: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The reviews of accepted documents with their outcome, and further columns of the document."""
    extra = documents.select("id", *more).columns[1:]
    exploded = documents.select(F.col("id").alias("restaurant_id"), *extra, F.posexplode_outer("reviews").alias("pos", "r"))
    flat = exploded.filter("pos IS NOT NULL").select("restaurant_id", "pos", "r.user", "r.rating", "r.comment", *extra)
    return _marked(flat, F.lit(True), too_long(fv.REVIEW_TEXT_LIMITS))


def stored_reviews(accepted: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Accepted reviews as they are stored."""
    keyed = accepted.withColumn("id", review_key(F.col("restaurant_id"), F.col("pos")))
    return keyed.withColumn("user", default_if_blank(F.col("user"), fv.DEFAULT_USER)).select(*schemas.REVIEWS.fieldNames(), *more)


def mark_meals(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Parsed meals as they are stored, none dropped; those without an id or a name are skipped."""
    shaped = raw.select(
        "id", "name", default_label(F.col("category")).alias("category"), default_label(F.col("area")).alias("area"),
        "instructions", array_to_csv(F.col("ingredients")).alias("ingredients"), *order,
    )
    present = is_present(F.col("id")) & is_present(F.col("name"))
    return _marked(shaped, F.coalesce(present, F.lit(False)), too_long(fv.MEAL_TEXT_LIMITS))


def restaurants_table(documents: DataFrame) -> DataFrame:
    """R8, first table."""
    return documents.select(*schemas.RESTAURANTS.fieldNames())


def explode_reviews(documents: DataFrame, key: str = "id", reviews: str = "reviews") -> DataFrame:
    """(restaurant_id, pos, user, rating, comment), one row per review."""
    # The outer form, since a plain one adds a size test that cleans the reviews a second time.
    exploded = documents.select(F.col(key).alias("restaurant_id"), F.posexplode_outer(reviews).alias("pos", "r"))
    return exploded.filter("pos IS NOT NULL").select("restaurant_id", "pos", "r.user", "r.rating", "r.comment")


def review_key(restaurant_id: Column, pos: Column) -> Column:
    """A surrogate key that is the same on every run, on any cluster. The exact key is (restaurant_id, pos)."""
    return F.xxhash64(restaurant_id, pos)


def reviews_table(documents: DataFrame) -> Split:
    """R8, second table, from accepted documents: their parents exist, so no join is needed."""
    exploded = explode_reviews(documents)
    split = _split(exploded, too_long(fv.REVIEW_TEXT_LIMITS), "restaurant_id", "reviews")
    keyed = split.accepted.withColumn("id", review_key(F.col("restaurant_id"), F.col("pos")))
    return Split(
        keyed.withColumn("user", default_if_blank(F.col("user"), fv.DEFAULT_USER)).select(
            *schemas.REVIEWS.fieldNames()
        ),
        split.rejects,
    )


def meals_table(raw: DataFrame, order: Sequence[str] = ()) -> Split:
    """R8, third table: rows without id or name dropped (F5), ingredients joined to one text."""
    shaped = raw.filter(is_present(F.col("id")) & is_present(F.col("name"))).select(
        "id",
        "name",
        default_label(F.col("category")).alias("category"),
        default_label(F.col("area")).alias("area"),
        "instructions",
        array_to_csv(F.col("ingredients")).alias("ingredients"),
        *order,
    )
    split = _split(shaped, too_long(fv.MEAL_TEXT_LIMITS), "id", "meals")
    return Split(latest_by_key(split.accepted, "id", order).select(*schemas.MEALS.fieldNames()), split.rejects)


@dataclass(frozen=True)
class Normalized:
    restaurants: DataFrame
    reviews: DataFrame
    meals: DataFrame
    rejects: DataFrame


def normalize(
    restaurants_raw: DataFrame,
    meals_raw: DataFrame,
    order: Sequence[str] = (),
    meals_order: Sequence[str] = (),
    literal: bool = False,
) -> Normalized:
    """Raw documents to the three flat tables and the refused rows."""
    documents = restaurant_documents(restaurants_raw, order, literal)
    reviews = reviews_table(documents.accepted)
    meals = meals_table(meals_raw, meals_order)
    rejects = documents.rejects.unionByName(reviews.rejects).unionByName(meals.rejects)
    return Normalized(restaurants_table(documents.accepted), reviews.accepted, meals.accepted, rejects)
