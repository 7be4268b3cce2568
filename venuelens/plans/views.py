"""The seven report views and two ad-hoc queries.

Functions over DataFrames with column names as arguments, and the same reports
as SQL views for users who query by name. Averages round half up.

Rows may stand for several equal ones: ``weight`` names the column that tells how
many, such as the counts that are kept up to date from a change log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.text import is_present, like_any, not_placeholder


def _rows(weight: str | None) -> Column:
    return F.sum(weight) if weight else F.count("*")


def _average(value: str, weight: str | None) -> Column:
    if not weight:
        return F.avg(value)
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(F.when(F.col(value).isNotNull(), F.col(weight))))


def rating_by_district(
    df: DataFrame,
    district: str = "district_parsed",
    rating: str = "rating",
    placeholders: Sequence[str] = fv.DISTRICT_REPORT_PLACEHOLDERS,
    weight: str | None = None,
) -> DataFrame:
    """V1: (district, avg_rating, total_count) over rated rows, best first."""
    return (
        df.filter(not_placeholder(F.col(district), placeholders) & F.col(rating).isNotNull())
        .groupBy(F.col(district).alias("district"))
        .agg(F.round(_average(rating, weight), 2).alias("avg_rating"), _rows(weight).alias("total_count"))
        .orderBy(F.desc("avg_rating"), "district")
    )


def category_frequency(
    df: DataFrame, category: str = "category", placeholders: Sequence[str] = fv.MEAL_REPORT_PLACEHOLDERS, weight: str | None = None
) -> DataFrame:
    """V2: (category, cnt), most frequent first."""
    return (
        df.filter(not_placeholder(F.col(category), placeholders))
        .groupBy(F.col(category).alias("category"))
        .agg(_rows(weight).alias("cnt"))
        .orderBy(F.desc("cnt"), "category")
    )


def histogram_label(rating: Column) -> Column:
    """bin of a rating; ratings above the scale fall into the last bin."""
    label = None
    for limit, text in fv.HISTOGRAM_BINS:
        label = F.when(rating < limit, F.lit(text)) if label is None else label.when(rating < limit, F.lit(text))
    top, text = fv.HISTOGRAM_TOP
    return label.when(rating <= top, F.lit(text)).otherwise(F.lit(fv.HISTOGRAM_OTHER))


def rating_histogram(df: DataFrame, rating: str = "rating", weight: str | None = None) -> DataFrame:
    """V3: (rating_group, restaurant_count), largest first."""
    return (
        df.filter(F.col(rating).isNotNull())
        .groupBy(histogram_label(F.col(rating)).alias("rating_group"))
        .agg(_rows(weight).alias("restaurant_count"))
        .orderBy(F.desc("restaurant_count"), "rating_group")
    )


def top_districts(
    df: DataFrame,
    district: str = "district_parsed",
    rating: str = "rating",
    placeholders: Sequence[str] = fv.TOP_DISTRICT_PLACEHOLDERS,
    weight: str | None = None,
) -> DataFrame:
    """V4: (district, restaurant_count, avg_rating); rows without a rating still count."""
    return (
        df.filter(not_placeholder(F.col(district), placeholders))
        .groupBy(F.col(district).alias("district"))
        .agg(_rows(weight).alias("restaurant_count"), F.round(_average(rating, weight), 2).alias("avg_rating"))
        .orderBy(F.desc("restaurant_count"), "district")
    )


def review_distribution(df: DataFrame, rating: str = "rating", weight: str | None = None) -> DataFrame:
    """V5: (stars, cnt) for ratings 1..5, truncated to whole stars."""
    return (
        df.filter(F.col(rating).between(1, 5))
        .groupBy(F.col(rating).cast("int").alias("stars"))
        .agg(_rows(weight).alias("cnt"))
        .orderBy("stars")
    )


def delivery_sentiment(
    df: DataFrame,
    comment: str = "comment",
    rating: str = "rating",
    patterns: Sequence[str] = fv.DELIVERY_LIKE_PATTERNS,
    weight: str | None = None,
) -> DataFrame:
    """V6: (service_type, avg_rating, review_count), each review classed by its own comment.

    Rows that have a ``service_type`` already, such as kept counts, are taken as classed.
    """
    classed = "service_type" in df.columns
    service = F.col("service_type") if classed else _service(F.col(comment), patterns)
    there = service.isNotNull() if classed else is_present(F.col(comment))
    return (
        df.filter(there & F.col(rating).isNotNull())
        .groupBy(service.alias("service_type"))
        .agg(F.round(_average(rating, weight), 3).alias("avg_rating"), _rows(weight).alias("review_count"))
    )


def _service(comment: Column, patterns: Sequence[str]) -> Column:
    return F.when(like_any(comment, patterns), F.lit(fv.REVIEW_DELIVERY)).otherwise(F.lit(fv.REVIEW_DINE_IN))


def service_type(comment: Column, patterns: Sequence[str] = fv.DELIVERY_LIKE_PATTERNS) -> Column:
    """Class of a review by its comment, NULL without one."""
    return F.when(is_present(comment), _service(comment, patterns))


def area_frequency(
    df: DataFrame, area: str = "area", placeholders: Sequence[str] = fv.MEAL_REPORT_PLACEHOLDERS, weight: str | None = None
) -> DataFrame:
    """V7: (area, meal_count), most frequent first."""
    return (
        df.filter(not_placeholder(F.col(area), placeholders))
        .groupBy(F.col(area).alias("area"))
        .agg(_rows(weight).alias("meal_count"))
        .orderBy(F.desc("meal_count"), "area")
    )


def raw_rating_histogram(df: DataFrame, rating: str = "rating", weight: str | None = None) -> DataFrame:
    """(rating, n) for every value, highest first, missing last."""
    return df.groupBy(F.col(rating).alias("rating")).agg(_rows(weight).alias("n")).orderBy(F.desc_nulls_last("rating"))


def best_districts(df: DataFrame, n: int = 10, **columns: str) -> DataFrame:
    """The n best districts of V1. Sort and limit are one step."""
    return rating_by_district(df, **columns).limit(n)


def _text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def _listed(values: Sequence[str]) -> str:
    return ", ".join(map(_text, values))


def view_statements(prefix: str = "") -> dict[str, str]:
    """The seven reports as SELECT statements over the external tables of a database."""
    restaurants, reviews = prefix + fv.RESTAURANTS_TABLE, prefix + fv.REVIEWS_TABLE
    meals = prefix + fv.NESTED_MEALS_TABLE
    bins = " ".join(f"WHEN rating < {limit} THEN {_text(text)}" for limit, text in fv.HISTOGRAM_BINS)
    label = f"CASE {bins} WHEN rating <= {fv.HISTOGRAM_TOP[0]} THEN {_text(fv.HISTOGRAM_TOP[1])} ELSE {_text(fv.HISTOGRAM_OTHER)} END"
    delivery = " OR ".join(f"lower(comment) LIKE {_text(pattern)}" for pattern in fv.DELIVERY_LIKE_PATTERNS)
    counted = "SELECT {0}, count(*) AS {1} FROM {2} WHERE {0} IS NOT NULL AND {0} NOT IN ({3}) GROUP BY {0} ORDER BY {1} DESC, {0}"
    hidden = _listed(fv.MEAL_REPORT_PLACEHOLDERS)
    return {
        "view_rating_by_district": f"""SELECT district_parsed AS district, round(avg(rating), 2) AS avg_rating, count(*) AS total_count
FROM {restaurants} WHERE district_parsed NOT IN ({_listed(fv.DISTRICT_REPORT_PLACEHOLDERS)}) AND rating IS NOT NULL
GROUP BY district_parsed ORDER BY avg_rating DESC, district""",
        "view_cuisine_frequency": counted.format("category", "cnt", meals, hidden),
        "view_rating_histogram": f"""SELECT {label} AS rating_group, count(*) AS restaurant_count FROM {restaurants}
WHERE rating IS NOT NULL GROUP BY 1 ORDER BY restaurant_count DESC, rating_group""",
        "view_top_districts": f"""SELECT district_parsed AS district, count(*) AS restaurant_count, round(avg(rating), 2) AS avg_rating
FROM {restaurants} WHERE district_parsed NOT IN ({_listed(fv.TOP_DISTRICT_PLACEHOLDERS)})
GROUP BY district_parsed ORDER BY restaurant_count DESC, district""",
        "view_review_distribution": f"""SELECT CAST(rating AS INT) AS stars, count(*) AS cnt FROM {reviews}
WHERE rating BETWEEN 1 AND 5 GROUP BY 1 ORDER BY stars""",
        "view_delivery_sentiment": f"""SELECT CASE WHEN {delivery} THEN {_text(fv.REVIEW_DELIVERY)} ELSE {_text(fv.REVIEW_DINE_IN)} END AS service_type,
round(avg(rating), 3) AS avg_rating, count(*) AS review_count FROM {reviews}
WHERE comment IS NOT NULL AND comment <> '' AND rating IS NOT NULL GROUP BY 1""",
        "view_cuisine_area": counted.format("area", "meal_count", meals, hidden),
    }


def create_views(spark: SparkSession, database: str | None = None) -> list[str]:
    """The seven reports as views stored in the database, so that other sessions of the catalog read them too."""
    prefix = f"{database}." if database else ""
    names = []
    for name, statement in view_statements(prefix).items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{name} AS {statement}")
        names.append(prefix + name)
    return names
