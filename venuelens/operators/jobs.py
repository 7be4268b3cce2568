"""The eight grouped jobs (A1-A8) over nested documents.

Each takes a DataFrame plus column names and word lists. All are one partial
and one final aggregation; a group key that holds most of the rows costs one
partial result per task and nothing more. Averages round half to even.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.numbers import extract_float, parse_review_count, rating_value
from ..functions.places import extract_admin_area
from ..functions.text import contains_any, explode_once, is_present, strip, tokenize

def _rating(df: DataFrame, rating: str) -> Column:
    return rating_value(df.schema[rating].dataType.simpleString(), F.col(rating))


def rating_by_area(
    df: DataFrame,
    rating: str = "rating",
    parsed: str | None = "district_parsed",
    sources: Sequence[str] = ("district", "address", "city"),
    unknown: str = fv.UNKNOWN,
    ascii: bool = False,
    literal: bool = False,
    few_places: bool = False,
) -> DataFrame:
    """A1: (area, avg_rating, restaurant_count). The parsed area where there is one, else extracted from the sources.

    Extraction is costly. With ``few_places`` the rows are grouped by their raw texts first, and each distinct place is
    worked out once; that shuffles the texts, so it pays where places repeat often, not where every row has its own.
    """
    area = extract_admin_area(*[F.col(c) for c in sources], ascii=ascii, literal=literal)
    if parsed is not None:
        area = F.when(is_present(F.col(parsed)), F.col(parsed)).otherwise(area)
    if few_places:
        texts = [*sources, *([parsed] if parsed is not None else [])]
        rated = df.select(*texts, _rating(df, rating).alias("_rating")).filter(F.col("_rating").isNotNull())
        places = rated.groupBy(*texts).agg(F.sum("_rating").alias("_sum"), F.count("*").alias("_n"))
        places = places.select(area.alias("area"), "_sum", "_n")
        found = places.groupBy("area").agg(
            F.bround(F.sum("_sum") / F.sum("_n"), 2).alias("avg_rating"), F.sum("_n").alias("restaurant_count"),
            F.count_if(F.col("area") == unknown).alias("_unknown"),
        )
        return found.filter("_unknown = 0").drop("_unknown")
    rated = df.select(area.alias("area"), _rating(df, rating).alias("_rating")).filter(F.col("_rating").isNotNull())
    # The unknown group goes after the grouping: a filter on the area itself would
    # be moved below it and have the area extracted a second time for every row.
    return (
        rated.groupBy("area")
        .agg(
            F.bround(F.avg("_rating"), 2).alias("avg_rating"),
            F.count("*").alias("restaurant_count"),
            F.count_if(F.col("area") == unknown).alias("_unknown"),
        )
        .filter("_unknown = 0")
        .drop("_unknown")
    )


def tag_count(df: DataFrame, columns: Sequence[str] = ("category", "area")) -> DataFrame:
    """A2: (tag, n). All columns share one key space; empty tags are dropped."""
    tags = df.select(F.explode(F.array(*[strip(F.col(c)) for c in columns])).alias("tag"))
    return tags.filter(is_present(F.col("tag"))).groupBy("tag").agg(F.count("*").alias("n"))


def rating_bucket(df: DataFrame, rating: str = "rating") -> DataFrame:
    """A3: (bucket, n) with three buckets and "Unknown" for missing or unreadable ratings."""
    value = F.col("_rating")
    bucket = (
        F.when(value.isNull() | F.isnan(value), F.lit(fv.UNKNOWN))
        .when(value >= 4.0, F.lit(fv.RATING_BUCKET_HIGH))
        .when(value >= 3.0, F.lit(fv.RATING_BUCKET_MIDDLE))
        .otherwise(F.lit(fv.RATING_BUCKET_LOW))
    )
    return (
        df.select(_rating(df, rating).alias("_rating"))
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def _with_hits(df: DataFrame, key: str, comment: str, positive: Sequence[str], negative: Sequence[str]) -> DataFrame:
    """(key, _pos, _neg) per comment. Every occurrence of a word counts; the comment is cut into words once."""
    words = df.filter(is_present(F.col(key)) & is_present(F.col(comment))).select(
        F.col(key), tokenize(F.col(comment)).alias("_words")
    )

    def hits(lexicon: Sequence[str]) -> Column:
        return F.size(F.filter("_words", lambda word: word.isin(*lexicon))).cast("bigint")

    return words.select(F.col(key), hits(positive).alias("_pos"), hits(negative).alias("_neg"))


def lexicon_sentiment(
    df: DataFrame,
    key: str = "name",
    reviews: str = "reviews",
    comment: str = "comment",
    positive: Sequence[str] = fv.POSITIVE_WORDS,
    negative: Sequence[str] = fv.NEGATIVE_WORDS,
) -> DataFrame:
    """A4 over nested reviews: see ``lexicon_sentiment_flat``."""
    exploded = explode_once(df, F.col(f"{reviews}.{comment}"), "_comment", key)
    return lexicon_sentiment_flat(exploded, key, "_comment", positive, negative)


def lexicon_sentiment_flat(
    df: DataFrame,
    key: str,
    comment: str,
    positive: Sequence[str] = fv.POSITIVE_WORDS,
    negative: Sequence[str] = fv.NEGATIVE_WORDS,
) -> DataFrame:
    """A4: (key, avg_sentiment_score, reviews_analyzed). Score = positive minus negative words of a comment."""
    hits = _with_hits(df, key, comment, positive, negative)
    return hits.groupBy(key).agg(
        F.bround(F.avg(F.col("_pos") - F.col("_neg")), 3).alias("avg_sentiment_score"),
        F.count("*").alias("reviews_analyzed"),
    )


def positive_negative_ratio(
    df: DataFrame,
    key: str,
    comment: str,
    positive: Sequence[str] = fv.POSITIVE_WORDS,
    negative: Sequence[str] = fv.NEGATIVE_WORDS,
) -> DataFrame:
    """Q22: (key, positive_words, negative_words, positive_share) per key; share is NULL without any hit."""
    total = F.sum("_pos") + F.sum("_neg")
    return (
        _with_hits(df, key, comment, positive, negative)
        .groupBy(key)
        .agg(
            F.sum("_pos").alias("positive_words"),
            F.sum("_neg").alias("negative_words"),
            F.bround(F.try_divide(F.sum("_pos"), total), 3).alias("positive_share"),
        )
    )


def top_reviewed(
    df: DataFrame, name: str = "name", count: str = "review_count", tie_break: str = "id", n: int = fv.TOP_REVIEWED
) -> DataFrame:
    """(name, review_count), the n rows with most reviews. Equal counts go by name, then by ``tie_break``."""
    parsed = df.filter(is_present(F.col(name)) & F.col(count).isNotNull()).select(
        F.col(name).alias("name"), parse_review_count(F.col(count)).alias("review_count"), F.col(tie_break).alias("_tie")
    )
    return (
        parsed.orderBy(F.col("review_count").desc_nulls_last(), F.col("name"), F.col("_tie"))
        .limit(n)
        .select("name", "review_count")
    )


def star_label(value: Column) -> Column:
    """"1 Star".."5 Stars": rounded half to even, clamped."""
    stars = F.greatest(F.lit(1), F.least(F.lit(5), F.rint(value).try_cast("int")))
    return F.concat(stars.cast("string"), F.when(stars > 1, F.lit(" Stars")).otherwise(F.lit(" Star")))


def review_star_distribution(df: DataFrame, reviews: str = "reviews", rating: str = "rating") -> DataFrame:
    """A7 over nested reviews: see ``review_star_distribution_flat``."""
    return review_star_distribution_flat(explode_once(df, F.col(f"{reviews}.{rating}"), "_rating"), "_rating")


def review_star_distribution_flat(df: DataFrame, rating: str) -> DataFrame:
    """(stars, n). The rating is a number or the first number in the text; others are skipped."""
    is_text = df.schema[rating].dataType.simpleString() == "string"
    value = extract_float(F.col(rating)) if is_text else F.col(rating).cast("double")
    rated = df.select(value.alias("_rating")).filter(F.col("_rating").isNotNull() & ~F.isnan("_rating"))
    return rated.groupBy(star_label(F.col("_rating")).alias("stars")).agg(F.count("*").alias("n"))


def with_share(counts: DataFrame, n: str = "n") -> DataFrame:
    """Q22: add the share of each row in the total. For results with a fixed few rows, such as the star counts."""
    total = F.sum(n).over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return counts.withColumn("share", F.bround(F.col(n) / total, 4))


def delivery_vs_dinein_venue(
    df: DataFrame,
    rating: str = "rating",
    reviews: str = "reviews",
    comment: str = "comment",
    words: Sequence[str] = fv.DELIVERY_WORDS,
    whole_word: bool = False,
) -> DataFrame:
    """(label, avg_rating, restaurant_count). A venue counts as delivery when any comment holds any word.

    The search stops at the first hit. Missing reviews mean dine-in.
    """
    mentioned = F.coalesce(
        F.exists(F.col(f"{reviews}.{comment}"), lambda c: contains_any(c, words, whole_word)), F.lit(False)
    )
    label = F.when(mentioned, F.lit(fv.VENUE_DELIVERY)).otherwise(F.lit(fv.VENUE_DINE_IN))
    return (
        df.select(label.alias("label"), _rating(df, rating).alias("_rating"))
        .filter(F.col("_rating").isNotNull())
        .groupBy("label")
        .agg(F.bround(F.avg("_rating"), 2).alias("avg_rating"), F.count("*").alias("restaurant_count"))
    )
