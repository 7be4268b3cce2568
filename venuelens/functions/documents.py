"""Nested parts of documents: review arrays and recipe ingredients."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .numbers import extract_float, parse_review_rating
from .text import default_if_blank, strip, trimmed_list


def clean_reviews(reviews: Column, any_number: bool = False) -> Column:
    """Rating parsed, user and comment trimmed, reviews without any content dropped.

    A missing user gives the default user, a missing or empty comment NULL.
    ``any_number`` takes the first number anywhere as the rating (crawler form).
    A NULL array gives an empty one.
    """
    parse = extract_float if any_number else parse_review_rating

    def trimmed(r: Column) -> Column:
        return F.struct(
            strip(r["user"]).alias("user"), parse(r["rating"]).alias("rating"), strip(r["comment"]).alias("comment")
        )

    def has_content(r: Column) -> Column:
        return (
            (F.coalesce(r["user"], F.lit("")) != "")
            | (F.coalesce(r["comment"], F.lit("")) != "")
            | r["rating"].isNotNull()
        )

    def filled(r: Column) -> Column:
        return F.struct(
            default_if_blank(r["user"], fv.DEFAULT_USER).alias("user"),
            r["rating"].alias("rating"),
            F.when(r["comment"] != "", r["comment"]).alias("comment"),
        )

    cleaned = F.transform(F.filter(F.transform(reviews, trimmed), has_content), filled)
    return F.coalesce(cleaned, F.array().cast("array<struct<user:string,rating:double,comment:string>>"))


def wide_to_array(*columns: Column) -> Column:
    """Numbered columns to one array of trimmed, non-empty texts."""
    return trimmed_list(F.array(*columns))


def default_label(value: Column) -> Column:
    """Area or category, "Unknown" when missing."""
    return default_if_blank(value, fv.UNKNOWN)
