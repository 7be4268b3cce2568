"""Stored pages to documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import split_address
from ..functions.urls import fingerprint
from . import page_content
from .page_content import PageRules, Rule, page_fields

# Workers get the parser with the query and need no copy of this package.
cloudpickle.register_pickle_by_value(page_content)

__all__ = [
    "PageRules", "Rule", "count_cards", "extract_pages", "first_reviews", "merge_pages", "page_headers", "page_reviews", "unseen_links",
]


def unseen_links(links: DataFrame, seen: DataFrame, url: str = "url", key: str = "fingerprint") -> DataFrame:
    """One row per new link, those whose fingerprint is in ``seen`` left out."""
    keyed = links.withColumn(key, fingerprint(F.col(url)))
    once = keyed.groupBy(key).agg(F.min(url).alias(url))
    return once.join(seen.select(key), key, "left_anti").select(url, key)


def page_reviews(
    pages: DataFrame, key: str = "id", offset: str = "offset", reviews: str = "reviews"
) -> DataFrame:
    """R11, flat: (key, offset, pos, user, rating, comment) of every review of every page. No grouping, no limit."""
    exploded = pages.select(key, offset, F.posexplode_outer(reviews).alias("pos", "r")).filter("pos IS NOT NULL")
    return exploded.select(key, offset, "pos", "r.user", "r.rating", "r.comment")


def first_reviews(
    flat: DataFrame, key: str, order: Sequence[str], max_reviews: int
) -> DataFrame:
    """At most ``max_reviews`` rows per key, in order. Each task drops the surplus before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return flat.withColumn("_rank", rank).filter(F.col("_rank") <= max_reviews).drop("_rank")


def page_headers(
    pages: DataFrame, key: str = "id", offset: str = "offset", header: Sequence[str] = ("name", "rating", "review_count", "address")
) -> DataFrame:
    """R11, header side: one row per key with the header of its first page."""
    return pages.groupBy(key).agg(*[F.min_by(F.col(c), F.col(offset)).alias(c) for c in header])


def merge_pages(
    pages: DataFrame,
    key: str = "id",
    offset: str = "offset",
    reviews: str = "reviews",
    header: Sequence[str] = ("name", "rating", "review_count", "address"),
    max_reviews: int | None = None,
) -> DataFrame:
    """One document per key: header of its first page, reviews of all pages in page order.

    All reviews are kept unless ``max_reviews`` is given. One row then holds all
    of a key; where keys may have very many, take ``page_headers`` and
    ``page_reviews``, two tables joined by the key.
    """
    heads = page_headers(pages, key, offset, header)
    flat = page_reviews(pages, key, offset, reviews)
    if max_reviews is not None:
        flat = first_reviews(flat, key, [offset, "pos"], max_reviews)
    merged = flat.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(offset, "pos", "user", "rating", "comment"))).alias("_r")
    )
    in_order = F.transform(
        "_r", lambda r: F.struct(r["user"].alias("user"), r["rating"].alias("rating"), r["comment"].alias("comment"))
    )
    element = pages.schema[reviews].dataType.simpleString()
    return heads.join(merged, key, "left").select(
        key, *header, F.coalesce(in_order.cast(element), F.array().cast(element)).alias(reviews)
    )


_PAGE_COLUMNS = (
    "name string, rating string, review_count string, address string, cards int, "
    "reviews array<struct<user:string,rating:string,comment:string>>"
)


def extract_pages(pages: DataFrame, rules: PageRules, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, url, name, rating, review_count, address, district, city, cards, reviews) of stored pages.

    The one operator that runs Python: Spark has no HTML functions. A worker holds a hundred pages at a time, however
    many there are: Arrow would hand over ten thousand together. Each page is parsed on its own, and once.
    """
    # Said to be nondeterministic, so that no filter on its result, such as that of an explode, parses the page again.
    fields = F.udf(lambda text: page_fields(text, rules), f"struct<{_PAGE_COLUMNS}>", useArrow=False).asNondeterministic()
    parsed = pages.select(key, "url", fields(F.col(html)).alias("_page")).select(key, "url", "_page.*")
    district, city = split_address(F.col("address"))
    return parsed.withColumns({"district": district, "city": city}).select(
        key, "url", "name", "rating", "review_count", "address", "district", "city", "cards", "reviews"
    )


def count_cards(html: Column, marker: str) -> Column:
    """Number of cards on a page by a marker text, without parsing it."""
    return F.regexp_count(html, F.lit(marker))
