"""Link class, next page, fingerprint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def link_class(
    url: Column, list_pattern: str = fv.LIST_URL_PATTERN, detail_pattern: str = fv.DETAIL_URL_PATTERN
) -> Column:
    """N23: 'list', 'detail' or NULL."""
    return F.when(url.rlike(list_pattern), F.lit("list")).when(url.rlike(detail_pattern), F.lit("detail"))


def page_offset(url: Column, marker: str = "-Reviews-") -> Column:
    """Offset N of ``<marker>orN-``, 0 on the first page."""
    found = F.regexp_extract(url, rf"{marker}or(\d+)-", 1)
    return F.coalesce(found.try_cast("int"), F.lit(0))


def next_page_url(
    url: Column,
    cards: Column,
    total: Column,
    marker: str = "-Reviews-",
    page_size: int = fv.REVIEW_PAGE_SIZE,
    max_reviews: int | None = None,
) -> Column:
    """Address of the next review page; NULL at the end.

    The end is a page with fewer cards than a full one, an offset at or past
    the known total (0 or NULL = not known), or past ``max_reviews`` if that is given.
    """
    offset = page_offset(url, marker) + page_size
    goes_on = (cards >= page_size) & ((F.coalesce(total, F.lit(0)) <= 0) | (offset < total))
    if max_reviews is not None:
        goes_on = goes_on & (offset < max_reviews)
    plain = F.regexp_replace(url, rf"{marker}or\d+-", marker)
    moved = F.replace(plain, F.lit(marker), F.concat(F.lit(f"{marker}or"), offset.cast("string"), F.lit("-")))
    return F.when(goes_on, moved)


def fingerprint(url: Column) -> Column:
    """Key of a link in the already-seen set."""
    return F.sha1(F.lower(url))
