"""Numbers out of messy text (N1, N2, N3, N13). Column in, Column out.

JSON numbers arrive here as their text, since the polymorphic fields are read
as STRING. Text that is a plain number, signed or with an exponent, is taken as
one. "nan" and "inf" are not numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outer whitespace of any script around a plain number.
_SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"
_PLAIN = rf"^{_SPACE}([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?){_SPACE}$"


def _found(capture: Column, kind: str) -> Column:
    """A capture as a number. Text that did not match is tested first: a failing cast is far slower than the test."""
    return F.when(capture != "", capture.try_cast(kind))


def strict_float(value: Column) -> Column:
    """The whole text as a number, else NULL."""
    return _found(F.regexp_extract(value.cast("string"), _PLAIN, 1), "double")


def extract_float(value: Column) -> Column:
    """The number itself, or the first number found anywhere in the text, else NULL."""
    first = F.regexp_extract(value.cast("string"), r"(\d+(\.\d+)?)", 1)
    return F.coalesce(strict_float(value), _found(first, "double"))


def parse_review_rating(value: Column) -> Column:
    """A number, or X of a leading "X of N", else NULL."""
    leading = F.regexp_extract(value.cast("string"), rf"(?i)^{_SPACE}(\d+(?:\.\d+)?)\s+of\s+\d+", 1)
    return F.coalesce(strict_float(value), _found(leading, "double"))


def parse_review_count(value: Column) -> Column:
    """BIGINT. NULL gives 0, a number is truncated, other text gives its digits joined, no digits give 0.

    A digit string beyond BIGINT gives NULL, so that the length check rejects the row instead of storing a wrong count.
    """
    text = value.cast("string")
    number = F.regexp_extract(text, _PLAIN, 1)
    digits = F.regexp_replace(text, r"\D", "")
    return (
        F.when(text.isNull(), F.lit(0).cast("bigint"))
        .when(number.rlike(r"^[+-]?\d+$"), number.try_cast("bigint"))
        .when(number != "", number.try_cast("double").try_cast("bigint"))
        .when(digits == "", F.lit(0).cast("bigint"))
        .otherwise(digits.try_cast("bigint"))
    )


def rating_value(df_type: str, value: Column) -> Column:
    """A rating as DOUBLE: numeric columns are cast, text goes through ``strict_float``."""
    return strict_float(value) if df_type == "string" else value.cast("double")
