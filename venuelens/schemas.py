"""Explicit schemas. Polymorphic JSON scalars (rating, review_count) are read as STRING."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as fv


_TEXT, _DOUBLE, _INT, _LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _reviews(rating: T.DataType) -> T.ArrayType:
    return T.ArrayType(struct(user=_TEXT, rating=rating, comment=_TEXT))


RESTAURANTS_RAW = struct(
    id=_TEXT, name=_TEXT, rating=_TEXT, review_count=_TEXT, address=_TEXT, district=_TEXT,
    district_parsed=_TEXT, city=_TEXT, reviews=_reviews(_TEXT),
)
MEALS_RAW = struct(
    id=_TEXT, name=_TEXT, category=_TEXT, area=_TEXT, instructions=_TEXT, ingredients=T.ArrayType(_TEXT)
)
# A document that names its key `_id` and its page `url`.
DOCUMENTS_RAW = T.StructType([*struct(_id=_TEXT, url=_TEXT).fields, *RESTAURANTS_RAW.fields])
RECIPES_RAW = struct(
    idMeal=_TEXT, strMeal=_TEXT, strCategory=_TEXT, strArea=_TEXT, strInstructions=_TEXT,
    **{f"strIngredient{i}": _TEXT for i in range(1, fv.MEAL_INGREDIENT_COLUMNS + 1)},
)

NESTED_RESTAURANTS = struct(
    id=_TEXT, name=_TEXT, rating=_DOUBLE, review_count=_INT, address=_TEXT, district=_TEXT, city=_TEXT,
    reviews=_reviews(_DOUBLE),
)
RESTAURANTS = struct(
    id=_TEXT, name=_TEXT, rating=_DOUBLE, review_count=_INT, address=_TEXT, district=_TEXT,
    district_parsed=_TEXT, city=_TEXT,
)
REVIEWS = struct(id=_LONG, restaurant_id=_TEXT, user=_TEXT, rating=_DOUBLE, comment=_TEXT)
MEALS = struct(id=_TEXT, name=_TEXT, category=_TEXT, area=_TEXT, instructions=_TEXT, ingredients=_TEXT)

AREAS = struct(strArea=_TEXT, strCountry=_TEXT)
CATEGORIES = struct(strCategory=_TEXT)
INGREDIENTS = struct(strIngredient=_TEXT, name=_TEXT)

RESTAURANT_DEFAULTS = {
    "review_count": 0, "district": fv.UNKNOWN, "district_parsed": fv.UNKNOWN, "city": fv.UNKNOWN,
}
REVIEW_DEFAULTS = {"user": fv.DEFAULT_USER}
MEAL_DEFAULTS = {"category": fv.UNKNOWN, "area": fv.UNKNOWN}


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Bring ``df`` to ``schema``: add missing columns with their default, drop extra ones, cast the rest.

    Already conforming input gives the same rows again. A default fills only a
    column that was missing, as adding a column to a stored table does.
    """
    defaults = defaults or {}
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        source = F.col(f"`{field.name}`") if field.name in present else F.lit(defaults.get(field.name))
        return source.cast(field.dataType).alias(field.name)

    return df.select([column(f) for f in schema.fields])


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill nulls of columns that are declared with a default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns})
