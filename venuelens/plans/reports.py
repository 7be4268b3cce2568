"""The report bundle and free SQL (V8, V9)."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import fixed_values as fv
from ..streaming.counts import ROWS
from ..streaming.incremental import LakeStore
from . import views

log = logging.getLogger(__name__)


def report_bundle(
    restaurants: Callable[[], DataFrame], reviews: Callable[[], DataFrame], meals: Callable[[], DataFrame],
    weight: str | None = None,
) -> dict[str, DataFrame]:
    """V8: the six charted reports by name.

    Inputs are given as functions, so that a table that cannot be read empties its
    own reports and leaves the others alone. Each report scans only the columns it
    needs; nothing is cached, since the inputs may be far larger than memory. A
    failure that shows only when a report runs is caught by ``report_frames``.
    With ``weight``, rows stand for as many equal ones, as in ``kept_bundle``.
    """
    makers: dict[str, Callable[[], DataFrame]] = {
        "view_rating_by_district": lambda: views.rating_by_district(restaurants(), weight=weight).limit(fv.DISTRICT_REPORT_ROWS),
        "view_cuisine_frequency": lambda: views.category_frequency(meals(), weight=weight).limit(fv.CATEGORY_REPORT_ROWS),
        "view_top_districts": lambda: views.top_districts(restaurants(), weight=weight).limit(fv.TOP_DISTRICT_REPORT_ROWS),
        "view_rating_histogram": lambda: views.rating_histogram(restaurants(), weight=weight),
        "view_review_distribution": lambda: views.review_distribution(reviews(), weight=weight),
        "view_delivery_sentiment": lambda: views.delivery_sentiment(reviews(), weight=weight),
    }
    bundle = {}
    for name, make in makers.items():
        try:
            bundle[name] = make()
        except AnalysisException as error:
            log.warning("report %s failed: %s", name, error)
            bundle[name] = _empty()
    return bundle


def kept_bundle(spark: SparkSession, store: LakeStore) -> dict[str, DataFrame]:
    """V8 from the counts that a store keeps up to date: no table is read."""
    of = lambda name: lambda: store.counted(spark, name)
    return report_bundle(of("restaurants"), of("reviews"), of("meals"), weight=ROWS)


def report_frames(bundle: dict[str, DataFrame]) -> dict[str, "pandas.DataFrame"]:
    """The reports as small local frames for display; one that fails while running comes out empty."""
    import pandas

    frames = {}
    for name, df in bundle.items():
        try:
            frames[name] = df.toPandas()
        except Exception as error:  # shown as an empty chart, the others stay
            log.warning("report %s failed: %s", name, error)
            frames[name] = pandas.DataFrame()
    return frames


def _empty() -> DataFrame:
    return SparkSession.active().createDataFrame([], T.StructType())


def query(spark: SparkSession, sql: str) -> DataFrame:
    """V9: any SELECT over the session's tables and views."""
    return spark.sql(sql)
