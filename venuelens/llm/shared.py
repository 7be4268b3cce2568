"""Reading tables and staging intermediate results for the operators of this package."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder; what follows reads them from there and not from the input again."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: str | Column) -> Column:
    """The UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def text_key(column: str | Column) -> Column:
    """A hash of a text; with the id it tells rows of one id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, also when the body uses it many times."""
    return F.transform(F.array(value), body)[0]


def release() -> None:
    """Called at the start of a task: drops the words that this worker remembers from an earlier stage, if it does."""
    encoding = sys.modules.get(f"{__package__}.encoding")
    if encoding:
        encoding.forget()
