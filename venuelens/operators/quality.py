"""Row counts and parse ratio."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import fixed_values as fv


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, is_empty), one count per table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).withColumn("is_empty", F.col("row_count") == 0)


def parse_ratio(df: DataFrame, column: str = "district_parsed", unknown: str = fv.UNKNOWN) -> DataFrame:
    """(total, parsed, unknown_share, warning) in one pass; an empty table gives a NULL share and no warning."""
    unknown_rows = F.count_if(F.col(column) == unknown)
    share = F.try_divide(unknown_rows, F.count("*"))
    return df.agg(
        F.count("*").alias("total"),
        (F.count("*") - unknown_rows).alias("parsed"),
        share.alias("unknown_share"),
        F.coalesce(share > fv.UNKNOWN_SHARE_WARNING, F.lit(False)).alias("warning"),
    )


def observed(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Count while the rows pass through; read the numbers from the observation after the write."""
    observation = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counters.items()]]
    return df.observe(observation, *metrics), observation
