"""Rows sorted by outcome in one write: accepted, refused with their reasons and content, skipped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .normalize import ACCEPTED, OUTCOME, REASON, REFUSED, SKIPPED
from .quality import observed


@dataclass(frozen=True)
class Sorted:
    """Accepted rows, refused ones as (table, key, reason, content), and the counters of the write."""

    accepted: DataFrame
    refused: DataFrame
    counters: dict[str, int]


def sort_out(marked: DataFrame, table: str, key: str) -> Sorted:
    """Marked rows written once, by outcome; what follows reads the part it needs.

    The input is read and judged once however many results derive from it, and all counters come from that one pass.
    """
    spark = marked.sparkSession
    folder = shared_dir(spark, f"outcomes-{table}")
    is_a = lambda outcome: F.col(OUTCOME) == outcome
    counted, seen = observed(marked, f"outcomes {folder}", accepted=is_a(ACCEPTED), refused=is_a(REFUSED), skipped=is_a(SKIPPED))
    counted.write.partitionBy(OUTCOME).parquet(folder)
    rows = spark.read.schema(marked.schema).parquet(folder)
    content = [c for c in marked.columns if c not in (OUTCOME, REASON)]
    refused = rows.filter(is_a(REFUSED)).select(
        F.lit(table).alias("table"), F.col(key).cast("string").alias("key"), F.col(REASON).alias("reason"),
        F.to_json(F.struct(*content)).alias("content"),
    )
    return Sorted(rows.filter(is_a(ACCEPTED)).select(*content), refused, {k: seen.get[k] for k in ("rows", "accepted", "refused", "skipped")})


def needs_order(accepted: DataFrame, key: str, order, what: str) -> None:
    """Ids that repeat without an order have no last row: that is an error and not a matter of chance."""
    if not order and accepted.groupBy(key).count().filter("count > 1").limit(1).collect():
        raise ValueError(f"ids of {what} repeat; name the columns that tell which row is the last")
