"""Numbers without gaps for natural keys, going on over loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from ..sources.readers import path_missing

BATCH = "_batch"
#: Spark's increasing ids hold the partition above these bits and the row's place in it below.
PLACE_BITS = 33


@dataclass(frozen=True)
class DenseKeys:
    """0, 1, 2, ... for the distinct natural keys of all loads, stored below ``root``.

    The new keys of a load are numbered in their own order, on from the last number stored: a range partition and the
    count of each range give every row its number, so no task sees all keys. Unlike a hash, no two keys meet. Known keys
    keep their number; repeating the last load changes nothing. Rows with a NULL in the key get no number.
    """

    root: str
    key: T.StructType
    number: str = "number"

    def assign(self, rows: DataFrame, load: int) -> DataFrame:
        """``rows`` with their numbers; keys not met before ``load`` are numbered and stored."""
        spark, key = rows.sparkSession, self.key.fieldNames()
        stored = self.known(spark).filter(F.col(BATCH) < load)
        new = rows.select(*key).dropna().distinct().join(stored, key, "left_anti")
        folder = shared_dir(spark, "numbering")
        ranges = new.repartitionByRange(*key).sortWithinPartitions(*key)
        # Written once, with its place: what follows does not depend on how a repeated task would cut the ranges.
        ranges.withColumn("_place", F.monotonically_increasing_id()).write.parquet(folder)
        placed = spark.read.parquet(folder).withColumns({
            "_range": F.shiftright("_place", PLACE_BITS), "_place": F.col("_place").bitwiseAND((1 << PLACE_BITS) - 1)
        })
        last = stored.agg(F.max(self.number)).first()[0]
        offsets, following = [], 0 if last is None else last + 1
        for part, count in sorted(map(tuple, placed.groupBy("_range").count().collect())):  # one row for each task
            offsets.append((part, following))
            following += count
        starts = F.broadcast(spark.createDataFrame(offsets, "_range long, _start long"))
        numbered = placed.join(starts, "_range").select(*key, (F.col("_start") + F.col("_place")).alias(self.number))
        numbered.write.mode("overwrite").parquet(f"{self.root}/{BATCH}={load}")
        known = self.known(spark).filter(F.col(BATCH) <= load).drop(BATCH)
        return rows.join(known, key, "left").select(*rows.columns, self.number)

    def known(self, spark: SparkSession) -> DataFrame:
        """All keys with their numbers and the load that brought them."""
        fields = T.StructType([*self.key.fields, T.StructField(self.number, T.LongType()), T.StructField(BATCH, T.LongType())])
        try:
            return spark.read.schema(fields).parquet(self.root)
        except AnalysisException as error:
            if path_missing(error):
                return spark.createDataFrame([], fields)
            raise
