"""Row counts of a kept table by the columns that its reports ask for, maintained by signed changes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_folder
from ..sources.readers import path_missing
from .changelog import BATCH, SIGN

#: Column of the counts; the views take it as ``weight``.
ROWS = "n"


@dataclass(frozen=True)
class Counts:
    """How many rows of a table hold each combination of a few columns.

    Whole numbers can be taken back exactly, so rows that a batch replaces leave no trace, and averages derive from the
    distinct values with their counts. A batch writes the combinations whose count it changes to a partition of its own;
    repeating it changes nothing. ``fold`` brings the batches up to a number to one set of rows.
    """

    root: str
    schema: T.StructType

    def add(self, changes: DataFrame, number: int) -> None:
        """Batch ``number``: rows that came, with ``_sign`` 1, and that went, with -1."""
        self._summed(changes, SIGN).write.mode("overwrite").parquet(f"{self.root}/deltas/{BATCH}={number}")

    def total(self, spark: SparkSession, upto: int) -> DataFrame:
        """The columns and their count ``n`` after batch ``upto``."""
        start = self._start(spark, upto)
        folded = self._read(spark, "folded").filter(F.col(BATCH) == start)
        later = self._read(spark, "deltas").filter((F.col(BATCH) > start) & (F.col(BATCH) <= upto))
        return self._summed(folded.unionByName(later), ROWS)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """One set of rows for all batches up to a number. A run that fails midway leaves the counts as they are."""
        if upto > self._start(spark, upto):
            self._restart(self.total(spark, upto), upto)

    def recount(self, rows: DataFrame, number: int) -> None:
        """Starts anew from the whole content after batch ``number``, for a table that was kept without counts."""
        remove_folder(rows.sparkSession, f"{self.root}/started/{number}")
        self._restart(self._summed(rows.withColumn(ROWS, F.lit(1)), ROWS), number)

    def _summed(self, rows: DataFrame, weight: str) -> DataFrame:
        return rows.groupBy(*self.schema.fieldNames()).agg(F.sum(weight).cast("bigint").alias(ROWS)).filter(F.col(ROWS) != 0)

    def _restart(self, rows: DataFrame, number: int) -> None:
        spark, older = rows.sparkSession, self._starts(rows.sparkSession)
        rows.write.mode("overwrite").parquet(f"{self.root}/folded/{BATCH}={number}")
        # Readers take the new rows from here on; the old ones go afterwards.
        spark.range(1).select(F.lit(number).cast("bigint").alias("number")).write.mode("overwrite").parquet(f"{self.root}/started/{number}")
        done = [r[0] for r in self._read(spark, "deltas").filter(F.col(BATCH) <= number).select(BATCH).distinct().collect()]
        for batch in done:
            remove_folder(spark, f"{self.root}/deltas/{BATCH}={batch}")
        for start in older:
            if start < number:
                remove_folder(spark, f"{self.root}/started/{start}")
                remove_folder(spark, f"{self.root}/folded/{BATCH}={start}")

    def _starts(self, spark: SparkSession) -> list[int]:
        try:
            marks = spark.read.schema("number bigint").option("recursiveFileLookup", True).parquet(f"{self.root}/started")
        except AnalysisException as error:
            if path_missing(error):
                return []
            raise
        return sorted({r[0] for r in marks.collect()})

    def _start(self, spark: SparkSession, upto: int) -> int:
        return max((s for s in self._starts(spark) if s <= upto), default=-1)

    def _read(self, spark: SparkSession, part: str) -> DataFrame:
        fields = T.StructType([*self.schema.fields, T.StructField(ROWS, T.LongType()), T.StructField(BATCH, T.LongType())])
        try:
            return spark.read.schema(fields).parquet(f"{self.root}/{part}")
        except AnalysisException as error:
            if path_missing(error):
                return spark.createDataFrame([], fields)
            raise
