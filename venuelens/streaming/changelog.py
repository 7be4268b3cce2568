"""Tables kept as a change log: written at the cost of a batch, merged on reading, compacted by touched buckets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_folder, shared_dir
from ..sources.readers import path_missing

BATCH, BUCKET, GONE, SIGN = "_batch", "_bucket", "_gone", "_sign"


@dataclass(frozen=True)
class ChangeLog:
    """A table below ``root`` whose rows of one key come and go together.

    Each batch brings the whole new content of the keys it touches: one row of a restaurant, all reviews of one. Rows carry
    ``order`` columns; of all batches, the rows of a key with the greatest order are its content, and of equal order those
    of the later batch. So late batches do not undo newer ones, and the content does not depend on how rows fall into
    batches. A tombstone is a row with ``_gone`` set: it stands for a key with no rows of its own, and drops older ones.

    ``root/changes`` is partitioned by batch and hash bucket of the key, ``root/base`` by bucket. A batch overwrites
    only its own partitions, so repeating it changes nothing. Compaction rewrites the buckets that the log touches.
    """

    root: str
    key: str
    order: tuple[str, ...]
    schema: T.StructType
    buckets: int = 64

    def append(self, rows: DataFrame, number: int) -> None:
        """Batch ``number``; ``rows`` have the schema and maybe ``_gone``, one order value for all rows of a key."""
        gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in rows.columns else F.lit(False)
        marked = rows.select(
            *self.schema.fieldNames(), gone.alias(GONE), F.lit(number).cast("bigint").alias(BATCH), self._bucket().alias(BUCKET)
        )
        # Buckets gather in few files; a large one is spread over several tasks.
        whole = marked.hint("rebalance", F.col(BUCKET))
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH, BUCKET).parquet(f"{self.root}/changes")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _read(self, spark: SparkSession, part: str) -> DataFrame:
        fields = [*self.schema.fields, T.StructField(GONE, T.BooleanType()), T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
        try:
            return spark.read.schema(T.StructType(fields)).parquet(f"{self.root}/{part}")
        except AnalysisException as error:
            if path_missing(error):
                return spark.createDataFrame([], T.StructType(fields))
            raise

    def batches(self, spark: SparkSession) -> list[int]:
        """Numbers of the batches in the log: a listing of folders, as only the partition column is asked for."""
        return sorted(r[0] for r in self._read(spark, "changes").select(BATCH).distinct().collect())

    def current(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The content, with the batches up to a number."""
        return self._merged(spark, upto, None).filter(~F.col(GONE)).select(*self.schema.fieldNames())

    def current_of(self, spark: SparkSession, keys: DataFrame, upto: int | None = None) -> DataFrame:
        """The content of some keys, given with their buckets: only these buckets are read."""
        buckets = [r[0] for r in keys.select(BUCKET).distinct().collect()]  # as many as there are buckets, at most
        held = self._merged(spark, upto, buckets).filter(~F.col(GONE)).select(*self.schema.fieldNames())
        return held.join(keys.select(self.key), self.key, "left_semi").select(*self.schema.fieldNames())

    def bucket(self) -> Column:
        """The bucket that a row lies in."""
        return self._bucket()

    def _merged(self, spark: SparkSession, upto: int | None, buckets: list[int] | None) -> DataFrame:
        base, log = self._read(spark, "base"), self._read(spark, "changes")
        if upto is not None:
            log = log.filter(F.col(BATCH) <= upto)
        if buckets is not None:
            base, log = base.filter(F.col(BUCKET).isin(buckets)), log.filter(F.col(BUCKET).isin(buckets))
        # Rows of the log win over equal ones that a compaction has brought to the base already.
        version = F.struct(*self.order, BATCH, "_source").alias("_version")
        keys = log.select(self.key).distinct()
        touched = base.join(keys, self.key, "left_semi").withColumn("_source", F.lit(0))
        rows = touched.unionByName(log.withColumn("_source", F.lit(1))).withColumn("_version", version)
        # The greatest version is one row a key and task before the shuffle; rows of a hot key are not ranked together.
        newest = rows.groupBy(self.key).agg(F.max("_version").alias("_newest"))
        kept = rows.join(newest, self.key).filter(F.col("_version") == F.col("_newest"))
        return base.join(keys, self.key, "left_anti").select(*base.columns).unionByName(kept.select(*base.columns))

    def changed(self, spark: SparkSession, number: int, *columns: Column) -> DataFrame:
        """What batch ``number`` does to the content: ``columns`` of the rows that come, with ``_sign`` 1, and go, with -1.

        Only buckets that the batch touches are read, with the columns asked for, and only rows of its keys are shuffled.
        Rows of a late batch that stay behind newer ones change nothing. Ask before the batch is compacted.
        """
        log = self._read(spark, "changes").filter(F.col(BATCH) <= number)
        batch = log.filter(F.col(BATCH) == number)
        buckets = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # the batch's folders
        here = F.col(BUCKET).isin(buckets)
        base = self._read(spark, "base").filter(here).withColumn("_source", F.lit(0))
        rows = base.unionByName(log.filter(here).withColumn("_source", F.lit(1)))
        touched = rows.join(batch.select(self.key).distinct(), self.key, "left_semi")
        touched = touched.withColumn("_version", F.struct(*self.order, BATCH, "_source"))
        before = (F.col(BATCH) < number) | (F.col("_source") == 0)
        newest = touched.groupBy(self.key).agg(
            F.max("_version").alias("_after"), F.max(F.when(before, F.col("_version"))).alias("_before")
        )
        came, went = (F.coalesce(F.col("_version") == F.col(v), F.lit(False)).cast("int") for v in ("_after", "_before"))
        found = touched.join(newest, self.key).filter(~F.col(GONE)).select(*columns, (came - went).alias(SIGN))
        return found.filter(F.col(SIGN) != 0)

    def compact(self, spark: SparkSession, upto: int | None = None) -> list[int]:
        """Brings the log to the base and empties it; returns the buckets written.

        Only buckets that the log touches are read and written. They are staged first, so a run that fails midway leaves
        some buckets new and the log in place, and reads give the same rows. Readers at work then repeat their query.
        """
        log = self._read(spark, "changes")
        log = log if upto is None else log.filter(F.col(BATCH) <= upto)
        parts = log.select(BATCH, BUCKET).distinct().collect()  # the log's folders
        buckets = sorted({r[BUCKET] for r in parts})
        if not buckets:
            return []
        staged = shared_dir(spark, "compact")
        self._merged(spark, upto, buckets).write.parquet(staged)
        # Tombstones stay in the base, so every touched bucket has rows and is overwritten.
        rows = spark.read.parquet(staged).hint("rebalance", F.col(BUCKET))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{self.root}/base")
        for number in sorted({r[BATCH] for r in parts}):
            remove_folder(spark, f"{self.root}/changes/{BATCH}={number}")
        remove_folder(spark, staged)
        return buckets


@dataclass(frozen=True)
class Parking:
    """Children that come before their parents (J3, R10): kept with the batch they came in until the parent is there.

    A batch looks up its own children among all parents, and those that wait among its new parents only. So its cost
    follows the batch and what waits, not the tables. Repeating a batch changes nothing.
    """

    root: str
    child_key: str
    foreign_key: str
    schema: T.StructType

    def arrive(self, children: DataFrame, parents: DataFrame, new_parents: DataFrame, number: int) -> DataFrame:
        """Takes a batch; returns the children that have a parent now: of the batch, and of those that waited.

        ``parents`` and ``new_parents`` have the parents' key in their first column; ``parents`` include the new ones.
        """
        spark, names = children.sparkSession, self.schema.fieldNames()
        children = children.select(*names)
        asked = children.select(self.foreign_key).distinct()
        # Of the parents only those that the batch asks for meet its rows.
        known = _as_key(parents, self.foreign_key).join(asked, self.foreign_key, "left_semi")
        adopted = children.join(known, self.foreign_key, "left_semi").select(*names)
        orphans = children.join(known, self.foreign_key, "left_anti").select(*names)
        self._write(orphans, "parked", number)
        late = self.waiting(spark, number - 1).join(_as_key(new_parents, self.foreign_key), self.foreign_key, "left_semi")
        self._write(late.select(self.child_key), "adopted", number)
        found = self._read(spark, "adopted", T.StructType([self.schema[self.child_key]])).filter(F.col(BATCH) == number)
        waited = self._read(spark, "parked", self.schema).filter(F.col(BATCH) < number).join(found, self.child_key, "left_semi")
        return adopted.unionByName(waited.select(*names))

    def waiting(self, spark: SparkSession, number: int) -> DataFrame:
        """Children without a parent after batch ``number``, with their ``age`` in batches and the ``reason``."""
        parked = self._read(spark, "parked", self.schema).filter(F.col(BATCH) <= number)
        adopted = self._read(spark, "adopted", T.StructType([self.schema[self.child_key]])).filter(F.col(BATCH) <= number)
        left = parked.join(adopted.select(self.child_key), self.child_key, "left_anti")
        reason = F.concat(F.lit(f"no parent {self.foreign_key} = "), F.coalesce(F.col(self.foreign_key).cast("string"), F.lit("NULL")))
        return left.select(*self.schema.fieldNames(), (F.lit(number) - F.col(BATCH)).alias("age"), reason.alias("reason"))

    def _write(self, rows: DataFrame, part: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{part}/{BATCH}={number}")

    def _read(self, spark: SparkSession, part: str, schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        try:
            return spark.read.schema(whole).parquet(f"{self.root}/{part}")
        except AnalysisException as error:
            if path_missing(error):
                return spark.createDataFrame([], whole)
            raise


def _as_key(parents: DataFrame, name: str) -> DataFrame:
    return parents.select(F.col(parents.columns[0]).alias(name))
