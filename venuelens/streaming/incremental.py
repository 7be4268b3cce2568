"""Incremental load of newly arrived documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..operators.normalize import latest_documents, mark_meals, mark_restaurants, mark_reviews, stored_reviews
from ..operators.outcomes import needs_order, sort_out
from ..operators.tables import latest_by_key, ordered_upsert
from ..plans.views import service_type
from ..session import shared_dir
from ..sources import readers
from ..sources.tables import publish
from .changelog import GONE, ChangeLog
from .counts import Counts
from .grams import GramIndex, holds

BATCH = "_batch"


def run_available(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Feed everything that has arrived since the last run to ``apply(batch, number)``, then stop.

    A batch may be given to ``apply`` again after a failure, under the same
    number, so it has to be idempotent.
    """
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_into(
    table: str, batch: DataFrame, key: str, order: Sequence[str], root: str | None = None
) -> None:
    """R2 on a stored table; the first batch creates it. The order rules over stored and new rows.

    So the table is the same however rows fall into batches, and the same batch twice changes nothing. This rewrites
    the table. For small batches into a large table use ``append_changes``.
    """
    spark = batch.sparkSession
    base = spark.table(table) if spark.catalog.tableExists(table) else batch.limit(0)
    publish(spark, table, ordered_upsert(base, batch, key, order), root)


def append_changes(batch: DataFrame, number: int, changes: str) -> None:
    """Keep a batch in a change log, at a cost that grows with the batch and not with the table.

    The batch is its own partition of the log, so a repeated batch replaces itself.
    """
    numbered = batch.withColumn(BATCH, F.lit(number).cast("bigint"))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(changes)


def current_rows(base: DataFrame, changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """A stored table with its change log applied. The order rules over table and log; of rows equal in it the log's win.

    A log that is small against the table is broadcast, so the table is read
    without a shuffle; ``publish`` the result from time to time and start a new log.
    """
    stored = base.withColumn(BATCH, F.lit(-1).cast("bigint"))
    return ordered_upsert(stored, changes, key, [*order, BATCH]).select(*base.columns)


@dataclass(frozen=True)
class LakeStore:
    """Restaurants, reviews, meals and refused rows below ``root``, kept as change logs.

    The order columns tell which document of an id is the last one; they rule over all batches, so the tables are those
    of one full load whatever the batches were. A batch becomes visible as a whole: readers take the batches up to the
    last one that is complete in all its tables. The counts behind the reports follow each batch, see ``counted``.
    """

    root: str
    order: tuple[StructField, ...]
    meals_order: tuple[StructField, ...] = ()
    buckets: int = 64

    def _log(self, name: str, key: str, schema: StructType, order: tuple[StructField, ...]) -> ChangeLog:
        names = {f.name for f in schema.fields}
        whole = StructType([*schema.fields, *[f for f in order if f.name not in names]])
        return ChangeLog(f"{self.root}/{name}", key, tuple(f.name for f in order), whole, self.buckets)

    @property
    def logs(self) -> dict[str, ChangeLog]:
        return {
            "restaurants": self._log("restaurants", "id", schemas.RESTAURANTS, self.order),
            "reviews": self._log("reviews", "restaurant_id", schemas.REVIEWS, self.order),
            "meals": self._log("meals", "id", schemas.MEALS, self.meals_order),
        }

    @property
    def counts(self) -> dict[str, Counts]:
        """Counts of each table by the columns that the reports group by and average."""
        kinds = {
            "restaurants": [schemas.RESTAURANTS["district_parsed"], schemas.RESTAURANTS["rating"]],
            "reviews": [StructField("service_type", StringType()), schemas.REVIEWS["rating"]],
            "meals": [schemas.MEALS["category"], schemas.MEALS["area"]],
        }
        return {name: Counts(f"{self.root}/counts/{name}", StructType(fields)) for name, fields in kinds.items()}

    def _counted_columns(self, name: str) -> list[Column]:
        made = {"service_type": service_type(F.col("comment"))} if name == "reviews" else {}
        return [made.get(c, F.col(c)).alias(c) for c in self.counts[name].schema.fieldNames()]

    def _count(self, spark: SparkSession, feed: str, number: int, *names: str) -> None:
        # A batch that is complete has been counted, and its rows may be in the base by now.
        if number > self._last(spark, feed):
            for name in names:
                self.counts[name].add(self.logs[name].changed(spark, number, *self._counted_columns(name)), number)

    def counted(self, spark: SparkSession, name: str) -> DataFrame:
        """Counts of a table as of its last complete batch: input of the views with ``weight="n"``, at no read of the table."""
        return self.counts[name].total(spark, self._last(spark, _feed(name)))

    def recount(self, spark: SparkSession) -> None:
        """Counts all tables anew, for a store whose first batches came without counts."""
        for name, counts in self.counts.items():
            last = self._last(spark, _feed(name))
            if last >= 0:
                counts.recount(self.logs[name].current(spark, last).select(*self._counted_columns(name)), last)

    @property
    def names(self) -> GramIndex:
        """Postings for ``search``."""
        return GramIndex(f"{self.root}/names", "id", ("id", "name", "district", "district_parsed"))

    def search(self, spark: SparkSession, term: str) -> DataFrame:
        """Restaurants that hold the term in id, name or district, case and accents aside, by kept postings.

        The rows are those of ``tables.search`` over the table, all pages. Terms under three characters, and those with
        characters that do not stand for one letter, scan the table.
        """
        last = self._last(spark, "documents")
        found = self.names.candidates(spark, term, last)
        held = self.table(spark, "restaurants") if found is None else self.logs["restaurants"].current_of(spark, found, last)
        return held.filter(holds(term, self.names.columns)).select(*schemas.RESTAURANTS.fieldNames())

    def reindex(self, spark: SparkSession) -> None:
        """Drops postings of replaced rows, and merges those of all complete batches."""
        last, log = self._last(spark, "documents"), self.logs["restaurants"]
        self.names.rebuild(log.current(spark, last), log.bucket(), last)

    def add_documents(self, batch: DataFrame, number: int) -> dict[str, dict[str, int]]:
        """A batch of raw documents: read once, its restaurants and reviews added, what is refused kept with its content.

        Returns the counters of both tables.
        """
        spark, order = batch.sparkSession, [f.name for f in self.order]
        found = sort_out(mark_restaurants(batch, order), "restaurants", "id")
        needs_order(found.accepted, "id", order, "restaurants")
        folder = shared_dir(spark, "sync-batch")
        latest_documents(found.accepted, order).write.parquet(folder)
        documents = spark.read.parquet(folder)
        reviews = sort_out(mark_reviews(documents, order), "reviews", "restaurant_id")
        logs = self.logs
        logs["restaurants"].append(documents, number)
        # A document without reviews drops the older ones as well, so each document leaves a tombstone beside its reviews.
        stones = documents.select(F.col("id").alias("restaurant_id"), *order, F.lit(True).alias(GONE))
        rows = stored_reviews(reviews.accepted, order).withColumn(GONE, F.lit(False))
        logs["reviews"].append(rows.unionByName(stones, allowMissingColumns=True), number)
        self._refuse(found.refused.unionByName(reviews.refused), "documents", number)
        self.names.add(documents, logs["restaurants"].bucket(), number)
        self._count(spark, "documents", number, "restaurants", "reviews")
        self._complete(spark, "documents", number)
        return {"restaurants": found.counters, "reviews": reviews.counters}

    def add_meals(self, batch: DataFrame, number: int) -> dict[str, dict[str, int]]:
        """A batch of parsed meals, as ``add_documents`` does for restaurants."""
        order = [f.name for f in self.meals_order]
        found = sort_out(mark_meals(batch, order), "meals", "id")
        needs_order(found.accepted, "id", order, "meals")
        self.logs["meals"].append(latest_by_key(found.accepted, "id", order), number)
        self._refuse(found.refused, "meals", number)
        self._count(batch.sparkSession, "meals", number, "meals")
        self._complete(batch.sparkSession, "meals", number)
        return {"meals": found.counters}

    def _refuse(self, rows: DataFrame, feed: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/rejects/_feed={feed}/{BATCH}={number}")

    def _complete(self, spark: SparkSession, feed: str, number: int) -> None:
        spark.range(1).select(F.lit(number).cast("bigint").alias("number")).write.mode("overwrite").parquet(f"{self.root}/complete/{feed}/{number}")

    def _last(self, spark: SparkSession, feed: str) -> int:
        try:
            done = spark.read.schema("number bigint").option("recursiveFileLookup", True).parquet(f"{self.root}/complete/{feed}")
        except AnalysisException as error:
            if readers.path_missing(error):
                return -1
            raise
        return done.agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """``restaurants``, ``reviews``, ``meals`` or ``rejects`` as of the last complete batch of its feed."""
        if name == "rejects":
            schema = "table string, key string, reason string, content string, _feed string, _batch bigint"
            try:
                return spark.read.schema(schema).parquet(f"{self.root}/rejects")
            except AnalysisException as error:
                if readers.path_missing(error):
                    return spark.createDataFrame([], schema)
                raise
        names = {"restaurants": schemas.RESTAURANTS, "reviews": schemas.REVIEWS, "meals": schemas.MEALS}[name].fieldNames()
        return self.logs[name].current(spark, self._last(spark, _feed(name))).select(*names)

    def compact(self, spark: SparkSession) -> dict[str, list[int]]:
        """Compacts the complete batches of all logs and counts; returns the buckets written of each log."""
        written = {}
        for name, log in self.logs.items():
            last = self._last(spark, _feed(name))
            written[name] = log.compact(spark, last)
            self.counts[name].fold(spark, last)
        return written


def _feed(table: str) -> str:
    return "meals" if table == "meals" else "documents"


def load_new_files(
    store: LakeStore, spark: SparkSession, path: str, checkpoint: str, meals: bool = False,
    schema: StructType | None = None, max_files: int | None = None,
) -> list[dict[str, dict[str, int]]]:
    """Adds the JSON Lines files that have appeared at ``path`` since the last call, restaurants or meals.

    Lines are judged as in ``read_json_lines``. Returns the counters of each batch.
    """
    order = store.meals_order if meals else store.order
    known = schema or (schemas.MEALS_RAW if meals else schemas.RESTAURANTS_RAW)
    whole = StructType([*known.fields, *[f for f in order if f.name not in known.fieldNames()]])
    add, told = store.add_meals if meals else store.add_documents, []
    run_available(
        readers.stream_json_lines(spark, path, whole, max_files), lambda batch, number: told.append(add(batch, number)), checkpoint
    )
    return told
