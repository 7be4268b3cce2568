"""Postings of folded trigrams, kept up batch by batch, for searches that do not scan the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.places import accented_letters, strip_accents
from ..functions.text import any_of
from ..session import remove_folder
from ..sources.readers import path_missing
from .changelog import BATCH, BUCKET

SIZE = 3
GRAM, PART = "gram", "_part"
#: Stands for rows whose text has characters that folding may treat otherwise than the search does.
ANY = ""
#: Trigrams of a term that are looked up; one bit each. Longer terms are settled when candidates are verified.
LOOKED_UP = 60


def _folded(value: Column) -> Column:
    return F.lower(strip_accents(value))


def _plain(value: Column) -> Column:
    """Only characters that stand for one letter each, so that the trigrams of a match are those of its text."""
    # Looked up in a map: a class of all accented letters in the pattern would be tried letter by letter.
    return ~F.translate(value, accented_letters(), "").rlike(r"[^\t-\r\x20-\x7E]")


def _grams(folded: Column) -> Column:
    starts = F.sequence(F.lit(1), F.length(folded) - (SIZE - 1))
    return F.when(F.length(folded) >= SIZE, F.transform(starts, lambda i: F.substring(folded, i, F.lit(SIZE)))).otherwise(
        F.array().cast("array<string>")
    )


@dataclass(frozen=True)
class GramIndex:
    """Which keys of a kept table hold a trigram in any of some text columns, without case and accents.

    Postings only ever name too many keys: those of replaced rows stay until ``rebuild``, and what is found is verified
    against the table. A batch writes its own partition; repeating it changes nothing. Postings are partitioned by batch
    and hash of the trigram, and sorted by it, so a term reads a few parts of them.
    """

    root: str
    key: str
    columns: tuple[str, ...]
    parts: int = 16

    def add(self, rows: DataFrame, home: Column, number: int) -> None:
        """The rows of batch ``number``; ``home`` is the bucket of the table that a row lies in."""
        self._write(rows, home, number, "overwrite")

    def rebuild(self, rows: DataFrame, home: Column, number: int) -> None:
        """Postings of the whole content after batch ``number`` in place of those of all batches up to it."""
        spark = rows.sparkSession
        older = [r[0] for r in self._read(spark).filter(F.col(BATCH) < number).select(BATCH).distinct().collect()]
        if older:
            self._write(rows, home, number, "append")
            for batch in older:
                remove_folder(spark, f"{self.root}/{BATCH}={batch}")

    def _postings(self, rows: DataFrame, home: Column) -> DataFrame:
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in self.columns]
        # Folded in a step of its own: each trigram would fold the whole text again.
        folded = rows.select(
            self.key, home.alias(BUCKET), any_of(~_plain(t) for t in texts).alias("_any"), *[_folded(t).alias(f"_text{i}") for i, t in enumerate(texts)]
        )
        grams = [_grams(F.col(f"_text{i}")) for i in range(len(texts))]
        held = F.concat(*grams, F.when(F.col("_any"), F.array(F.lit(ANY))).otherwise(F.array()))
        return folded.select(self.key, BUCKET, F.explode(F.array_distinct(held)).alias(GRAM))

    def _write(self, rows: DataFrame, home: Column, number: int, mode: str) -> None:
        posted = self._postings(rows, home)
        # A frequent trigram is spread over several tasks, and so files. They are written in the order they are sorted in:
        # a constant column among the folders would have Spark sort them once more.
        whole = posted.withColumn(PART, self._part(F.col(GRAM))).hint("rebalance", F.col(PART)).sortWithinPartitions(PART, GRAM)
        whole.write.mode(mode).partitionBy(PART).parquet(f"{self.root}/{BATCH}={number}")

    def _part(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(self.parts)).cast("int")

    def _read(self, spark: SparkSession) -> DataFrame:
        schema = f"{self.key} string, {BUCKET} int, {GRAM} string, {BATCH} long, {PART} int"
        try:
            return spark.read.schema(schema).parquet(self.root)
        except AnalysisException as error:
            if path_missing(error):
                return spark.createDataFrame([], schema)
            raise

    def candidates(self, spark: SparkSession, term: str, upto: int) -> DataFrame | None:
        """(key, bucket) of all rows that may hold the term, and maybe others; None if the term calls for a scan."""
        # Folded by the expressions that fold the rows: one constant row, no job.
        value = F.lit(term)
        grams = F.slice(F.array_distinct(_grams(_folded(value))), 1, LOOKED_UP)
        asked = spark.range(1).select(_plain(value).alias("plain"), grams.alias("grams"), F.transform(F.concat(grams, F.array(F.lit(ANY))), self._part).alias("parts")).first()
        if not asked.plain or not asked.grams:
            return None
        wanted = F.col(PART).isin(sorted(set(asked.parts))) & F.col(GRAM).isin([*asked.grams, ANY])
        place = F.array_position(F.array(*[F.lit(g) for g in asked.grams]), F.col(GRAM)).cast("int")
        all_of_them = (1 << len(asked.grams)) - 1
        bit = F.when(F.col(GRAM) == ANY, F.lit(all_of_them).cast("bigint")).otherwise(F.call_function("shiftleft", F.lit(1).cast("bigint"), place - 1))
        found = self._read(spark).filter(wanted & (F.col(BATCH) <= upto)).groupBy(self.key, BUCKET).agg(F.bit_or(bit).alias("_held"))
        return found.filter(F.col("_held") == F.lit(all_of_them)).select(self.key, BUCKET)


def holds(term: str, columns: Sequence[str]) -> Column:
    """The test that candidates and scanned rows have to pass: as in ``tables.search``."""
    needle = F.collate(F.lit(term), "UNICODE_CI_AI")
    return any_of(F.contains(F.collate(F.col(c), "UNICODE_CI_AI"), needle) for c in columns)
