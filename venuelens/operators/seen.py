"""The set of links met in earlier crawls, on disk, with a sketch for each bucket."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import fingerprint
from ..session import shared_dir
from ..sources.readers import path_missing

BATCH, BUCKET = "_batch", "_bucket"


@dataclass(frozen=True)
class SeenLinks:
    """Fingerprints below ``root/links`` by crawl and hash bucket, and one Bloom sketch a bucket below ``root/sketch``.

    A crawl looks up its links in the sketches, some ten bits a link; only buckets where a sketch says "maybe" are read,
    and only to settle these links exactly. So the result is that of one anti-join with all links met before. New links
    are appended; repeating a crawl changes nothing. ``words`` 64-bit words a bucket and ``hashes`` bits a link set how
    often a sketch says "maybe" in vain: choose about ten bits for each link that a bucket will hold.
    """

    root: str
    buckets: int = 64
    words: int = 1 << 14
    hashes: int = 7

    def new_links(self, links: DataFrame, crawl: int, url: str = "url") -> DataFrame:
        """(url, fingerprint), one row per link not met before ``crawl``; of equal links the smallest url. NULL urls go."""
        spark = links.sparkSession
        keyed = links.filter(F.col(url).isNotNull()).select(F.col(url).alias("url"), fingerprint(F.col(url)).alias("fingerprint"))
        folder = shared_dir(spark, "crawl")
        bucket = F.pmod(F.xxhash64("fingerprint"), F.lit(self.buckets)).cast("int")
        keyed.groupBy("fingerprint").agg(F.min("url").alias("url")).withColumn(BUCKET, bucket).write.parquet(folder)
        once = spark.read.parquet(folder)
        maybe = self._maybe(once, crawl)
        asked = [r[0] for r in maybe.select(BUCKET).distinct().collect()]  # as many as there are buckets, at most
        met = self._read(spark, "links", "fingerprint string, url string").filter((F.col(BATCH) < crawl) & F.col(BUCKET).isin(asked))
        known = met.select("fingerprint").join(maybe.select("fingerprint"), "fingerprint", "left_semi")
        found = once.join(known, "fingerprint", "left_anti").withColumn(BATCH, F.lit(crawl).cast("bigint"))
        # Buckets gather in few files; a large one is spread over several tasks.
        self._write(found.hint("rebalance", F.col(BUCKET)), "links", BATCH, BUCKET)
        added = self._read(spark, "links", "fingerprint string, url string").filter(F.col(BATCH) == crawl)
        sketch = self._bits(added).groupBy(BUCKET, "word").agg(F.bit_or("mask").alias("bits"))
        self._write(sketch.withColumn(BATCH, F.lit(crawl).cast("bigint")), "sketch", BATCH)
        return added.select("url", "fingerprint")

    def _bits(self, links: DataFrame) -> DataFrame:
        """(fingerprint, bucket, word, mask): the bits of each link."""
        places = F.array(*[F.pmod(F.xxhash64("fingerprint", F.lit(i)), F.lit(self.words * 64)) for i in range(self.hashes)])
        spread = links.select("fingerprint", BUCKET, F.explode(F.array_distinct(places)).alias("place"))
        mask: Column = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
        return spread.select("fingerprint", BUCKET, F.shiftright("place", 6).alias("word"), mask.alias("mask"))

    def _maybe(self, links: DataFrame, crawl: int) -> DataFrame:
        sketches = self._read(links.sparkSession, "sketch", "word long, bits long").filter(F.col(BATCH) < crawl)
        whole = sketches.groupBy(BUCKET, "word").agg(F.bit_or("bits").alias("bits"))
        asked = self._bits(links).join(whole, [BUCKET, "word"], "left")
        is_set = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) != 0, F.lit(False))
        return asked.groupBy("fingerprint", BUCKET).agg(F.bool_and(is_set).alias("all")).filter("all")

    def _write(self, rows: DataFrame, part: str, *by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.root}/{part}")

    def _read(self, spark: SparkSession, part: str, columns: str) -> DataFrame:
        schema = f"{columns}, {BATCH} long, {BUCKET} int"
        try:
            return spark.read.schema(schema).parquet(f"{self.root}/{part}")
        except AnalysisException as error:
            if path_missing(error):
                return spark.createDataFrame([], schema)
            raise
