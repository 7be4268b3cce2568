"""Backup and restore of tables."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from .readers import path_missing
from .tables import publish

log = logging.getLogger(__name__)


def snapshot(
    spark: SparkSession, tables: Sequence[str], root: str, now: datetime | None = None
) -> tuple[str, bool, DataFrame]:
    """Every table as Parquet below ``root/backup_<time>``.

    A table that cannot be saved does not stop the others. Returns the backup's
    name, whether it is complete, and (table_name, saved, error) per table.
    """
    name = fv.BACKUP_NAME_PREFIX + (now or datetime.now(timezone.utc)).strftime(fv.BACKUP_TIME_FORMAT)
    status = []
    for table in tables:
        try:
            spark.table(table).write.mode("overwrite").parquet(f"{root}/{name}/{table}")
            status.append((table, True, None))
        except Exception as error:  # any failure of one part is reported, not raised
            log.warning("backup of %s failed: %s", table, error)
            status.append((table, False, str(error).splitlines()[0]))
    report = spark.createDataFrame(status, "table_name string, saved boolean, error string")
    return name, all(s[1] for s in status), report


def restore(
    spark: SparkSession, tables: Sequence[str], root: str, name: str, location: str | None = None
) -> DataFrame:
    """Replace the tables by their copies, ``name`` being a backup below ``root`` or a full path.

    Missing parts are warned about and skipped. Files go to the warehouse, or below
    ``location``. Returns (table_name, restored).
    """
    base = name if "/" in name else f"{root}/{name}"
    status = []
    for table in tables:
        try:
            copy = spark.read.parquet(f"{base}/{table}")
        except AnalysisException as error:
            log.warning("no copy of %s in %s: %s", table, base, error)
            status.append((table, False))
            continue
        publish(spark, table, copy, location)
        status.append((table, True))
    if not any(done for _, done in status):
        raise FileNotFoundError(base)
    return spark.createDataFrame(status, "table_name string, restored boolean").orderBy(F.col("table_name"))


# --- backups that share what has not changed -----------------------------------------

_MANIFEST = "backup string, table_name string, bucket int, rows long, digest string, schema string"


def _digested(table: DataFrame, buckets: int, key: Sequence[str]) -> DataFrame:
    """The rows with the bucket they fall in and a hash of their content."""
    content = F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"})
    place = F.xxhash64(*key) if key else F.xxhash64(content)
    return table.withColumns({"_bucket": F.pmod(place, F.lit(buckets)).cast("int"), "_content": F.sha2(content, 256)})


def _digests(rows: DataFrame) -> DataFrame:
    """(bucket, rows, digest): sums of two 60-bit parts of the row hashes, so the order of rows does not matter."""
    part = lambda at: F.sum(F.conv(F.substring("_content", at, 15), 16, 10).cast("decimal(20,0)")).cast("string")
    return rows.groupBy(F.col("_bucket").alias("bucket")).agg(
        F.count("*").alias("rows"), F.concat_ws("-", part(1), part(16)).alias("digest")
    )


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).parquet(f"{root}/manifests")
    except AnalysisException as error:
        if path_missing(error):
            return spark.createDataFrame([], _MANIFEST)
        raise


def incremental_snapshot(
    spark: SparkSession, tables: dict[str, Sequence[str]], root: str, buckets: int = 64, now: datetime | None = None
) -> tuple[str, bool, DataFrame]:
    """S13 at the cost of what has changed: a manifest of hash buckets by content, buckets already saved are shared.

    ``tables`` gives the columns whose hash makes the buckets, such as the key; none takes the whole row. A table is read
    to find its digests, and its changed buckets once more. A bucket counts as saved once a manifest names it, so a run
    that fails midway leaves nothing that a later one would trust. A table that cannot be saved does not stop the others.
    Returns the backup's name, whether it is complete, and (table_name, saved, written, shared, error).
    """
    name = fv.BACKUP_NAME_PREFIX + (now or datetime.now(timezone.utc)).strftime(fv.BACKUP_TIME_FORMAT)
    status = []
    for table, key in tables.items():
        try:
            rows = spark.table(table)
            shape, marked = rows.schema.json(), _digested(rows, buckets, key)
            held = _manifest(spark, root).filter((F.col("table_name") == table) & (F.col("schema") == shape) & (F.col("backup") < name))
            first = held.groupBy("bucket", "rows", "digest").agg(F.min("backup").alias("backup"))
            found = _digests(marked).join(first, ["bucket", "rows", "digest"], "left").collect()  # a row for each bucket
            changed = [r["bucket"] for r in found if r["backup"] is None]
            if changed:
                new = marked.filter(F.col("_bucket").isin(changed)).drop("_content").hint("rebalance", F.col("_bucket"))
                new.write.mode("overwrite").partitionBy("_bucket").parquet(f"{root}/parts/{table}/_saved={name}")
            parts = [(r["backup"] or name, table, r["bucket"], r["rows"], r["digest"], shape) for r in found]
            if not found:
                parts = [(name, table, None, 0, None, shape)]
            spark.createDataFrame(parts, _MANIFEST).write.mode("overwrite").parquet(f"{root}/manifests/{name}/{table}")
            status.append((table, True, len(changed), len(found) - len(changed), None))
        except Exception as error:  # any failure of one part is reported, not raised
            log.warning("backup of %s failed: %s", table, error)
            status.append((table, False, None, None, str(error).splitlines()[0]))
    report = spark.createDataFrame(status, "table_name string, saved boolean, written int, shared int, error string")
    return name, all(s[1] for s in status), report


def snapshot_rows(spark: SparkSession, root: str, name: str, table: str) -> DataFrame:
    """The rows of a table as of an incremental backup; an error if what is read is not what was saved."""
    parts = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/{name}/{table}").collect()  # a row for each bucket
    schema = T.StructType.fromJson(json.loads(parts[0]["schema"]))
    # One scan of the named parts, however many backups they come from.
    named = [f"{p['backup']}/{p['bucket']}" for p in parts if p["bucket"] is not None]
    folders = T.StructType([*schema.fields, T.StructField("_saved", T.StringType()), T.StructField("_bucket", T.IntegerType())])
    whole = spark.read.schema(folders).parquet(f"{root}/parts/{table}") if named else spark.createDataFrame([], folders)
    whole = whole.filter(F.concat_ws("/", "_saved", "_bucket").isin(named)).drop("_saved")
    content = F.to_json(F.struct(*schema.fieldNames()), {"ignoreNullFields": "false"})
    read = {tuple(r) for r in _digests(whole.withColumn("_content", F.sha2(content, 256))).collect()}
    if read != {(p["bucket"], p["rows"], p["digest"]) for p in parts if p["bucket"] is not None}:
        raise ValueError(f"the parts of {table} in {name} are not those that were saved")
    return whole.select(*schema.fieldNames())


def restore_incremental(
    spark: SparkSession, tables: Sequence[str], root: str, name: str, location: str | None = None
) -> DataFrame:
    """S14 from an incremental backup, of any moment; otherwise as ``restore``."""
    status = []
    for table in tables:
        try:
            rows = snapshot_rows(spark, root, name, table)
        except AnalysisException as error:
            log.warning("no copy of %s in %s: %s", table, name, error)
            status.append((table, False))
            continue
        publish(spark, table, rows, location)
        status.append((table, True))
    if not any(done for _, done in status):
        raise FileNotFoundError(f"{root}/manifests/{name}")
    return spark.createDataFrame(status, "table_name string, restored boolean").orderBy(F.col("table_name"))
