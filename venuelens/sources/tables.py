"""Managed tables: create, replace, wipe."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..session import remove_folder

VERSION = re.compile(r"__v([0-9a-f]{32})$")

TABLES: dict[str, tuple[T.StructType, dict[str, object]]] = {
    "restaurants": (schemas.RESTAURANTS, schemas.RESTAURANT_DEFAULTS),
    "reviews": (schemas.REVIEWS, schemas.REVIEW_DEFAULTS),
    "meals": (schemas.MEALS, schemas.MEAL_DEFAULTS),
}


def _versions(spark: SparkSession, name: str) -> list[str]:
    database, _, table = name.rpartition(".")
    rows = spark.sql(f"SHOW TABLES {'IN ' + database if database else ''} LIKE '{table}__v*'").collect()
    names = [r["tableName"] for r in rows if r["tableName"].rpartition("__v")[0] == table.lower()]
    prefix = f"{database}." if database else ""
    return [prefix + n for n in names if VERSION.search(n)]


def _drop(spark: SparkSession, version: str) -> None:
    """Drops a version and its files; Spark itself leaves those of a table with a path of its own."""
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {version}").filter("col_name = 'Location'").collect()
    spark.sql(f"DROP TABLE IF EXISTS {version}")
    for row in place:
        remove_folder(spark, row["data_type"])


def publish(spark: SparkSession, name: str, df: DataFrame, root: str | None = None) -> None:
    """Replace the content of ``name`` by ``df``, which may read from ``name`` itself.

    The rows go to a new table; then the view ``name`` is pointed at it, which is
    one catalog step; then older tables are dropped with their files. A run that
    stops midway leaves the old content in place. Every version has a name of its
    own, so two writers do not meet. Files go to the warehouse, or below ``root``.
    """
    old = _versions(spark, name)
    new = f"{name}__v{uuid.uuid4().hex}"
    writer = df.write.format("parquet").mode("errorifexists")
    if root:
        writer = writer.option("path", f"{root}/{new}")
    writer.saveAsTable(new)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {new}")
    for version in old:
        _drop(spark, version)


def create_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """The three tables, empty, where they do not exist yet."""
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, (schema, _) in TABLES.items():
        if not spark.catalog.tableExists(prefix + table):
            publish(spark, prefix + table, spark.createDataFrame([], schema))
    return [prefix + t for t in TABLES]


def evolve_tables(spark: SparkSession, database: str | None = None) -> None:
    """Bring stored tables of an older shape to the current one; tables that fit already are left alone."""
    prefix = f"{database}." if database else ""
    for table, (schema, defaults) in TABLES.items():
        current = spark.table(prefix + table)
        shape = lambda kind: [(f.name, f.dataType) for f in kind.fields]
        if shape(current.schema) != shape(schema):
            publish(spark, prefix + table, schemas.conform(current, schema, defaults))


def wipe(spark: SparkSession, database: str | None = None) -> None:
    """Drop the tables, or the whole database when one is named."""
    if database:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
        return
    for table in TABLES:
        versions = _versions(spark, table)
        spark.sql(f"DROP VIEW IF EXISTS {table}")
        for version in versions:
            _drop(spark, version)
