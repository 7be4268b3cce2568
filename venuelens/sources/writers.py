"""Writing lake files and results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, as JSON readers expect them."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def export_documents(df: DataFrame) -> DataFrame:
    """Documents with ``_id`` named ``id``, as text."""
    if "_id" not in df.columns:
        return df
    rest = [c for c in df.columns if c not in ("_id", "id")]
    return df.select(F.col("_id").cast("string").alias("id"), *rest)


def export_table(df: DataFrame, table: str) -> DataFrame:
    """The restaurants table by its column list, other tables whole; decimals as doubles."""
    columns = schemas.RESTAURANTS.fieldNames() if table == "restaurants" else df.columns
    return plain_numbers(df.select(*columns))


def publish_files(df: DataFrame, path: str, file_format: str = "json") -> bool:
    """Replace the files at ``path``; with no rows at all the old files stay. Tells whether it wrote."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").format(file_format).save(path)
    return True


#: Rows of one JSON array file.
ARRAY_ROWS = 10_000


def save_seed(df: DataFrame, path: str) -> None:
    """Collected records as JSON arrays, the form that ``read_seed`` takes: one file up to ``ARRAY_ROWS`` rows, more beyond."""
    write_json_arrays(df, path, F.floor(F.monotonically_increasing_id() / ARRAY_ROWS))


def write_json_arrays(df: DataFrame, path: str, part: Column) -> None:
    """Files that each hold one JSON array with the rows of one ``part``, which should grow in number with the table."""
    arrays = df.groupBy(part.alias("part")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.repartition("part").write.mode("overwrite").partitionBy("part").text(path)


def result_lines(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """One text column: JSON key, tab, JSON value (an object when there are several values)."""

    def scalar(column: Column) -> Column:
        in_array = F.to_json(F.array(column))
        return F.substring(in_array, F.lit(2), F.length(in_array) - 2)

    value = scalar(F.col(values[0])) if len(values) == 1 else F.to_json(F.struct(*values))
    return df.select(F.concat_ws("\t", scalar(F.col(key)), value).alias("value"))


def write_results(df: DataFrame, path: str, key: str, values: Sequence[str]) -> None:
    """Replace a job's result folder."""
    result_lines(df, key, values).write.mode("overwrite").text(path)
