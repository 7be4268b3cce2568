"""Reading documents, seeds, tables and result files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from .. import schemas
from ..session import shared_dir

SEQUENCE = "_seq"


def path_missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or str(error))


def reading_order() -> Column:
    """The place of a row in its input: files by path, then the split within the file, then the row within the split.

    A task may read several splits and larger files first, so the row number alone is no order over files.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )


def _is_whole_object(line: Column) -> Column:
    """The line is one JSON object and nothing else. Parsers stop behind a first value; in brackets they can't.

    The line is parsed once: what parses and starts with a brace is an object, and only the number of elements is asked
    for, so none of them is converted. A line that ends otherwise, as one cut off does, can't close the brackets unless it
    holds one itself, and isn't parsed: failing costs far more than this test.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    elements = F.try_variant_get(listed, "$", "array<boolean>")
    text = F.btrim(line, F.lit(" \t\r\n"))
    may_be = text.startswith("{") & (text.endswith("}") | line.contains("]"))
    return F.coalesce(may_be & (F.size(elements) == 1), F.lit(False))


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, sequence: bool = False
) -> DataFrame:
    """One object per line; lines that are anything else, cut off or followed by other text are left out.

    A line with one unfit field keeps its other fields. ``sequence`` adds
    ``_seq``, the reading order over all files, for "last one wins" steps.
    """
    lines = spark.read.text(path)
    extra = []
    if sequence:
        lines, extra = lines.select("value", reading_order().alias(SEQUENCE)), [SEQUENCE]
    return lines.filter(_is_whole_object(F.col("value"))).select(F.from_json("value", schema).alias("d"), *extra).select("d.*", *extra)


def stream_json_lines(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """S2 for files that arrive one after the other, with the same rule for lines."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path).filter(_is_whole_object(F.col("value")))
    return lines.select(F.from_json("value", schema).alias("d")).select("d.*")


def read_documents_with_presence(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S2 plus ``_present``, the names of the fields each line has, for ``merge_upsert``."""
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return lines.select(
        F.from_json("value", schema).alias("d"), F.json_object_keys("value").alias("_present")
    ).filter(F.col("_present").isNotNull()).select("d.*", "_present")


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType, sequence: bool = False, check: bool = True
) -> DataFrame | None:
    """Files that each hold one JSON array; None when the path is missing, ValueError when it is no array.

    Each file is parsed by one task. ``read_large_json_array`` reads a file by byte ranges.
    """
    try:
        df = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    except AnalysisException as error:
        if path_missing(error):
            return None
        raise
    if check:
        _check_arrays(spark.read.option("recursiveFileLookup", True).text(path))
    return df.withColumn(SEQUENCE, reading_order()) if sequence else df


def _check_arrays(lines: DataFrame) -> None:
    # The first line of each file that is not blank: by split, then by position within it.
    not_array = (
        lines.filter(F.length(F.trim("value")) > 0)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("line")).alias("at"),
            F.substring(F.ltrim("value"), 1, 1).alias("start"),
        )
        .groupBy("file")
        .agg(F.min_by("start", "at").alias("first"))
        .filter(F.col("first") != "[")
        .limit(1)
        .collect()
    )
    if not_array:
        raise ValueError(f"{not_array[0][0]} must hold a JSON array at the top level")


_STRING = r'"(?:[^"\\]|\\.)*+"'


def _brackets(code: Column) -> Column:
    """How far a piece of text outside strings goes down into objects and arrays, less how far it comes up."""
    return F.length(F.regexp_replace(code, r"[^{\[]+", "")) - F.length(F.regexp_replace(code, r"[^}\]]+", ""))


_SPLIT = ["file", "split"]


def _running(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows of a file before this one; ``<name>_0`` is that sum where its split starts."""
    here = Window.partitionBy(*_SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(value).over(here), F.lit(0)) + F.col(f"{name}_0"))


def _starts(splits: DataFrame, value: str, name: str) -> DataFrame:
    """Adds ``<name>_0`` to the splits of the files, one row each, and writes them, so that no later step works them out again."""
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    folder = shared_dir(splits.sparkSession, f"array-{name}")
    splits.withColumn(f"{name}_0", F.coalesce(F.sum(value).over(before), F.lit(0))).write.parquet(folder)
    return splits.sparkSession.read.parquet(folder)


def _steps(strings: Column) -> tuple[Column, Column]:
    """By the quotes before a piece: how many levels it goes down with the brace behind it, and whether that brace counts."""
    opens, closes = strings % 2 == 1, (strings + F.col("quotes")) % 2 == 0
    # Behind each piece but a file's last one stands the brace, which counts unless it is inside a string.
    ends = F.coalesce(F.col("row") < F.col("last"), F.lit(True)) & closes
    return F.when(opens, F.col("inside")).otherwise(F.col("outside")) - ends.cast("int"), ends


def _by_start(marks: DataFrame) -> DataFrame:
    """(start, after, down, ended) of each split, whether it starts outside (0) or inside (1) a string: levels gone down, and
    braces that count, by the depth behind them as seen from the start of the split."""
    here = Window.partitionBy(*_SPLIT).orderBy("row")
    quotes = F.coalesce(F.sum("quotes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows, states = marks.withColumn("strings", quotes), []
    for start in (0, 1):
        step, ends = _steps(F.col("strings") + start)
        rows = rows.withColumns({f"step{start}": step, f"ends{start}": ends.cast("int")})
        after = F.sum(f"step{start}").over(here.rowsBetween(Window.unboundedPreceding, 0))
        states.append(F.struct(F.lit(start).alias("start"), after.alias("after"), F.col(f"step{start}").alias("step"), F.col(f"ends{start}").alias("ends")))
    both = rows.select(*_SPLIT, *[state.alias(f"state{i}") for i, state in enumerate(states)]).select(*_SPLIT, F.explode(F.array("state0", "state1")).alias("s"))
    return both.groupBy(*_SPLIT, "s.start", "s.after").agg(F.sum("s.step").alias("down"), F.sum("s.ends").alias("ended"))


def read_large_json_array(spark: SparkSession, path: str, schema: T.StructType, sequence: bool = False) -> DataFrame | None:
    """S1 by byte ranges: a file that holds one array is read by as many tasks as it has splits, also if it is one line.

    The text is cut behind every closing brace. A piece tells for both states it may start in, inside or outside a string,
    how it leaves the strings and how many levels it goes down; running sums over the pieces settle the state and the depth
    at each of them. A brace that comes up to depth 1 ends an element, and the pieces of an element are put together again
    and parsed. Elements that are no objects are left out. None when the path is missing; ValueError when a file is no
    array or its brackets do not close. ``sequence`` adds ``_seq``, the place of an element in its file.

    The pieces are written once, so the file itself is read once. The sums at the start of each split are settled by
    one pass that leaves the texts out; the next one moves each text twice, to its split and to its element.
    """
    try:
        pieces = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    except AnalysisException as error:
        if path_missing(error):
            return None
        raise
    outside = F.regexp_replace(F.regexp_replace("value", _STRING, ""), r'"(?s).*$', "")
    inside_text = F.regexp_replace("value", r'^(?s)(?:[^"\\]|\\.)*+"?', "")
    inside = F.regexp_replace(F.regexp_replace(inside_text, _STRING, ""), r'"(?s).*$', "")
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), '[^"]+', "")) % 2
    parts = pieces.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"),
        "value", quotes.alias("quotes"), _brackets(outside).alias("outside"), _brackets(inside).alias("inside"), F.col("value").rlike(r"^\s*+\[").alias("array"),
    )
    folder = shared_dir(spark, "array-pieces")
    parts.write.parquet(folder)
    rows = spark.read.parquet(folder)
    marks, rows = rows.drop("value", "array"), rows.drop("array")
    splits = spark.read.parquet(folder).groupBy(*_SPLIT).agg(F.sum("quotes").alias("in_all"), F.max("row").alias("last"), F.min_by("array", "row").alias("array"))
    following = F.lead("split").over(Window.partitionBy("file").orderBy("split"))
    splits = _starts(splits.withColumn("last", F.when(following.isNull(), F.col("last"))), "in_all", "strings")
    by_start = _by_start(marks.join(splits.select(*_SPLIT, "last"), _SPLIT)).join(splits.select(*_SPLIT, "strings_0"), _SPLIT)
    folder = shared_dir(spark, "array-depths")  # a row for each depth of each split
    by_start.filter(F.col("start") == F.col("strings_0") % 2).drop("start", "strings_0").write.parquet(folder)
    depths = spark.read.parquet(folder)
    splits = _starts(splits.join(depths.groupBy(*_SPLIT).agg(F.sum("down").alias("down")), _SPLIT), "down", "depth")
    faults = splits.groupBy("file").agg(
        F.min_by("array", "split").alias("array"), F.max_by(F.col("depth_0") + F.col("down"), "split").alias("end"),
    ).filter(~F.col("array") | (F.col("end") != 0)).limit(1).collect()
    if faults:
        raise ValueError(f"{faults[0][0]} must hold a JSON array at the top level")
    known = splits.select(*_SPLIT, "last", "strings_0", "depth_0")
    top = F.coalesce(F.sum(F.when(F.col("depth_0") + F.col("after") == 1, F.col("ended"))), F.lit(0))
    splits = _starts(known.join(depths, _SPLIT).groupBy(*known.columns).agg(top.alias("ended")), "ended", "element")
    rows = _running(rows.join(splits.drop("ended"), _SPLIT), "quotes", "strings")
    step, ends = _steps(F.col("strings"))
    rows = _running(rows.withColumns({"step": step, "ends": ends, "braced": F.coalesce(F.col("row") < F.col("last"), F.lit(True))}), "step", "depth")
    rows = _running(rows.withColumn("end", (F.col("ends") & (F.col("depth") + F.col("step") == 1)).cast("int")), "end", "element")
    rows = rows.select("file", "split", "row", "value", "braced", "end", "element")
    texts = rows.groupBy("file", "element").agg(
        F.array_sort(F.collect_list(F.struct("split", "row", "value", "braced"))).alias("parts"), F.max("end").alias("whole")
    )
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["value"], F.when(p["braced"], "}").otherwise(""))), "")
    found = texts.filter("whole = 1").select("file", "element", F.regexp_replace(text, r"^[^{]*+", "").alias("value"))
    documents = found.select(F.from_json("value", schema).alias("d"), F.struct("file", "element").alias(SEQUENCE))
    return documents.select("d.*", *([SEQUENCE] if sequence else []))


def read_seed(spark: SparkSession, path: str, schema: T.StructType, required: bool = False) -> DataFrame:
    """A seed list; empty when the file is missing, unless it is required."""
    df = read_json_array(spark, path, schema, check=False)
    if df is not None:
        return df
    if required:
        raise FileNotFoundError(path)
    return spark.createDataFrame([], schema)


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """S5, reading side: a table over JDBC. With a partition column and its bounds the table is read in parallel.

    Needs the driver of the database on the class path.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


EXTERNAL_TABLES = {
    fv.NESTED_RESTAURANTS_TABLE: ("restaurants", schemas.NESTED_RESTAURANTS),
    fv.NESTED_MEALS_TABLE: ("meals", schemas.MEALS_RAW),
    fv.RESTAURANTS_TABLE: (fv.RESTAURANTS_TABLE, schemas.RESTAURANTS),
    fv.REVIEWS_TABLE: (fv.REVIEWS_TABLE, schemas.REVIEWS),
    fv.MEALS_TABLE: (fv.MEALS_TABLE, schemas.MEALS),
}


def create_external_tables(
    spark: SparkSession, root: str, database: str | None = None, file_format: str = "json"
) -> list[str]:
    """S3: the five external tables over the lake folders below ``root``; existing declarations are replaced."""
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (folder, schema) in EXTERNAL_TABLES.items():
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
        spark.catalog.createTable(prefix + name, path=f"{root}/{folder}", source=file_format, schema=schema)
    return [prefix + name for name in EXTERNAL_TABLES]


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of ``key<TAB>value`` lines, JSON decoded where possible, else as they are."""
    parts = F.split("value", "\t", 2)
    lines = spark.read.text(path).filter(F.contains("value", F.lit("\t"))).select(
        F.get(parts, 0).alias("k"), F.get(parts, 1).alias("v")
    )
    return lines.select(_decoded("k").alias("key"), _decoded("v").alias("value"))


def _decoded(column: str) -> F.Column:
    """Text of a JSON value: strings lose their quotes, other values keep their JSON form."""
    value = F.try_parse_json(F.col(column))
    is_string = F.schema_of_variant(value) == "STRING"
    return F.when(is_string, F.try_variant_get(value, "$", "string")).otherwise(F.col(column))


def results_summary(spark: SparkSession, path: str, n: int = 10) -> tuple[int, DataFrame]:
    """Record count and the first n records."""
    results = read_results(spark, path)
    return results.count(), results.limit(n)
