"""Review-shaped inputs derived from general tables.

The operators expect venues, reviews and meals. These functions shape star
schema and text tables that way, row by row or by key joins, so that the work
grows with the tables. The SQL texts give the same shapes for checking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table for work that is heavy per row, spread over all cores if it has too few splits."""
    return spread(table(spark, folder, name))


# --- rated venues: order lines with the nation of their supplier as district ----

LINE_RATING_SQL = "nullif(ceil(l_quantity / 5) / 2, 0.5)"
DISTRICT_SQL = (
    "CASE n_nationkey WHEN 0 THEN '' WHEN 1 THEN 'null' WHEN 2 THEN 'Unknown' WHEN 3 THEN NULL ELSE n_name END"
)
VENUES_SQL = f"""(
  SELECT l_orderkey || '-' || l_linenumber AS id, {LINE_RATING_SQL} AS rating, {DISTRICT_SQL} AS district_parsed
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def line_rating() -> Column:
    """0.5 to 5 in halves, the lowest one missing."""
    return F.nullif(F.ceil(F.col("l_quantity") / 5) / 2, F.lit(0.5))


def rated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(line_rating().alias("rating"))


def _supplied_lines(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    suppliers, nations = table(spark, folder, "supplier"), table(spark, folder, "nation")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )


def venues(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    district = (
        F.when(key == 0, F.lit(""))
        .when(key == 1, F.lit("null"))
        .when(key == 2, F.lit("Unknown"))
        .when(key == 3, F.lit(None).cast("string"))
        .otherwise(F.col("n_name"))
    )
    return _supplied_lines(table(spark, folder, "lineitem"), spark, folder).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        line_rating().alias("rating"),
        district.alias("district_parsed"),
    )


# --- venues with free-text places ------------------------------------------------

ADDRESS_KIND = "n_nationkey % 4"
PLACES_SQL = f"""(
  SELECT l_orderkey || '-' || l_linenumber AS id, {LINE_RATING_SQL} AS rating,
    CASE WHEN n_nationkey % 5 = 0 THEN n_name
         WHEN {ADDRESS_KIND} IN (0, 1) THEN 'Quận ' || (n_nationkey + 1)
         WHEN {ADDRESS_KIND} = 2 THEN 'Quận Bình Thạnh' ELSE 'Phường Bến Nghé' END AS area
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def free_text_venues(spark: SparkSession, folder: str) -> DataFrame:
    """(rating, district_parsed, district, address, city) with the place in one of four wordings."""
    kind, number = F.col("n_nationkey") % 4, (F.col("n_nationkey") + 1).cast("string")
    return _supplied_lines(wide_table(spark, folder, "lineitem"), spark, folder).select(
        line_rating().alias("rating"),
        F.when(F.col("n_nationkey") % 5 == 0, F.col("n_name")).alias("district_parsed"),
        F.when(kind == 0, F.concat(F.col("s_name"), F.lit(" street, Quận "), number))
        .when(kind == 1, F.concat(F.lit("District "), number, F.lit(", HCMC")))
        .when(kind == 2, F.lit("Q. Bình Thạnh"))
        .alias("district"),
        F.when(kind == 3, F.lit("Ben Nghe Ward, HCMC")).alias("address"),
        F.lit("Ho Chi Minh City 70000 Vietnam").alias("city"),
    )


# --- documents as venues whose lines are reviews ---------------------------------

DOCUMENT_VENUES_SQL = """(
  SELECT doc_id, source, (n_chars % 9 + 2) / 2.0 AS rating, text,
         unnest(string_split(text, chr(10))) AS comment FROM documents)"""


def document_venues(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, name, rating, reviews): every line of a text is one review."""
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda line: F.struct(
            F.col("lang").alias("user"), (F.col("n_chars") % 5 + 1).cast("string").alias("rating"), line.alias("comment")
        ),
    )
    return wide_table(spark, folder, "documents").select(
        "doc_id",
        F.col("source").alias("name"),
        ((F.col("n_chars") % 9 + 2) / 2.0).alias("rating"),
        lines.alias("reviews"),
    )


LABELLED_REVIEWS_SQL = """(
  SELECT doc_id, text AS comment, 1.0 + 3 * quality + 0.5 * toxic AS rating
  FROM documents JOIN labels USING (doc_id))"""


def labelled_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, comment, rating) of the documents that have labels."""
    labels = table(spark, folder, "labels").select(
        "doc_id", (F.lit(1.0) + 3 * F.col("quality") + F.lit(0.5) * F.col("toxic")).cast("double").alias("rating")
    )
    return wide_table(spark, folder, "documents").select("doc_id", F.col("text").alias("comment")).join(labels, "doc_id")


# --- conversations as pages of venues --------------------------------------------

CONVERSATION_LINES_SQL = """(
  SELECT conv_id, turn, role, unnest(lines) AS comment, unnest(range(len(lines))) AS pos
  FROM (SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines FROM conversations))"""


def conversation_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(id, offset, name, rating, reviews): a conversation is a venue, a turn one of its pages, a line a review."""
    reviews = F.transform(
        F.split("text", "\n", -1),
        lambda line: F.struct(
            F.col("role").alias("user"),
            F.concat((F.length(line) % 5 + 1).cast("string"), F.lit(" of 5 bubbles")).alias("rating"),
            line.alias("comment"),
        ),
    )
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("id"),
        F.col("turn").alias("offset"),
        F.concat_ws(" ", "role", "turn").alias("name"),
        F.length("text").cast("string").alias("rating"),
        reviews.alias("reviews"),
    )


# --- raw restaurant and meal documents --------------------------------------------


def raw_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    """Raw documents with messy fields: one per order, the id shared by the orders of a customer."""
    kind = F.col("o_orderkey") % 4
    number = (F.col("o_custkey") % 20 + 1).cast("string")
    orders = wide_table(spark, folder, "orders")
    count = F.floor(F.col("o_totalprice")).cast("bigint").cast("string")
    stars = (F.col("o_orderkey") % 5 + 1).cast("string")
    return orders.select(
        F.concat(F.lit("https://x.example/Restaurant_Review-g1-d"), F.col("o_custkey"), F.lit("-Reviews-a.html")).alias(
            "id"
        ),
        F.when(kind == 1, F.lit("")).otherwise(F.concat(F.lit("Place "), F.col("o_custkey"))).alias("name"),
        F.when(kind == 2, F.concat(stars, F.lit(" of 5"))).otherwise(F.concat(stars, F.lit(".5"))).alias("rating"),
        F.when(kind == 0, F.concat(F.lit("("), count, F.lit(")"))).when(kind == 1, count).alias("review_count"),
        F.when(
            kind != 3, F.concat(F.lit("12 Main street, District "), number, F.lit(", Ho Chi Minh City 70000 Vietnam"))
        ).alias("address"),
        F.when(kind == 3, F.concat(F.lit("Quận "), number)).when(kind == 1, F.lit("unknown")).alias("district"),
        F.lit(None).cast("string").alias("district_parsed"),
        F.when(kind == 0, F.lit("n/a")).otherwise(F.lit("Hà Nội 10000, Vietnam")).alias("city"),
        F.array(
            F.struct(
                F.col("o_orderpriority").alias("user"),
                F.concat(stars, F.lit(" of 5 bubbles")).alias("rating"),
                F.concat(F.lit("  order "), F.col("o_orderkey"), F.lit("\n")).alias("comment"),
            ),
            F.struct(F.lit(" ").alias("user"), stars.alias("rating"), F.lit("").alias("comment")),
            F.struct(F.lit("").alias("user"), F.lit(None).cast("string").alias("rating"), F.lit(" ").alias("comment")),
        ).alias("reviews"),
        "o_orderdate",
        "o_orderkey",
    )


RAW_RESTAURANTS_SQL = """(
  SELECT 'rest_d' || o_custkey AS id,
    CASE WHEN o_orderkey % 4 = 1 THEN 'Unnamed Restaurant' ELSE 'Place ' || o_custkey END AS name,
    CAST(o_orderkey % 5 + 1 + CASE WHEN o_orderkey % 4 = 2 THEN 0.0 ELSE 0.5 END AS DOUBLE) AS rating,
    CASE WHEN o_orderkey % 4 < 2 THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END AS review_count,
    CASE WHEN o_orderkey % 4 = 3 THEN 'Quận ' || (o_custkey % 20 + 1)
         ELSE '12 Main street, District ' || (o_custkey % 20 + 1) || ', Ho Chi Minh City 70000 Vietnam' END AS address,
    CASE WHEN o_orderkey % 4 = 3 THEN 'Quận ' || (o_custkey % 20 + 1) ELSE '' END AS district,
    'Quận ' || (o_custkey % 20 + 1) AS district_parsed,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Ho Chi Minh City' ELSE 'Hà Nội' END AS city,
    o_orderkey, o_orderdate, o_orderpriority
  FROM orders)"""
LATEST_RESTAURANTS_SQL = f"""(
  SELECT * FROM {RAW_RESTAURANTS_SQL} r
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


def raw_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Wide recipe records: one per part, three of the numbered columns filled."""
    blank = F.lit(None).cast("string")
    wide = {1: F.col("p_name"), 2: F.concat(F.lit(" "), F.col("p_brand")), 3: F.lit("  "), 20: F.col("p_type")}
    return table(spark, folder, "part").select(
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_partkey").cast("string")).alias("idMeal"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).alias("strMeal"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_type")).alias("strCategory"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).otherwise(F.lit("")).alias("strArea"),
        F.concat_ws(" ", F.lit("Use"), "p_name").alias("strInstructions"),
        *[wide.get(i, blank).alias(f"strIngredient{i}") for i in range(1, 21)],
    )


PARSED_RECIPES_SQL = """(
  SELECT 'meal_' || p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS name,
    CASE WHEN p_size % 3 <> 0 THEN p_type END AS category,
    CASE WHEN p_size % 5 <> 0 THEN p_brand ELSE '' END AS area,
    'Use ' || p_name AS instructions, [p_name, p_brand, p_type] AS ingredients
  FROM part WHERE p_partkey % 11 <> 0)"""
