"""Every operator as a runnable query over the given tables, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from .. import schemas
from ..functions import documents as docs
from ..functions import numbers, places, sql, text, urls
from ..operators import jobs, normalize, pages, quality, tables, terms
from ..operators.keys import DenseKeys
from ..operators.seen import SeenLinks
from ..session import shared_dir
from ..sources import readers, snapshots, writers
from ..sources.tables import wipe
from ..streaming import incremental
from ..streaming.changelog import Parking
from ..streaming.counts import ROWS
from . import ingest, reports, runner, samples, views
from .samples import table, wide_table

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    run: Run
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        CASES[name] = Case(run, sql)
        return run

    return add


# === reports (V) ==================================================================

_RATED_DISTRICT = "district_parsed NOT IN ('', 'null', 'Unknown') AND rating IS NOT NULL"
_V1 = f"""SELECT district_parsed AS district, round(avg(rating), 2) AS avg_rating, count(*) AS total_count
FROM {samples.VENUES_SQL} v WHERE {_RATED_DISTRICT} GROUP BY district_parsed"""
_V4 = f"""SELECT district_parsed AS district, count(*) AS restaurant_count, round(avg(rating), 2) AS avg_rating
FROM {samples.VENUES_SQL} v WHERE district_parsed NOT IN ('', 'Unknown') GROUP BY district_parsed"""


@case("V1_rating_by_district", _V1)
def _(spark, folder):
    return views.rating_by_district(samples.venues(spark, folder))


@case("V2_category_frequency", "SELECT lang AS category, count(*) AS cnt FROM documents "
      "WHERE lang NOT IN ('', 'null') GROUP BY lang")
def _(spark, folder):
    return views.category_frequency(table(spark, folder, "documents"), "lang")


_SHIFTED = f"(SELECT {samples.LINE_RATING_SQL} + 0.5 AS rating FROM lineitem)"
_HISTOGRAM = """CASE WHEN rating < 2.0 THEN '1-2 sao (Kem)' WHEN rating < 3.0 THEN '2-3 sao (Duoi TB)'
 WHEN rating < 4.0 THEN '3-4 sao (Trung binh)' WHEN rating < 4.5 THEN '4-4.5 sao (Tot)'
 WHEN rating <= 5.0 THEN '4.5-5 sao (Xuat sac)' ELSE 'Chua co danh gia' END"""


@case("V3_rating_histogram", f"SELECT {_HISTOGRAM} AS rating_group, count(*) AS restaurant_count "
      f"FROM {_SHIFTED} r WHERE rating IS NOT NULL GROUP BY 1")
def _(spark, folder):
    rated = samples.rated_lines(spark, folder).select((F.col("rating") + 0.5).alias("rating"))
    return views.rating_histogram(rated)


@case("V4_top_districts", _V4)
def _(spark, folder):
    return views.top_districts(samples.venues(spark, folder))


@case("V5_review_distribution", f"SELECT CAST(trunc(rating) AS INTEGER) AS stars, count(*) AS cnt "
      f"FROM {_SHIFTED} r WHERE rating BETWEEN 1 AND 5 GROUP BY 1")
def _(spark, folder):
    rated = samples.rated_lines(spark, folder).select((F.col("rating") + 0.5).alias("rating"))
    return views.review_distribution(rated)


_LIKE_PATTERNS = ("%ing the%", "%sch%ein ei%", "%que la%", "%zzzz%")


def _service_sql(patterns) -> str:
    test = " OR ".join(f"lower(comment) LIKE '{p}'" for p in patterns)
    return f"""SELECT CASE WHEN {test} THEN 'Delivery' ELSE 'Dine-in' END AS service_type,
 round(avg(rating), 3) AS avg_rating, count(*) AS review_count
FROM {samples.LABELLED_REVIEWS_SQL} r WHERE comment <> '' AND rating IS NOT NULL GROUP BY 1"""


@case("V6_delivery_sentiment", _service_sql(_LIKE_PATTERNS))
def _(spark, folder):
    return views.delivery_sentiment(samples.labelled_reviews(spark, folder), patterns=_LIKE_PATTERNS)


@case("V6_delivery_sentiment_default_words", _service_sql(fv.DELIVERY_LIKE_PATTERNS))
def _(spark, folder):
    return views.delivery_sentiment(samples.labelled_reviews(spark, folder))


@case("V6_delivery_sentiment_both_labels", _service_sql(fv.DELIVERY_LIKE_PATTERNS).replace(
    samples.LABELLED_REVIEWS_SQL, f"(SELECT comment || CASE WHEN doc_id % 3 = 0 THEN ' Giao hàng nhanh' ELSE '' END AS comment, rating FROM {samples.LABELLED_REVIEWS_SQL} l)"))
def _(spark, folder):
    """The default words, with every third review saying so."""
    said = F.when(F.col("doc_id") % 3 == 0, F.lit(" Giao hàng nhanh")).otherwise(F.lit(""))
    return views.delivery_sentiment(samples.labelled_reviews(spark, folder).withColumn("comment", F.concat("comment", said)))


@case("V7_area_frequency", "SELECT source AS area, count(*) AS meal_count FROM documents "
      "WHERE source NOT IN ('', 'null') GROUP BY source")
def _(spark, folder):
    return views.area_frequency(table(spark, folder, "documents"), "source")


def report_bundle(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return reports.report_bundle(
        lambda: samples.venues(spark, folder),
        lambda: samples.labelled_reviews(spark, folder),
        lambda: table(spark, folder, "documents").select(F.col("source").alias("category")),
    )


@case("V8_report_rating_by_district", f"{_V1} ORDER BY avg_rating DESC, district LIMIT 20")
def _(spark, folder):
    return report_bundle(spark, folder)["view_rating_by_district"]


@case("V8_report_category_frequency", "SELECT source AS category, count(*) AS cnt FROM documents "
      "GROUP BY source ORDER BY cnt DESC, category LIMIT 15")
def _(spark, folder):
    return report_bundle(spark, folder)["view_cuisine_frequency"]


@case("V8_report_top_districts", f"{_V4} ORDER BY restaurant_count DESC, district LIMIT 20")
def _(spark, folder):
    return report_bundle(spark, folder)["view_top_districts"]


@case("V8_report_rating_histogram", f"""SELECT {_HISTOGRAM} AS rating_group, count(*) AS restaurant_count
FROM {samples.VENUES_SQL} v WHERE rating IS NOT NULL GROUP BY 1""")
def _(spark, folder):
    return report_bundle(spark, folder)["view_rating_histogram"]


@case("V8_report_review_distribution", f"""SELECT CAST(trunc(rating) AS INTEGER) AS stars, count(*) AS cnt
FROM {samples.LABELLED_REVIEWS_SQL} r WHERE rating BETWEEN 1 AND 5 GROUP BY 1""")
def _(spark, folder):
    return report_bundle(spark, folder)["view_review_distribution"]


@case("V8_report_delivery_sentiment", _service_sql(fv.DELIVERY_LIKE_PATTERNS))
def _(spark, folder):
    return report_bundle(spark, folder)["view_delivery_sentiment"]


@case("V9_free_sql", f"SELECT district_parsed, max(rating) AS best, count(*) AS n FROM {samples.VENUES_SQL} v "
      "WHERE rating >= 3 GROUP BY district_parsed HAVING count(*) > 10")
def _(spark, folder):
    samples.venues(spark, folder).createOrReplaceTempView("venues_for_sql")
    return reports.query(
        spark,
        "SELECT district_parsed, max(rating) AS best, count(*) AS n FROM venues_for_sql "
        "WHERE rating >= 3 GROUP BY district_parsed HAVING count(*) > 10",
    )


@case("V10_raw_rating_histogram", f"SELECT {samples.LINE_RATING_SQL} AS rating, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark, folder):
    return views.raw_rating_histogram(samples.rated_lines(spark, folder))


@case("V11_best_districts", f"{_V1} ORDER BY avg_rating DESC, district LIMIT 10")
def _(spark, folder):
    return views.best_districts(samples.venues(spark, folder))


@case("V12_table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) = 0 AS is_empty FROM {t}"
    for t in ("lineitem", "documents", "events", "pages")))
def _(spark, folder):
    return quality.table_counts({t: table(spark, folder, t) for t in ("lineitem", "documents", "events", "pages")})


@case("V12_parse_ratio", f"""SELECT count(*) AS total,
 count(*) - count(*) FILTER (WHERE district_parsed = 'Unknown') AS parsed,
 count(*) FILTER (WHERE district_parsed = 'Unknown') / count(*) AS unknown_share,
 count(*) FILTER (WHERE district_parsed = 'Unknown') / count(*) > 0.8 AS warning FROM {samples.VENUES_SQL} v""")
def _(spark, folder):
    return quality.parse_ratio(samples.venues(spark, folder))


# === jobs (A) =====================================================================


@case("A1_rating_by_area", f"""SELECT area, round_even(avg(rating), 2) AS avg_rating, count(*) AS restaurant_count
FROM {samples.PLACES_SQL} p WHERE rating IS NOT NULL GROUP BY area""")
def _(spark, folder):
    return jobs.rating_by_area(samples.free_text_venues(spark, folder))


@case("A1_rating_by_area_few_places", f"""SELECT area, round_even(avg(rating), 2) AS avg_rating, count(*) AS restaurant_count
FROM {samples.PLACES_SQL} p WHERE rating IS NOT NULL GROUP BY area""")
def _(spark, folder):
    """Places that repeat, each worked out once."""
    return jobs.rating_by_area(samples.free_text_venues(spark, folder), few_places=True)


@case("A2_tag_count", """SELECT tag, count(*) AS n
FROM (SELECT trim(lang) AS tag FROM documents UNION ALL SELECT trim(source) FROM documents) t
WHERE tag <> '' GROUP BY tag""")
def _(spark, folder):
    return jobs.tag_count(table(spark, folder, "documents"), ["lang", "source"])


@case("A3_rating_bucket", f"""SELECT CASE WHEN rating IS NULL THEN 'Unknown' WHEN rating >= 4 THEN '4-5 Stars'
 WHEN rating >= 3 THEN '3 Stars' ELSE '1-2 Stars' END AS bucket, count(*) AS n
FROM (SELECT CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN NULL ELSE {samples.LINE_RATING_SQL} END AS rating
 FROM lineitem) r GROUP BY 1""")
def _(spark, folder):
    rating = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45), F.lit("abc")).otherwise(
        samples.line_rating().cast("string")
    )
    return jobs.rating_bucket(table(spark, folder, "lineitem").select(rating.alias("rating")))


_FREQUENT_POSITIVE = ("the", "with", "that", "und", "que", "était")
_FREQUENT_NEGATIVE = ("was", "on", "la", "über")


def _hits_sql(words, column: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return rf"len(list_filter(regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}_]+'), lambda t: t IN ({listed})))"


def _sentiment_sql(positive, negative, source: str, key: str, column: str) -> str:
    return f"""SELECT {key}, round_even(avg(score), 3) AS avg_sentiment_score, count(*) AS reviews_analyzed
FROM (SELECT {key}, {_hits_sql(positive, column)} - {_hits_sql(negative, column)} AS score
 FROM {source} s WHERE {column} <> '') t GROUP BY {key}"""


@case("A4_lexicon_sentiment", _sentiment_sql(
    fv.POSITIVE_WORDS, fv.NEGATIVE_WORDS,
    f"(SELECT source AS name, comment FROM {samples.DOCUMENT_VENUES_SQL} v)", "name", "comment"))
def _(spark, folder):
    return jobs.lexicon_sentiment(samples.document_venues(spark, folder))


@case("A4_lexicon_sentiment_frequent_words",
      _sentiment_sql(_FREQUENT_POSITIVE, _FREQUENT_NEGATIVE, "documents", "source", "text"))
def _(spark, folder):
    return jobs.lexicon_sentiment_flat(
        wide_table(spark, folder, "documents"), "source", "text", _FREQUENT_POSITIVE, _FREQUENT_NEGATIVE
    )


@case("A4_positive_negative_ratio", f"""SELECT source, CAST(sum(p) AS BIGINT) AS positive_words,
 CAST(sum(n) AS BIGINT) AS negative_words, round_even(sum(p) / (sum(p) + sum(n)), 3) AS positive_share
FROM (SELECT source, {_hits_sql(_FREQUENT_POSITIVE, 'text')} AS p, {_hits_sql(_FREQUENT_NEGATIVE, 'text')} AS n
 FROM documents WHERE text <> '') t GROUP BY source""")
def _(spark, folder):
    return jobs.positive_negative_ratio(
        wide_table(spark, folder, "documents"), "source", "text", _FREQUENT_POSITIVE, _FREQUENT_NEGATIVE
    )


_TERMS = ("of the", "the", "of", "in the", "and", "que la", "la", "für")
def _terms_sql(source: str, column: str) -> str:
    # \b knows ASCII only, so every other letter is turned into '0', also inside the terms.
    folded = rf"regexp_replace(regexp_replace(lower({column}), '[^\p{{L}}\p{{N}}_\x00-\x7F]', ' ', 'g'), 'ü', '1', 'g')"
    folded = rf"regexp_replace({folded}, '[^\x00-\x7F]', '0', 'g')"
    ordered = sorted(_TERMS, key=lambda t: (-len(t), t))
    pattern = "|".join(t.replace("ü", "1") for t in ordered)
    return rf"""SELECT CASE term WHEN 'f1r' THEN 'für' ELSE term END AS term, count(*) AS n
FROM (SELECT unnest(regexp_extract_all({folded}, '\b({pattern})\b', 1)) AS term FROM {source} s) t GROUP BY 1"""


@case("A5_term_match_count", _terms_sql("documents", "text"))
def _(spark, folder):
    return terms.term_match_count(wide_table(spark, folder, "documents"), "text", _TERMS)


@case("A5_term_match_count_nested", _terms_sql(samples.DOCUMENT_VENUES_SQL, "comment"))
def _(spark, folder):
    return terms.nested_term_match_count(samples.document_venues(spark, folder), _TERMS)


# The dictionary grows with the data: all words of the benchmark texts.
@case("A5_term_match_count_joined", r"""SELECT t.term, count(*) AS n
FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM documents) t
SEMI JOIN (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM benchmark) d
 ON t.term = d.term GROUP BY t.term""")
def _(spark, folder):
    words = table(spark, folder, "benchmark").select(F.explode(text.tokenize(F.col("text"))).alias("term"))
    return terms.term_match_count_joined(wide_table(spark, folder, "documents"), "doc_id", "text", words)


@case("A5_term_match_count_joined_phrases", _terms_sql("documents", "text"))
def _(spark, folder):
    dictionary = spark.createDataFrame([(t,) for t in _TERMS], "term string")
    return terms.term_match_count_joined(wide_table(spark, folder, "documents"), "doc_id", "text", dictionary)


@case("A6_top_reviewed", """SELECT source || '/' || lang AS name, n_chars AS review_count FROM documents
ORDER BY n_chars DESC, name, doc_id LIMIT 10""")
def _(spark, folder):
    venues = table(spark, folder, "documents").select(
        F.concat_ws("/", "source", "lang").alias("name"),
        F.concat(F.lit("("), F.format_number("n_chars", 0), F.lit(")")).alias("review_count"),
        F.col("doc_id").alias("id"),
    )
    return jobs.top_reviewed(venues)


_STARS_SQL = f"""SELECT stars || CASE WHEN stars > 1 THEN ' Stars' ELSE ' Star' END AS stars, count(*) AS n
FROM (SELECT CAST(greatest(1, least(5, round_even(rating, 0))) AS INTEGER) AS stars
 FROM (SELECT {samples.LINE_RATING_SQL} AS rating FROM lineitem
  UNION ALL SELECT l_linenumber AS rating FROM lineitem) r WHERE rating IS NOT NULL) s GROUP BY 1"""


def _star_reviews(spark, folder):
    rating = lambda c: F.struct(c.alias("rating"))
    return wide_table(spark, folder, "lineitem").select(
        F.array(
            rating(samples.line_rating().cast("string")),
            rating(F.concat(F.col("l_linenumber").cast("string"), F.lit(" of 5 bubbles"))),
            rating(F.col("l_returnflag")),
        ).alias("reviews")
    )


@case("A7_review_star_distribution", _STARS_SQL)
def _(spark, folder):
    return jobs.review_star_distribution(_star_reviews(spark, folder))


@case("A7_review_star_share", f"""SELECT stars, n, round_even(n / sum(n) OVER (), 4) AS share FROM ({_STARS_SQL}) c""")
def _(spark, folder):
    return jobs.with_share(jobs.review_star_distribution(_star_reviews(spark, folder)))


_VENUE_WORDS = ("ing the", "sch ein", "que la", "zzzz")


def _venue_sql(words) -> str:
    test = " OR ".join(f"contains(lower(text), '{w}')" for w in words)
    return f"""SELECT CASE WHEN {test} THEN 'Delivery-Friendly' ELSE 'Dine-In-Only' END AS label,
 round_even(avg((n_chars % 9 + 2) / 2.0), 2) AS avg_rating, count(*) AS restaurant_count FROM documents GROUP BY 1"""


@case("A8_delivery_vs_dinein_venue", _venue_sql(_VENUE_WORDS))
def _(spark, folder):
    return jobs.delivery_vs_dinein_venue(samples.document_venues(spark, folder), words=_VENUE_WORDS)


@case("A8_delivery_vs_dinein_venue_default_words", _venue_sql(fv.DELIVERY_WORDS))
def _(spark, folder):
    return jobs.delivery_vs_dinein_venue(samples.document_venues(spark, folder))


@case("A8_delivery_vs_dinein_venue_both_labels", _venue_sql(fv.DELIVERY_WORDS).replace(
    "FROM documents", "FROM (SELECT text || CASE WHEN doc_id % 3 = 0 THEN ' by GRAB' ELSE '' END AS text, n_chars FROM documents) d"))
def _(spark, folder):
    """The default words, with the last review of every third venue saying so."""
    said = F.when(F.col("doc_id") % 3 == 0, F.lit(" by GRAB")).otherwise(F.lit(""))
    venues = samples.document_venues(spark, folder)
    last = F.size("reviews") - 1
    marked = F.transform("reviews", lambda r, i: r.withField("comment", F.when(i == last, F.concat(r["comment"], said)).otherwise(r["comment"])))
    return jobs.delivery_vs_dinein_venue(venues.withColumn("reviews", marked))


# === scalar functions (N) =========================================================

_COUNT_TEXT_SQL = "CASE o_orderkey % 6 WHEN 0 THEN CAST(floor(o_totalprice) AS BIGINT) WHEN 1 THEN o_custkey " \
                  "WHEN 2 THEN CAST(floor(o_totalprice) AS BIGINT) WHEN 3 THEN 0 WHEN 4 THEN 0 ELSE o_custkey END"


def _count_text():
    kind, whole = F.col("o_orderkey") % 6, F.floor("o_totalprice").cast("bigint")
    return (
        F.when(kind == 0, F.concat(F.lit("("), whole, F.lit(")")))
        .when(kind == 1, F.col("o_custkey").cast("string"))
        .when(kind == 2, F.format_number(whole, 0))
        .when(kind == 3, F.lit("none yet"))
        .when(kind == 4, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("o_custkey"), F.lit(".9")))
    )


@case("N1_parse_review_count", f"SELECT o_orderkey, CAST({_COUNT_TEXT_SQL} AS BIGINT) AS review_count FROM orders")
def _(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", numbers.parse_review_count(_count_text()).alias("review_count"))


def _rating_text():
    kind, n = F.col("l_linenumber") % 5, F.col("l_linenumber").cast("string")
    return (
        F.when(kind == 0, F.concat(n, F.lit(" of 5 bubbles")))
        .when(kind == 1, F.concat(F.lit(" "), samples.line_rating().cast("string"), F.lit(" ")))
        .when(kind == 2, F.concat(F.lit("rated "), n, F.lit(".25 today")))
        .when(kind == 3, F.lit("-1.5"))
        .otherwise(F.lit("none"))
    )


_RATING_TEXT_SQL = f"""
 CASE l_linenumber % 5 WHEN 0 THEN l_linenumber WHEN 1 THEN {samples.LINE_RATING_SQL} WHEN 3 THEN -1.5 END AS review_rating,
 CASE l_linenumber % 5 WHEN 0 THEN l_linenumber WHEN 1 THEN {samples.LINE_RATING_SQL} WHEN 2 THEN l_linenumber + 0.25
  WHEN 3 THEN -1.5 END AS first_number,
 CASE l_linenumber % 5 WHEN 1 THEN {samples.LINE_RATING_SQL} WHEN 3 THEN -1.5 END AS strict"""


@case("N2_N3_N13_rating_text", f"SELECT l_orderkey, l_linenumber, {_RATING_TEXT_SQL} FROM lineitem")
def _(spark, folder):
    raw = _rating_text()
    return wide_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.parse_review_rating(raw).alias("review_rating"),
        numbers.extract_float(raw).alias("first_number"),
        numbers.strict_float(raw).alias("strict"),
    )


_SHORT_ID_SQL = "CASE WHEN o_orderkey % 3 = 0 THEN 'rest_d' || o_custkey WHEN o_orderkey % 3 = 1 THEN 'rest_' || o_custkey ELSE '' END"


def _id_text():
    kind = F.col("o_orderkey") % 3
    return F.when(
        kind == 0, F.concat(F.lit("https://x.example/Restaurant_Review-g29-d"), F.col("o_custkey"), F.lit("-Reviews-a"))
    ).when(kind == 1, F.concat(F.lit("rest_"), F.col("o_custkey")))


@case("N4_make_short_id", f"SELECT o_orderkey, {_SHORT_ID_SQL} AS short_id FROM orders")
def _(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", text.make_short_id(_id_text()).alias("short_id"))


@case("N1_N4_sql_functions", f"SELECT o_orderkey, CAST({_COUNT_TEXT_SQL} AS BIGINT) AS review_count, {_SHORT_ID_SQL} AS short_id FROM orders")
def _(spark, folder):
    """The functions for users who write SQL."""
    sql.register(spark)
    orders = table(spark, folder, "orders").select("o_orderkey", _count_text().alias("counted"), _id_text().alias("place"))
    return orders.selectExpr("o_orderkey", "parse_review_count(counted) AS review_count", "make_short_id(place) AS short_id")


@case("N2_N3_N13_sql_functions", f"SELECT l_orderkey, l_linenumber, {_RATING_TEXT_SQL} FROM lineitem")
def _(spark, folder):
    sql.register(spark)
    lines = wide_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", _rating_text().alias("raw"))
    return lines.selectExpr(
        "l_orderkey", "l_linenumber", "parse_review_rating(raw) AS review_rating", "extract_float(raw) AS first_number", "strict_float(raw) AS strict"
    )


@case("N5_N6_clean_location_text", """SELECT c_custkey,
 CASE WHEN c_nationkey < 6 THEN '' ELSE c_name || ', ' || c_mktsegment END AS place, c_nationkey < 6 AS unknown
FROM customer""")
def _(spark, folder):
    raw = F.when(
        F.col("c_nationkey") < 5,
        F.element_at(F.array(*[F.lit(p) for p in (" ,", "Unknown ", "NULL", " none", "N/A,")]), F.col("c_nationkey") + 1),
    ).when(F.col("c_nationkey") > 5, F.concat(F.lit(" \n"), F.col("c_name"), F.lit(",\n\t "), F.col("c_mktsegment"), F.lit(" ,")))
    return table(spark, folder, "customer").select(
        "c_custkey", places.clean_location_text(raw).alias("place"), places.is_unknown_location(raw).alias("unknown")
    )


@case("N7_strip_accents", r"SELECT doc_id, md5(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')) AS plain FROM documents")
def _(spark, folder):
    return wide_table(spark, folder, "documents").select(
        "doc_id", F.md5(places.strip_accents(F.col("text"))).alias("plain")
    )


@case("N8_N9_N10_N11_admin_area", """SELECT c_custkey, CASE c_nationkey % 6
 WHEN 0 THEN 'Quận ' || (c_nationkey + 1) WHEN 1 THEN 'Quận ' || (c_nationkey + 1) WHEN 2 THEN 'Quận Bình Thạnh'
 WHEN 3 THEN 'Quận Thủ Đức' WHEN 4 THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'Unknown' ELSE 'Phường ' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END
 ELSE 'Unknown' END AS area, CASE c_nationkey % 6 WHEN 0 THEN 'Quan ' || (c_nationkey + 1)
 WHEN 1 THEN 'Quan ' || (c_nationkey + 1) WHEN 2 THEN 'Quan Binh Thanh'
 WHEN 3 THEN 'Quan Thu Duc' WHEN 4 THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'Unknown' ELSE 'Phuong ' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END
 ELSE 'Unknown' END AS area_ascii FROM customer""")
def _(spark, folder):
    kind, number = F.col("c_nationkey") % 6, (F.col("c_nationkey") + 1).cast("string")
    district = (
        F.when(kind == 0, F.concat(F.lit("18B/17 Đ. Nguyễn Thị Minh Khai Quận "), number))
        .when(kind == 2, F.lit("Binh Thanh District, Ho Chi Minh City"))
        .when(kind == 4, F.concat(F.lit("Level 3, "), F.lower("c_mktsegment"), F.lit(" Ward")))
        .when(kind == 5, F.lit("n/a"))
    )
    address = F.when(kind == 1, F.concat(F.lit("Ben Nghe Ward, District "), number, F.lit(" Lancaster Building"))).when(
        kind == 3, F.lit("1 Main street, QUẬN THỦ ĐỨC, Vietnam")
    )
    return wide_table(spark, folder, "customer").select(
        "c_custkey",
        places.extract_admin_area(district, address).alias("area"),
        places.extract_admin_area(district, address, ascii=True).alias("area_ascii"),
    )


@case("N12_normalize_city", """SELECT c_custkey, CASE WHEN c_nationkey % 4 IN (0, 1) THEN 'Ho Chi Minh City'
 WHEN c_nationkey % 4 = 2 THEN c_mktsegment ELSE 'Unknown' END AS city FROM customer""")
def _(spark, folder):
    kind = F.col("c_nationkey") % 4
    first = F.when(kind == 0, F.lit("Ho  Chi Minh City 70000 Vietnam")).when(kind == 2, F.lit("Vietnam 10000,"))
    second = (
        F.when(kind == 1, F.concat(F.col("c_name"), F.lit(", Sài Gòn")))
        .when(kind == 2, F.concat(F.col("c_mktsegment"), F.lit(" 700000, vietnam")))
        .when(kind == 3, F.lit("null"))
    )
    return wide_table(spark, folder, "customer").select("c_custkey", places.normalize_city(first, second).alias("city"))


@case("N14_N15_N16_address_parts", """SELECT c_custkey,
 CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment || ', ' || c_name || ', City' WHEN c_nationkey % 3 = 1 THEN c_name ELSE '' END AS address,
 CASE WHEN c_nationkey % 3 = 0 THEN c_name END AS district,
 CASE WHEN c_nationkey % 3 = 0 THEN 'City' WHEN c_nationkey % 3 = 1 THEN c_name END AS city,
 CASE WHEN c_nationkey % 3 = 0 THEN c_name ELSE 'Unknown' END AS district_or_unknown FROM customer""")
def _(spark, folder):
    kind = F.col("c_nationkey") % 3
    full = F.when(kind == 0, F.concat_ws(", ", "c_mktsegment", "c_name", F.lit("City"))).when(kind == 1, F.lit(""))
    other = F.when(kind == 1, F.col("c_name"))
    address = text.first_present(full, other)
    district, city = text.split_address(address)
    return table(spark, folder, "customer").select(
        "c_custkey",
        address.alias("address"),
        district.alias("district"),
        city.alias("city"),
        text.default_if_blank(district, fv.UNKNOWN).alias("district_or_unknown"),
    )


@case("N17_wide_to_array", f"SELECT id, name, category, area, instructions, "
      f"array_to_string(ingredients, '|') AS ingredients FROM {samples.PARSED_RECIPES_SQL} m")
def _(spark, folder):
    meals = normalize.parse_meals(samples.raw_recipes(spark, folder))
    return meals.withColumn("ingredients", F.array_join("ingredients", "|"))


@case("N18_N19_clean_meal", f"""SELECT id, coalesce(category, 'Unknown') AS category,
 CASE WHEN area = '' THEN 'Unknown' ELSE area END AS area, array_to_string(ingredients, ', ') AS ingredients
FROM {samples.PARSED_RECIPES_SQL} m""")
def _(spark, folder):
    meals = normalize.clean_meals(normalize.parse_meals(samples.raw_recipes(spark, folder)))
    return meals.select("id", "category", "area", text.array_to_csv(F.col("ingredients")).alias("ingredients"))


@case("N20_clean_reviews", f"""SELECT conv_id, turn, CAST(count(*) AS BIGINT) AS n_reviews,
 CAST(sum(len(trim(comment))) AS BIGINT) AS n_chars, CAST(sum(len(comment) % 5 + 1) AS DOUBLE) AS stars,
 max(role) AS first_user
FROM {samples.CONVERSATION_LINES_SQL} l GROUP BY conv_id, turn""")
def _(spark, folder):
    cleaned = docs.clean_reviews(F.col("reviews"))
    pages_ = samples.conversation_pages(spark, folder).select("id", "offset", cleaned.alias("reviews"))
    total = lambda f, kind: F.aggregate("reviews", F.lit(0).cast(kind), lambda a, r: a + f(r))
    return pages_.select(
        F.col("id").alias("conv_id"),
        F.col("offset").alias("turn"),
        F.size("reviews").cast("bigint").alias("n_reviews"),
        total(lambda r: F.coalesce(F.length(r["comment"]), F.lit(0)).cast("bigint"), "bigint").alias("n_chars"),
        total(lambda r: r["rating"], "double").alias("stars"),
        F.get("reviews", 0)["user"].alias("first_user"),
    )


@case("N21_tokenize", r"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS t FROM documents) d""")
def _(spark, folder):
    tokens = text.tokenize(F.col("text"))
    return wide_table(spark, folder, "documents").select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens")
    )


@case("N23_link_class", r"""SELECT page_id, CASE WHEN regexp_matches(url, 'page=\d+') THEN 'list'
 WHEN regexp_matches(url, '/\w\w/\d+') THEN 'detail' END AS kind FROM pages""")
def _(spark, folder):
    kind = urls.link_class(F.col("url"), r"page=\d+", r"/\w\w/\d+")
    return table(spark, folder, "pages").select("page_id", kind.alias("kind"))


def _next_page_sql(stop: str) -> str:
    return f"""SELECT o_orderkey,
 CASE WHEN o_orderkey % 17 >= 15 {stop} AND (o_custkey % 120 = 0 OR o + 15 < o_custkey % 120)
  THEN 'https://x.example/Restaurant_Review-g1-d' || o_custkey || '-Reviews-or' || (o + 15) || '-a.html' END AS next_url
FROM (SELECT *, (o_orderkey % 6) * 15 AS o FROM orders) t"""


def _next_page(spark, folder, **stop):
    offset = F.col("o_orderkey") % 6 * 15
    marker = F.when(offset == 0, F.lit("-Reviews-")).otherwise(F.concat(F.lit("-Reviews-or"), offset, F.lit("-")))
    url = F.concat(F.lit("https://x.example/Restaurant_Review-g1-d"), F.col("o_custkey"), marker, F.lit("a.html"))
    following = urls.next_page_url(url, F.col("o_orderkey") % 17, F.col("o_custkey") % 120, **stop)
    return table(spark, folder, "orders").select("o_orderkey", following.alias("next_url"))


@case("N24_next_page_url", _next_page_sql(""))
def _(spark, folder):
    return _next_page(spark, folder)


@case("N24_next_page_url_stop", _next_page_sql("AND o + 15 < 75"))
def _(spark, folder):
    return _next_page(spark, folder, max_reviews=fv.MAX_REVIEWS)


# === filters and lookups (F, J) ===================================================


@case("F8_keyword_filter", "SELECT doc_id FROM documents WHERE contains(lower(text), 'ing the') "
      "OR contains(lower(text), 'que la')")
def _(spark, folder):
    hit = text.contains_any(F.col("text"), ("ing the", "que la"))
    return wide_table(spark, folder, "documents").filter(hit).select("doc_id")


@case("F8_keyword_filter_whole_word", r"SELECT doc_id FROM documents "
      r"WHERE regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])(est|para)($|[^\p{L}\p{N}_])')")
def _(spark, folder):
    hit = text.contains_any(F.col("text"), ("est", "para"), whole_word=True)
    return wide_table(spark, folder, "documents").filter(hit).select("doc_id")


@case("J3_check_parents", """SELECT o_orderkey, o_custkey, o_custkey IN
 (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS has_parent FROM orders""")
def _(spark, folder):
    children = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    parents = table(spark, folder, "customer").filter("c_acctbal >= 0")
    kept, orphans = tables.check_parents(children, parents, "o_custkey", "c_custkey")
    return kept.withColumn("has_parent", F.lit(True)).unionByName(orphans.withColumn("has_parent", F.lit(False)))


@case("J6_unseen_links", """SELECT min(url) AS url, sha1(lower(url)) AS fingerprint FROM pages
WHERE sha1(lower(url)) NOT IN (SELECT sha1(lower(url)) FROM pages WHERE contains(url, '?')) GROUP BY 2""")
def _(spark, folder):
    links = table(spark, folder, "pages").select("url")
    seen = links.filter(F.contains("url", F.lit("?"))).select(urls.fingerprint(F.col("url")).alias("fingerprint"))
    return pages.unseen_links(links, seen)


# === tables and ingest (R, C, I) ==================================================


@case("J6_links_over_crawls", """WITH c AS (SELECT url, sha1(lower(url)) AS fingerprint, n AS crawl FROM pages, (SELECT unnest([0, 1, 2]) AS n) x
 WHERE page_id % 3 = n OR page_id % 5 = n)
SELECT min(url) AS url, fingerprint, crawl FROM c GROUP BY fingerprint, crawl QUALIFY crawl = min(crawl) OVER (PARTITION BY fingerprint)""")
def _(spark, folder):
    """Three crawls in a row, each with links of the others: what each one brings."""
    links = table(spark, folder, "pages").select("page_id", "url")
    seen = SeenLinks(shared_dir(spark, "seen"), buckets=16)
    found = [seen.new_links(links.filter(f"page_id % 3 = {n} OR page_id % 5 = {n}"), n).withColumn("crawl", F.lit(n)) for n in range(3)]
    return reduce(DataFrame.unionByName, found)


@case("R1_R6_explode_reviews", f"""SELECT conv_id AS restaurant_id, turn, CAST(pos AS INTEGER) AS pos, role AS user,
 (len(comment) % 5 + 1) || ' of 5 bubbles' AS rating, comment FROM {samples.CONVERSATION_LINES_SQL} l""")
def _(spark, folder):
    pages_ = samples.conversation_pages(spark, folder).withColumn("key", F.struct("id", "offset"))
    flat = normalize.explode_reviews(pages_, key="key")
    return flat.select(
        F.col("restaurant_id.id").alias("restaurant_id"), F.col("restaurant_id.offset").alias("turn"),
        "pos", "user", "rating", "comment",
    )


_EVENT_COLUMNS = ("user_id", "ts", "event_id", "event_type", "value")
_BASE_EVENTS = "event_type IN ('view', 'click')"
_LATEST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@case("R2_replace_upsert", f"""WITH base AS (SELECT user_id, ts, event_id, event_type, value FROM events
  WHERE {_BASE_EVENTS} {_LATEST}),
 batch AS (SELECT user_id, ts, event_id, event_type, value FROM events WHERE NOT {_BASE_EVENTS} {_LATEST})
SELECT * FROM batch UNION ALL SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM batch)""")
def _(spark, folder):
    events = table(spark, folder, "events").select(*_EVENT_COLUMNS)
    base = tables.latest_by_key(events.filter(_BASE_EVENTS), "user_id", ["ts", "event_id"])
    return tables.replace_upsert(base, events.filter(f"NOT {_BASE_EVENTS}"), "user_id", ["ts", "event_id"])


_FIELDS = ("purchase", "signup", "error")


@case("R3_merge_upsert", f"""WITH docs AS (SELECT user_id, """ + ", ".join(
    f"arg_max(value, (ts, event_id)) FILTER (WHERE event_type = '{f}') AS {f}" for f in _FIELDS) + f"""
 FROM events WHERE NOT {_BASE_EVENTS} GROUP BY user_id),
 base AS (SELECT user_id, max(value) AS purchase, min(value) AS signup, sum(value) * 0 AS error
 FROM events WHERE {_BASE_EVENTS} GROUP BY user_id)
SELECT coalesce(d.user_id, b.user_id) AS user_id, """ + ", ".join(
    f"coalesce(d.{f}, b.{f}) AS {f}" for f in _FIELDS) + """
FROM docs d FULL OUTER JOIN base b ON d.user_id = b.user_id""")
def _(spark, folder):
    events = table(spark, folder, "events")
    base = (
        events.filter(_BASE_EVENTS)
        .groupBy("user_id")
        .agg(F.max("value").alias("purchase"), F.min("value").alias("signup"), (F.sum("value") * 0).alias("error"))
    )
    kind = F.col("event_type")
    batch = events.filter(f"NOT {_BASE_EVENTS}").select(
        "user_id", "ts", "event_id", *[F.when(kind == f, F.col("value")).alias(f) for f in _FIELDS],
        F.array(kind).alias(tables.PRESENT),
    )
    return tables.merge_upsert(base, batch, "user_id", ["ts", "event_id"])


@case("R7_clean_restaurants", f"SELECT o_orderkey, id, rating, review_count, district_parsed, city "
      f"FROM {samples.RAW_RESTAURANTS_SQL} r")
def _(spark, folder):
    cleaned = normalize.clean_restaurants(samples.raw_restaurants(spark, folder))
    return cleaned.select("o_orderkey", "id", "rating", "review_count", "district_parsed", "city")


_ORDER = ("o_orderdate", "o_orderkey")


@case("R8_restaurants", "SELECT id, name, rating, CAST(review_count AS INTEGER) AS review_count, address, district, "
      f"district_parsed, city FROM {samples.LATEST_RESTAURANTS_SQL} r")
def _(spark, folder):
    documents = normalize.restaurant_documents(samples.raw_restaurants(spark, folder), _ORDER)
    return normalize.restaurants_table(documents.accepted)


@case("R8_reviews", f"""SELECT restaurant_id, "user", rating, comment FROM (
 SELECT id AS restaurant_id, o_orderpriority AS "user", CAST(o_orderkey % 5 + 1 AS DOUBLE) AS rating,
  'order ' || o_orderkey AS comment FROM {samples.LATEST_RESTAURANTS_SQL} r
 UNION ALL SELECT id, 'Anonymous', CAST(o_orderkey % 5 + 1 AS DOUBLE), NULL FROM {samples.LATEST_RESTAURANTS_SQL} r) u""")
def _(spark, folder):
    documents = normalize.restaurant_documents(samples.raw_restaurants(spark, folder), _ORDER)
    return normalize.reviews_table(documents.accepted).accepted.drop("id")


@case("R8_R9_meals", f"""SELECT id, name, coalesce(category, 'Unknown') AS category,
 CASE WHEN area = '' THEN 'Unknown' ELSE area END AS area, instructions,
 array_to_string(ingredients, ', ') AS ingredients FROM {samples.PARSED_RECIPES_SQL} m WHERE name IS NOT NULL""")
def _(spark, folder):
    recipes = samples.raw_recipes(spark, folder)
    empty = normalize.parse_meals(recipes).limit(0)
    collection = ingest.ingest_meals(empty, recipes)
    return normalize.meals_table(collection).accepted


@case("R6_review_keys", """SELECT 2 * count(DISTINCT o_custkey) AS reviews, 2 * count(DISTINCT o_custkey) AS keys FROM orders""")
def _(spark, folder):
    documents = normalize.restaurant_documents(samples.raw_restaurants(spark, folder), _ORDER)
    reviews = normalize.reviews_table(documents.accepted).accepted
    return reviews.agg(F.count("*").alias("reviews"), F.count_distinct("id").alias("keys"))


@case("R9_ingest_meals_into_filled", f"""WITH r AS (SELECT *, CAST(substr(id, 6) AS BIGINT) AS k FROM {samples.PARSED_RECIPES_SQL} m)
SELECT id, name, CASE WHEN k % 2 = 0 THEN coalesce(category, 'Unknown') ELSE 'Old' END AS category,
 array_to_string(ingredients, ', ') AS ingredients FROM r""")
def _(spark, folder):
    """Every recipe is stored, new or both. New records take the place of the stored ones of their id, the others stay."""
    recipes = samples.raw_recipes(spark, folder)
    stored = normalize.clean_meals(normalize.parse_meals(recipes.filter("idMeal % 2 = 1 OR idMeal % 3 = 0"))).withColumn("category", F.lit("Old"))
    merged = ingest.ingest_meals(stored, recipes.filter("idMeal % 2 = 0"))
    return merged.select("id", "name", "category", F.array_join("ingredients", ", ").alias("ingredients"))


@case("R6_dense_keys", """WITH k AS (SELECT l_suppkey AS a, l_partkey AS b, min(CASE WHEN l_orderkey % 3 < 2 THEN 0 ELSE 1 END) AS load FROM lineitem GROUP BY 1, 2)
SELECT a AS l_suppkey, b AS l_partkey, load, row_number() OVER (ORDER BY load, a, b) - 1 AS number FROM k""")
def _(spark, folder):
    """Keys of two loads, the second with those of the first again: numbers go on without a gap."""
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey")
    numbers = DenseKeys(shared_dir(spark, "keys"), lines.select("l_suppkey", "l_partkey").schema)
    numbers.assign(lines.filter("l_orderkey % 3 < 2"), 0)
    numbers.assign(lines, 1)
    return numbers.known(spark).withColumnRenamed("_batch", "load")


@case("R5_import_collection", """SELECT 'rest_d' || o_custkey AS id, 'Place ' || max(o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS name,
 CAST(arg_max(o_orderkey % 5, o_orderkey) FILTER (WHERE o_orderkey % 2 = 1) AS DOUBLE) AS rating FROM orders GROUP BY o_custkey""")
def _(spark, folder):
    """Records of one id have the name or the rating, never both."""
    work = shared_dir(spark, "import")
    key = F.col("o_orderkey")
    record = F.struct(
        F.concat(F.lit("https://x.example/Restaurant_Review-g1-d"), F.col("o_custkey"), F.lit("-Reviews-a.html")).alias("_id"),
        F.when(key % 2 == 0, F.concat(F.lit("Place "), key)).alias("name"), F.when(key % 2 == 1, key % 5).cast("string").alias("rating"),
    )
    # Files by ranges of the key, named so that the order of the files is that of the keys.
    part = F.lpad(F.floor(key / 5000).cast("string"), 12, "0").alias("part")
    ranged = table(spark, folder, "orders").groupBy(part).agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), record.alias("r")))).alias("rows"))
    texts = ranged.select("part", F.to_json(F.transform("rows", lambda x: x["r"])).alias("value"))
    texts.repartition("part").write.partitionBy("part").text(work)
    return ingest.import_collection(spark, work, schemas.DOCUMENTS_RAW, "imported_" + work[-12:]).select("id", "name", "rating")


@case("R10_rejects", """SELECT 'meals' AS "table", CAST(doc_id AS VARCHAR) AS key,
 'name longer than 255' || CASE WHEN len(source || repeat('x', CAST(n_chars // 40 AS INTEGER))) > 100
  THEN '; area longer than 100' ELSE '' END AS reason FROM documents WHERE len(text) > 255
UNION ALL SELECT 'meals', CAST(doc_id AS VARCHAR), 'area longer than 100' FROM documents
WHERE len(text) BETWEEN 1 AND 255 AND len(source || repeat('x', CAST(n_chars // 40 AS INTEGER))) > 100""")
def _(spark, folder):
    meals = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("name"), F.col("lang").alias("category"),
        F.concat("source", F.repeat(F.lit("x"), F.floor(F.col("n_chars") / 40).cast("int"))).alias("area"),
        F.lit("").alias("instructions"), F.array(F.col("source")).alias("ingredients"),
    )
    return normalize.meals_table(meals).rejects


@case("R11_page_reviews", f"""SELECT conv_id AS id, turn AS "offset", CAST(pos AS INTEGER) AS pos, role AS "user",
 (len(comment) % 5 + 1) || ' of 5 bubbles' AS rating, comment FROM {samples.CONVERSATION_LINES_SQL} l""")
def _(spark, folder):
    return pages.page_reviews(samples.conversation_pages(spark, folder))


def _merged_sql(keep: str) -> str:
    return f"""WITH lines AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) AS rn
  FROM {samples.CONVERSATION_LINES_SQL} l),
 heads AS (SELECT conv_id, arg_min(role || ' ' || turn, turn) AS name, CAST(arg_min(len(text), turn) AS VARCHAR) AS rating
  FROM conversations GROUP BY conv_id)
SELECT conv_id AS id, any_value(name) AS name, any_value(rating) AS rating, CAST(count(*) AS BIGINT) AS n_reviews,
 md5(string_agg(role || ':' || comment, '|' ORDER BY turn, pos)) AS content
FROM lines JOIN heads USING (conv_id) WHERE {keep} GROUP BY conv_id"""


def _merged(spark, folder, **cap):
    merged = pages.merge_pages(samples.conversation_pages(spark, folder), header=("name", "rating"), **cap)
    lines = F.transform("reviews", lambda r: F.concat_ws(":", r["user"], r["comment"]))
    return merged.select(
        "id", "name", "rating", F.size("reviews").cast("bigint").alias("n_reviews"),
        F.md5(F.array_join(lines, "|")).alias("content"),
    )


@case("R11_merge_pages", _merged_sql("true"))
def _(spark, folder):
    return _merged(spark, folder)


@case("R12_first_reviews", _merged_sql("rn <= 20"))
def _(spark, folder):
    return _merged(spark, folder, max_reviews=20)


@case("R11_page_headers", """SELECT conv_id AS id, arg_min(role || ' ' || turn, turn) AS name,
 CAST(arg_min(len(text), turn) AS VARCHAR) AS rating FROM conversations GROUP BY conv_id""")
def _(spark, folder):
    return pages.page_headers(samples.conversation_pages(spark, folder), header=("name", "rating"))


def _plain_sql(html: str) -> str:
    for entity, character in (("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):
        html = f"regexp_replace({html}, '{entity}', '{character}', 'g')"
    return html


_BLANK = "chr(32) || chr(9) || chr(10) || chr(13)"


@case("R13_extract_pages", f"""WITH parts AS (SELECT page_id, url,
  trim({_plain_sql("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")}, {_BLANK}) AS name,
  trim({_plain_sql("regexp_extract(html, '<footer>(.*?)</footer>', 1, 's')")}, {_BLANK}) AS address,
  trim({_plain_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")}, {_BLANK}) AS first_user,
  len(regexp_extract_all(html, '<article>')) AS cards,
  list_filter(list_transform(string_split_regex(regexp_extract(html, '<article>.*?</h1>(.*?)</article>', 1, 's'), '<[^>]*>'),
   lambda t: trim({_plain_sql('t')}, {_BLANK})), lambda t: t <> '') AS texts FROM pages),
 places AS (SELECT *, string_split(nullif(address, ''), ',') AS bits FROM parts)
SELECT page_id, url, nullif(name, '') AS name, nullif(address, '') AS address,
 CASE WHEN len(bits) > 1 THEN trim(bits[-2]) END AS district, trim(bits[-1]) AS city,
 CAST(cards AS INTEGER) AS cards, nullif(first_user, '') AS first_user,
 md5(nullif(array_to_string(texts, chr(10)), '')) AS comment FROM places""")
def _(spark, folder):
    rules = pages.PageRules(
        card=pages.Rule("article"), user=(pages.Rule("h6", "class", "none"), pages.Rule("h1")), comment=(pages.Rule("h6"), pages.Rule("p")), name=pages.Rule("title"),
        address=pages.Rule("footer"),
    )
    extracted = pages.extract_pages(wide_table(spark, folder, "pages"), rules)
    review = F.get("reviews", 0)
    return extracted.select(
        "page_id", "url", "name", "address", "district", "city", "cards",
        review["user"].alias("first_user"), F.md5(review["comment"]).alias("comment"),
    )


_TEXTS = "list_filter(list_transform(string_split_regex({0}, '<[^>]*>'), lambda t: trim({1}, {2})), lambda t: t <> '')"


def _texts_sql(html: str) -> str:
    return _TEXTS.format(html, _plain_sql("t"), _BLANK)


@case("R13_all_cards", f"""WITH p AS (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1, 's') AS items,
 {_texts_sql("regexp_extract(html, '<div class=.ad.>(.*?)</div>', 1, 's')")}[1] AS rating FROM pages),
u AS (SELECT page_id, rating, CAST(len(items) AS INTEGER) AS cards,
 list_filter(list_transform(items, lambda x: {_texts_sql("x")}[1]), lambda x: x IS NOT NULL) AS users FROM p)
SELECT page_id, cards, rating, users[1] AS review_count, CAST(pos AS INTEGER) AS pos, users[pos + 1] AS "user", users[pos + 1] AS comment
FROM (SELECT *, unnest(range(len(users))) AS pos FROM u) v""")
def _(spark, folder):
    """Every card of every page, with rating and review count by a second rule where the first finds nothing."""
    rules = pages.PageRules(
        card=pages.Rule("li"), user=pages.Rule("a"), comment=(pages.Rule("h6"), pages.Rule("a")),
        rating=(pages.Rule("div", "class", "stars"), pages.Rule("div", "class", "ad")), review_count=(pages.Rule("h6"), pages.Rule("li")),
    )
    extracted = pages.extract_pages(wide_table(spark, folder, "pages"), rules)
    cards = extracted.select("page_id", "cards", "rating", "review_count", F.posexplode("reviews").alias("pos", "review"))
    return cards.select("page_id", "cards", "rating", "review_count", "pos", "review.user", "review.comment")


@case("C1_search", """SELECT doc_id, lang, source FROM documents
WHERE contains(strip_accents(lower(text)), 'eaux le') OR contains(lower(source), 'eaux le') ORDER BY doc_id LIMIT 20 OFFSET 20""")
def _(spark, folder):
    found = tables.search(
        table(spark, folder, "documents"), "Éaux LE", columns=("text", "source"), key="doc_id", page=2, size=20
    )
    return found.select("doc_id", "lang", "source")


@case("C2_insert_rows", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    old, new = customers.filter("c_mktsegment <> 'BUILDING'"), customers.filter("c_mktsegment = 'BUILDING'")
    return tables.insert_rows(old, new, "c_custkey")


@case("C2_insert_rows_defaults", """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unknown' ELSE c_mktsegment END AS c_mktsegment,
 CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer""")
def _(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    old, new = customers.filter("c_mktsegment <> 'BUILDING'"), customers.filter("c_mktsegment = 'BUILDING'").select("c_name", "c_custkey")
    return tables.insert_rows(old, new, "c_custkey", {"c_mktsegment": "Unknown"})


@case("C3_affected_rows", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT 2 * o_custkey FROM orders)")
def _(spark, folder):
    """Keys that a patch touches; half of those asked for are not in the table."""
    patch = table(spark, folder, "orders").select((2 * F.col("o_custkey")).alias("c_custkey")).distinct()
    return tables.affected_rows(table(spark, folder, "customer"), patch, "c_custkey")


@case("C3_patch_rows", """SELECT c_custkey, c_name, coalesce(m, c_mktsegment) AS c_mktsegment, coalesce(b, c_acctbal) AS c_acctbal
FROM customer LEFT JOIN (SELECT o_custkey,
  arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus <> 'O') AS m,
  arg_max(o_totalprice, (o_orderdate, o_orderkey)) FILTER (WHERE o_totalprice > 200000) AS b
 FROM orders GROUP BY o_custkey) p ON c_custkey = o_custkey""")
def _(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    patch = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.col("o_orderpriority")).alias("c_mktsegment"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).otherwise(F.lit(0.0)).alias("c_acctbal"),
        "o_orderdate", "o_orderkey",
    )
    return tables.patch_rows(customers, patch, "c_custkey", ["o_orderdate", "o_orderkey"])


_GONE = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"


@case("C4_J5_delete_rows", f"""SELECT 'customer' AS t, c_custkey AS id FROM customer WHERE c_custkey NOT IN ({_GONE})
UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE o_custkey NOT IN ({_GONE})""")
def _(spark, folder):
    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    gone = customers.filter("c_acctbal < 0").select("c_custkey")
    left, children = tables.delete_rows(customers, orders, gone, "c_custkey", "o_custkey")
    return left.select(F.lit("customer").alias("t"), F.col("c_custkey").alias("id")).unionByName(
        children.select(F.lit("orders").alias("t"), F.col("o_orderkey").alias("id"))
    )


def _event_arrivals(spark: SparkSession, folder: str, work: str, apply) -> None:
    """The events arrive in four steps; early, late and repeated rows in each."""
    events = table(spark, folder, "events").select(*_EVENT_COLUMNS)
    for number in range(4):
        part = events.filter(F.col("event_id") % 4 == number).unionByName(events.filter(F.col("event_id") % 40 == number + 1))
        part.write.mode("append").parquet(f"{work}/arrived")
        incremental.run_available(spark.readStream.schema(events.schema).parquet(f"{work}/arrived"), apply, f"{work}/checkpoint")


@case("I1_incremental_load", f"SELECT user_id, ts, event_id, event_type, value FROM events {_LATEST}")
def _(spark, folder):
    work = shared_dir(spark, "sync")
    name = "sync_events_" + work[-12:]
    _event_arrivals(
        spark, folder, work, lambda batch, _: incremental.upsert_into(name, batch, "user_id", ["ts", "event_id"], f"{work}/tables")
    )
    return spark.table(name)


@case("I1_change_log", f"SELECT user_id, ts, event_id, event_type, value FROM events {_LATEST}")
def _(spark, folder):
    work = shared_dir(spark, "sync")
    changes = f"{work}/changes"
    _event_arrivals(spark, folder, work, lambda batch, number: incremental.append_changes(batch, number, changes))
    events = table(spark, folder, "events").select(*_EVENT_COLUMNS)
    base = tables.latest_by_key(events.filter(_BASE_EVENTS), "user_id", ["ts", "event_id"])
    return incremental.current_rows(base, spark.read.parquet(changes), "user_id", ["ts", "event_id"])


# A document of a later file takes the place of an earlier one, with its reviews.
_SYNCED = f"""(SELECT * FROM {samples.RAW_RESTAURANTS_SQL} r
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey % 3 DESC, o_orderkey DESC) = 1)"""


@case("C5_I1_load_new_files", f"""SELECT id, name, rating, district_parsed, city, CAST(2 AS BIGINT) AS n_reviews FROM {_SYNCED} s""")
def _(spark, folder):
    """Three arrivals; the order says that a later arrival wins."""
    work = shared_dir(spark, "sync")
    store = incremental.LakeStore(f"{work}/store", (T.StructField("arrival", T.LongType()), T.StructField("o_orderkey", T.LongType())))
    raw = samples.raw_restaurants(spark, folder)
    for number in range(3):
        part = raw.filter(F.col("o_orderkey") % 3 == number).withColumn("arrival", F.lit(number))
        part.select(*schemas.RESTAURANTS_RAW.fieldNames(), "arrival", "o_orderkey").write.mode("append").json(f"{work}/arrived")
        incremental.load_new_files(store, spark, f"{work}/arrived", f"{work}/checkpoint")
    counts = store.table(spark, "reviews").groupBy("restaurant_id").agg(F.count("*").alias("n_reviews"))
    stored = store.table(spark, "restaurants").join(counts, F.col("id") == F.col("restaurant_id"))
    return stored.select("id", "name", "rating", "district_parsed", "city", "n_reviews")


# Three arrivals of orders as documents: rows come late, every fifth comes again in the next arrival, some names are too
# long, some ids are missing, and in the last arrival a cut-off line. Every ninth document has lost its reviews.
_LONG_NAME, _NO_REVIEWS = "o_orderkey % 13 = 5", "o_orderkey % 9 = 4"
_LOADED = f"""(SELECT * FROM {samples.RAW_RESTAURANTS_SQL} r WHERE NOT ({_LONG_NAME})
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
_BY_DATE = (T.StructField("o_orderdate", T.DateType()), T.StructField("o_orderkey", T.LongType()))


def _arrivals(spark: SparkSession, folder: str, work: str, store: incremental.LakeStore, then: Callable[[int], None] | None = None) -> list:
    raw = samples.raw_restaurants(spark, folder)
    raw = raw.withColumns({
        "name": F.when(F.expr(_LONG_NAME), F.repeat(F.lit("n"), F.lit(300))).otherwise(F.col("name")),
        "reviews": F.when(F.expr(_NO_REVIEWS), F.array().cast(raw.schema["reviews"].dataType)).otherwise(F.col("reviews")),
    })
    nameless = raw.filter("o_orderkey % 31 = 2").withColumn("id", F.lit(""))
    told = []
    for number in range(3):
        part = raw.filter((F.col("o_orderkey") % 3 == number) | (F.col("o_orderkey") % 15 == number - 1))
        part = part.unionByName(nameless.filter(F.col("o_orderkey") % 3 == number))
        part = part.select(*schemas.RESTAURANTS_RAW.fieldNames(), "o_orderdate", "o_orderkey")
        part.write.mode("append").json(f"{work}/arrived")
        if number == 2:
            cut = part.select(F.left(F.to_json(F.struct(*part.columns)), F.lit(60)).alias("value"))
            cut.filter("length(value) = 60").write.mode("append").text(f"{work}/arrived")
        told += incremental.load_new_files(store, spark, f"{work}/arrived", f"{work}/checkpoint")
        if number == 1:
            store.compact(spark)
        if then:
            then(number)
    return told


def _loaded_store(spark: SparkSession, folder: str) -> incremental.LakeStore:
    work = shared_dir(spark, "arrivals")
    store = incremental.LakeStore(f"{work}/store", _BY_DATE)
    _arrivals(spark, folder, work, store)
    return store


@case("C5_change_log_restaurants", f"SELECT id, name, rating, CAST(review_count AS INTEGER) AS review_count, address, district, district_parsed, city FROM {_LOADED} r")
def _(spark, folder):
    """Late, repeated and refused rows in three arrivals, with a compaction in between, give the rows of one full load."""
    return _loaded_store(spark, folder).table(spark, "restaurants")


@case("C5_change_log_reviews", f"""SELECT restaurant_id, "user", rating, comment FROM (
 SELECT id AS restaurant_id, o_orderpriority AS "user", CAST(o_orderkey % 5 + 1 AS DOUBLE) AS rating,
  'order ' || o_orderkey AS comment, o_orderkey FROM {_LOADED} r
 UNION ALL SELECT id, 'Anonymous', CAST(o_orderkey % 5 + 1 AS DOUBLE), NULL, o_orderkey FROM {_LOADED} r) u WHERE NOT ({_NO_REVIEWS})""")
def _(spark, folder):
    """The reviews of the last document of each id; a last document without reviews leaves none."""
    return _loaded_store(spark, folder).table(spark, "reviews").drop("id")


@case("C1_kept_search", " UNION ALL ".join(f"""SELECT '{term}' AS term, id, name, district_parsed FROM {_LOADED} r
 WHERE contains(lower(strip_accents(concat_ws(chr(1), id, name, district, district_parsed))), '{plain}')"""
 for term, plain in (("PLÂCE 1", "place 1"), ("quan 1", "quan 1"), ("đ1", "d1"), ("Rest_D12", "rest_d12"), ("no such place", "no such place"))))
def _(spark, folder):
    """Searches by kept postings over three arrivals, one of two characters; replaced and refused rows are not found."""
    store = _loaded_store(spark, folder)
    found = [store.search(spark, term).select(F.lit(term).alias("term"), "id", "name", "district_parsed")
             for term in ("PLÂCE 1", "quan 1", "đ1", "Rest_D12", "no such place")]
    return reduce(DataFrame.unionByName, found)


# The documents that each of the three arrivals leaves in force.
_AS_OF = f"""(SELECT a AS batch, r.* FROM {samples.RAW_RESTAURANTS_SQL} r, (SELECT unnest([0, 1, 2]) AS a) x
 WHERE NOT ({_LONG_NAME}) AND (o_orderkey % 3 <= a OR o_orderkey % 15 < a)
 QUALIFY row_number() OVER (PARTITION BY a, id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
_REVIEWS_AS_OF = f"""(SELECT batch, CAST(o_orderkey % 5 + 1 AS DOUBLE) AS rating, c AS comment FROM {_AS_OF} d,
 (SELECT unnest(['order', NULL]) AS c) y WHERE NOT ({_NO_REVIEWS}))"""
_SHOWN = "district_parsed NOT IN ('', 'null', 'Unknown')"


def _kept(number: int, **reports: DataFrame) -> DataFrame:
    """(batch, view, key, n, value) of reports of any columns."""
    none = F.lit(None).cast("double")
    rows = []
    for name, df in reports.items():
        value = F.col("avg_rating") if "avg_rating" in df.columns else none
        key, count = [c for c in df.columns if c != "avg_rating"]
        rows.append(df.select(F.lit(number).alias("batch"), F.lit(name).alias("view"), F.col(key).cast("string").alias("key"), F.col(count).alias("n"), value.alias("value")))
    return reduce(DataFrame.unionByName, rows)


@case("V1_V8_kept_views", f"""SELECT batch, 'V1' AS view, district_parsed AS key, count(*) AS n, round(avg(rating), 2) AS value FROM {_AS_OF} a WHERE {_SHOWN} GROUP BY 1, 3
UNION ALL SELECT batch, 'V3', {_HISTOGRAM}, count(*), NULL FROM {_AS_OF} b GROUP BY 1, 3
UNION ALL SELECT batch, 'V4', district_parsed, count(*), round(avg(rating), 2) FROM {_AS_OF} c WHERE {_SHOWN} GROUP BY 1, 3
UNION ALL SELECT batch, 'V5', CAST(CAST(rating AS INTEGER) AS VARCHAR), count(*), NULL FROM {_REVIEWS_AS_OF} d GROUP BY 1, 3
UNION ALL SELECT batch, 'V6', 'Dine-in', count(*), round(avg(rating), 3) FROM {_REVIEWS_AS_OF} e WHERE comment IS NOT NULL GROUP BY 1
UNION ALL SELECT batch, 'V10', CAST(rating AS VARCHAR), count(*), NULL FROM {_AS_OF} f GROUP BY 1, 3""")
def _(spark, folder):
    """After each arrival, a compaction between them, the views from the kept counts; late and replaced rows leave no trace."""
    work = shared_dir(spark, "arrivals")
    store = incremental.LakeStore(f"{work}/store", _BY_DATE)

    def look(number: int) -> None:
        restaurants, reviews = store.counted(spark, "restaurants"), store.counted(spark, "reviews")
        _kept(
            number, V1=views.rating_by_district(restaurants, weight=ROWS), V3=views.rating_histogram(restaurants, weight=ROWS),
            V4=views.top_districts(restaurants, weight=ROWS), V5=views.review_distribution(reviews, weight=ROWS),
            V6=views.delivery_sentiment(reviews, weight=ROWS), V10=views.raw_rating_histogram(restaurants, weight=ROWS),
        ).write.parquet(f"{work}/views/{number}")

    _arrivals(spark, folder, work, store, look)
    return spark.read.option("recursiveFileLookup", True).parquet(f"{work}/views")


@case("R10_change_log_rejects", f"""SELECT batch, key, count(*) AS n, min(len(reason)) AS reason_length FROM (
 SELECT a AS batch, 'rest_d' || o_custkey AS key, 'name longer than 255' AS reason
 FROM orders, (SELECT unnest([0, 1, 2]) AS a) x WHERE {_LONG_NAME} AND (o_orderkey % 3 = a OR o_orderkey % 15 = a - 1)) y GROUP BY batch, key""")
def _(spark, folder):
    """Every refused row is kept with its batch, reason and content."""
    rejects = _loaded_store(spark, folder).table(spark, "rejects")
    whole = F.get_json_object("content", "$.id") == F.col("key")
    kept = rejects.filter(whole & (F.length(F.get_json_object("content", "$.name")) == 300))
    return kept.groupBy(F.col("_batch").alias("batch"), "key").agg(F.count("*").alias("n"), F.min(F.length("reason")).alias("reason_length"))


@case("V13_batch_counters", f"""SELECT a AS batch, count(*) + count_if(o_orderkey % 31 = 2 AND o_orderkey % 3 = a) AS rows, count_if(NOT ({_LONG_NAME})) AS accepted,
 count_if({_LONG_NAME}) AS refused, count_if(o_orderkey % 31 = 2 AND o_orderkey % 3 = a) AS skipped
 FROM orders, (SELECT unnest([0, 1, 2]) AS a) x WHERE o_orderkey % 3 = a OR o_orderkey % 15 = a - 1 GROUP BY a""")
def _(spark, folder):
    """What each arrival held, from the one pass that reads it."""
    work = shared_dir(spark, "arrivals")
    told = _arrivals(spark, folder, work, incremental.LakeStore(f"{work}/store", _BY_DATE))
    rows = [(n, *(each["restaurants"][k] for k in ("rows", "accepted", "refused", "skipped"))) for n, each in enumerate(told)]
    return spark.createDataFrame(rows, "batch long, rows long, accepted long, refused long, skipped long")


@case("C5_change_log_meals", """SELECT 'meal_' || (p_partkey % 700) AS id, p_name AS name, CASE WHEN p_size % 3 <> 0 THEN p_type ELSE 'Unknown' END AS category,
 CASE WHEN p_size % 5 <> 0 THEN p_brand ELSE 'Unknown' END AS area, p_partkey AS seq FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 7 <> 0
 QUALIFY row_number() OVER (PARTITION BY p_partkey % 700 ORDER BY p_partkey DESC) = 1""")
def _(spark, folder):
    """Recipes that share ids, the later ones arriving first."""
    work = shared_dir(spark, "meals")
    store = incremental.LakeStore(f"{work}/store", (), (T.StructField("seq", T.LongType()),))
    recipes = samples.raw_recipes(spark, folder).withColumn("seq", F.col("idMeal").cast("long"))
    parsed = normalize.parse_meals(recipes).withColumn("seq", F.substring("id", 6, 20).cast("long"))
    parsed = parsed.withColumn("id", F.concat(F.lit("meal_"), F.col("seq") % 700))
    for number in (2, 1, 0):
        parsed.filter(F.col("seq") % 3 == number).write.mode("append").json(f"{work}/arrived")
        incremental.load_new_files(store, spark, f"{work}/arrived", f"{work}/checkpoint", meals=True)
        store.compact(spark)
    log = store.logs["meals"].current(spark)
    return store.table(spark, "meals").join(log.select("id", "seq"), "id").select("id", "name", "category", "area", "seq")


@case("J3_late_parents", """SELECT o_orderkey, CASE WHEN p > 2 THEN -1 ELSE greatest(p, c) END AS stored_in, CASE WHEN p > 2 THEN 2 - c END AS age FROM (
 SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN 9 ELSE o_custkey % 3 END AS p, o_orderkey % 3 AS c FROM orders) x""")
def _(spark, folder):
    """Orders come in three batches, often before their customer; every fifth customer never comes."""
    work = shared_dir(spark, "parking")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = orders.select(F.col("o_custkey").alias("c_custkey")).distinct().filter("c_custkey % 5 <> 0")
    parking = Parking(f"{work}/parked", "o_orderkey", "o_custkey", orders.schema)
    for number in range(3):
        new, known = customers.filter(F.col("c_custkey") % 3 == number), customers.filter(F.col("c_custkey") % 3 <= number)
        stored = parking.arrive(orders.filter(F.col("o_orderkey") % 3 == number), known, new, number)
        stored.select("o_orderkey", F.lit(number).alias("stored_in"), F.lit(None).cast("long").alias("age")).write.mode("append").parquet(f"{work}/stored")
    waiting = parking.waiting(spark, 2).select("o_orderkey", F.lit(-1).alias("stored_in"), "age")
    return spark.read.parquet(f"{work}/stored").unionByName(waiting)


@case("V13_import_and_recipe_counters", """SELECT 'import' AS what, count(*) AS rows, count_if(o_orderkey % 10 <> 3) AS merged, count_if(o_orderkey % 10 = 3) AS skipped FROM orders
UNION ALL SELECT 'recipes', count(*), count_if(p_partkey % 11 <> 0), count_if(p_partkey % 11 = 0) FROM part
UNION ALL SELECT 'recipes again', count(*), count_if(p_partkey % 11 <> 0), count_if(p_partkey % 11 = 0) FROM part
UNION ALL SELECT 'stored', count(*), 0, 0 FROM part WHERE p_partkey % 11 <> 0""")
def _(spark, folder):
    """Counters of a file import with records that have no id, and of two ingests of all recipes into a stored collection."""
    work, counters = shared_dir(spark, "import"), {}
    key = F.col("o_orderkey")
    record = F.struct(F.when(key % 10 != 3, F.concat(F.lit("d"), F.col("o_custkey"))).otherwise(F.lit("")).alias("_id"), F.concat(F.lit("Place "), key).alias("name"))
    # Files of bounded size; each line is a whole array.
    arrays = table(spark, folder, "orders").groupBy(F.floor(key / 2000).alias("part")).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.repartition("part").write.partitionBy("part").text(f"{work}/arrays")
    ingest.import_collection(spark, f"{work}/arrays", schemas.DOCUMENTS_RAW, "import_" + work[-12:], counters)
    recipes, name = samples.raw_recipes(spark, folder), "recipes_" + work[-12:]
    first, again = ingest.store_meals(spark, recipes, name), ingest.store_meals(spark, recipes, name)
    rows = [(what, c["rows"], c["merged"], c["skipped"]) for what, c in (("import", counters), ("recipes", first), ("recipes again", again))]
    return spark.createDataFrame([*rows, ("stored", spark.table(name).count(), 0, 0)], "what string, rows long, merged long, skipped long")


# === files (S) ====================================================================


@case("S2_json_lines", """SELECT event_id AS id, event_type AS name, CASE WHEN event_id % 11 = 4 THEN NULL ELSE user_id END AS rating
FROM events WHERE event_id % 11 NOT IN (0, 1, 2, 3)""")
def _(spark, folder):
    """Lines that are no JSON, cut off, followed by other text or an array go; one unfit field does not matter."""
    good = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("name"), F.col("user_id").alias("rating")))
    kind = F.col("event_id") % 11
    line = (
        F.when(kind == 0, F.lit("{not json")).when(kind == 1, F.concat(good, F.lit(" trailing")))
        .when(kind == 2, F.concat(F.lit("["), good, F.lit("]"))).when(kind == 3, F.expr("left(to_json(struct(event_id AS id, event_type AS name)), 20)"))
        .when(kind == 4, F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("name"), F.lit(True).alias("rating"))))
        .otherwise(good)
    )
    path = shared_dir(spark, "lines")
    table(spark, folder, "events").select(line.alias("value")).write.text(path)
    return readers.read_json_lines(spark, path, schemas.struct(id=T.LongType(), name=T.StringType(), rating=T.LongType()))


@case("S2_reading_order", """SELECT event_id % 50 AS id, max(event_id) FILTER (WHERE event_id % 3 = 2) AS small_last,
 max(event_id) FILTER (WHERE event_id % 3 <> 2) AS large_last FROM events GROUP BY 1""")
def _(spark, folder):
    """Files by ranges of the value, of unequal size: of an id the last line of the last file by name stays."""
    root = shared_dir(spark, "ordered")
    events = table(spark, folder, "events").select((F.col("event_id") % 50).alias("id"), F.col("event_id").alias("value"))
    small, large = events.filter("value % 3 = 2"), events.filter("value % 3 <> 2")
    for first, second, name in ((large, small, "small_last"), (small, large, "large_last")):
        for part, rows in (("part=1", first), ("part=2", second)):
            # Names in the order of the values; a line's place in its file is that of its value.
            named = rows.withColumn("range", F.lpad(F.floor(F.col("value") / 20000).cast("string"), 12, "0"))
            named.repartition("range").sortWithinPartitions("range", "value").write.partitionBy("range").json(f"{root}/{name}/{part}")
    schema = schemas.struct(id=T.LongType(), value=T.LongType())
    found = []
    for name in ("small_last", "large_last"):
        lines = readers.read_json_lines(spark, f"{root}/{name}", schema, sequence=True)
        found.append(tables.latest_by_key(lines, "id", [readers.SEQUENCE]).select("id", F.col("value").alias(name)))
    return found[0].join(found[1], "id")


@case("S1_read_json_array", "SELECT c_custkey AS id, c_name AS name FROM customer")
def _(spark, folder):
    path = shared_dir(spark, "array")
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    writers.write_json_arrays(rows, path, F.floor(F.col("id") / 2000))
    return readers.read_json_array(spark, path, schemas.struct(id=T.LongType(), name=T.StringType()))


@case("S1_large_json_arrays", """SELECT event_id AS id, event_type || ' "{[' || chr(92) || '}' || chr(10) AS name, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 2 END AS n,
 CAST(CASE WHEN event_id % 3 > 0 THEN value END AS DOUBLE) AS last, (event_id // 20000) AS file, event_id % 20000 AS place FROM events""")
def _(spark, folder):
    """Arrays in long lines, read by byte ranges; texts hold quotes, braces, backslashes and line ends."""
    path = shared_dir(spark, "large")
    name = F.concat("event_type", F.lit(' "{[' + chr(92) + "}" + chr(10)))
    inner = F.when(F.col("event_id") % 3 > 0, F.array(F.struct(F.lit("}").alias("t"), (F.col("value") - 1).alias("v")), F.struct(F.lit("]").alias("t"), F.col("value").alias("v"))))
    events = table(spark, folder, "events")
    record = F.struct(F.col("event_id").alias("id"), name.alias("name"), F.coalesce(inner, F.array().cast("array<struct<t:string,v:double>>")).alias("list"))
    arrays = events.groupBy(F.floor(F.col("event_id") / 20000).alias("part")).agg(F.array_sort(F.collect_list(record)).alias("rows"))
    arrays.select("part", F.to_json("rows").alias("value")).repartition("part").write.partitionBy("part").text(path)
    schema = T.StructType.fromDDL("id long, name string, list array<struct<t:string,v:double>>")
    found = readers.read_large_json_array(spark, path, schema, sequence=True)
    part = F.regexp_extract(F.col("_seq.file"), "part=([0-9]+)", 1).cast("long")
    return found.select("id", "name", F.size("list").alias("n"), F.get("list", F.lit(1))["v"].alias("last"), part.alias("file"), F.col("_seq.element").alias("place"))


@case("S7_S8_seed", "SELECT DISTINCT p_brand AS name, p_type AS kind FROM part")
def _(spark, folder):
    path = shared_dir(spark, "seed")
    seed = table(spark, folder, "part").select(F.col("p_brand").alias("name"), F.col("p_type").alias("kind")).distinct()
    writers.save_seed(seed, path)
    return readers.read_seed(spark, path, schemas.struct(name=T.StringType(), kind=T.StringType()), required=True)


@case("O6_sample_head", "SELECT least(20, count(*)) AS n FROM customer")
def _(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey")
    return tables.sample_head(customers, 20).join(customers, "c_custkey", "left_semi").agg(F.count("*").alias("n"))


@case("S4_S6_export_documents", "SELECT CAST(doc_id AS VARCHAR) AS id, lang, n_chars FROM documents")
def _(spark, folder):
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("_id"), "lang", "n_chars")
    path = shared_dir(spark, "export")
    writers.publish_files(writers.export_documents(documents), path)
    return spark.read.schema("id STRING, lang STRING, n_chars BIGINT").json(path)


@case("S5_export_table", "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS price FROM orders")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    path = shared_dir(spark, "export")
    writers.publish_files(writers.export_table(orders, "orders"), path)
    return spark.read.schema("o_orderkey BIGINT, price DOUBLE").json(path)


@case("S9_S10_results", "SELECT lang AS key, CAST(count(*) AS VARCHAR) AS value FROM documents GROUP BY lang")
def _(spark, folder):
    path = shared_dir(spark, "results")
    counts = views.category_frequency(table(spark, folder, "documents"), "lang")
    writers.write_results(counts, path, "category", ["cnt"])
    return readers.read_results(spark, path)


@case("S10_object_results", """SELECT lang AS key, '{"cnt":' || count(*) || ',"longest":' || max(n_chars) || '}' AS value FROM documents GROUP BY lang""")
def _(spark, folder):
    path = shared_dir(spark, "results")
    grouped = table(spark, folder, "documents").groupBy("lang").agg(F.count("*").alias("cnt"), F.max("n_chars").alias("longest"))
    writers.write_results(grouped, path, "lang", ["cnt", "longest"])
    return readers.read_results(spark, path)


@case("S12_conform", """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_acctbal AS DOUBLE) AS rating,
 0 AS review_count, CAST(NULL AS VARCHAR) AS address, 'Unknown' AS district, 'Unknown' AS district_parsed,
 c_mktsegment AS city FROM customer""")
def _(spark, folder):
    old = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("rating"),
        F.col("c_mktsegment").alias("city"), F.col("c_nationkey").alias("price_range"),
    )
    return schemas.conform(old, schemas.RESTAURANTS, schemas.RESTAURANT_DEFAULTS)


@case("S13_snapshot", "SELECT c_custkey, c_name FROM customer")
def _(spark, folder):
    table(spark, folder, "customer").select("c_custkey", "c_name").createOrReplaceTempView("customers_to_save")
    root = shared_dir(spark, "backups")
    name, _, _ = snapshots.snapshot(spark, ["customers_to_save"], root)
    return spark.read.parquet(f"{root}/{name}/customers_to_save")


@case("S14_restore", "SELECT c_custkey, c_name FROM customer")
def _(spark, folder):
    root = shared_dir(spark, "backups")
    name = "customers_" + root[-12:]
    table(spark, folder, "customer").select("c_custkey", "c_name").createOrReplaceTempView(name)
    backup, _, _ = snapshots.snapshot(spark, [name], root)
    spark.catalog.dropTempView(name)
    snapshots.restore(spark, [name], root, backup, f"{root}/tables")
    return spark.table(name)


@case("S13_S14_incremental_backup", """SELECT 0 AS backup, c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT 1, c_custkey, CASE WHEN c_custkey % 50 = 7 THEN c_name || '!' ELSE c_name END, c_acctbal FROM customer WHERE c_custkey % 90 <> 11""")
def _(spark, folder):
    """Two backups, the second after a patch and deletes; rows of both moments, restored from shared buckets."""
    root = shared_dir(spark, "backups")
    name = "backed_" + root[-12:]
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    patched = customers.withColumn("c_name", F.when(F.col("c_custkey") % 50 == 7, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")))
    moments = []
    for number, rows in enumerate((customers, patched.filter("c_custkey % 90 <> 11"))):
        rows.createOrReplaceTempView(name)
        moment = datetime(2024, 1, 1 + number, tzinfo=timezone.utc)
        moments.append(snapshots.incremental_snapshot(spark, {name: ["c_custkey"]}, root, now=moment)[0])
    spark.catalog.dropTempView(name)
    found = [snapshots.snapshot_rows(spark, root, moment, name).withColumn("backup", F.lit(n)) for n, moment in enumerate(moments)]
    return found[0].unionByName(found[1])


def _lake(spark: SparkSession, folder: str) -> str:
    """A database of external tables over a lake written from the samples, with its stored views."""
    root = shared_dir(spark, "lake")
    venues = schemas.conform(samples.venues(spark, folder), schemas.RESTAURANTS, {"name": fv.DEFAULT_RESTAURANT_NAME})
    reviews = samples.labelled_reviews(spark, folder).withColumn("restaurant_id", F.col("doc_id").cast("string"))
    meals = normalize.parse_meals(samples.raw_recipes(spark, folder))
    flat_meals = normalize.meals_table(meals).accepted
    ingest.export_lake(
        {"restaurants": schemas.conform(venues, schemas.NESTED_RESTAURANTS), "meals": meals},
        {"restaurants": venues, "reviews": schemas.conform(reviews, schemas.REVIEWS), "meals": flat_meals},
        root,
    )
    database = "lake_" + root[-12:]
    readers.create_external_tables(spark, root, database)
    views.create_views(spark, database)
    return database


_MEAL_GROUPS = f"(SELECT category, area FROM {samples.PARSED_RECIPES_SQL} p)"


@case("S3_stored_views", f"""SELECT 'view_rating_by_district' AS view, district AS key, CAST(total_count AS BIGINT) AS n, avg_rating AS value FROM ({_V1}) a
UNION ALL SELECT 'view_top_districts', district, restaurant_count, avg_rating FROM ({_V4}) b
UNION ALL SELECT 'view_cuisine_frequency', category, count(*), NULL FROM {_MEAL_GROUPS} c WHERE category <> '' GROUP BY 2
UNION ALL SELECT 'view_cuisine_area', area, count(*), NULL FROM {_MEAL_GROUPS} d WHERE area <> '' GROUP BY 2
UNION ALL SELECT 'view_rating_histogram', {_HISTOGRAM}, count(*), NULL FROM {samples.VENUES_SQL} e WHERE rating IS NOT NULL GROUP BY 2
UNION ALL SELECT 'view_review_distribution', CAST(CAST(trunc(rating) AS INTEGER) AS VARCHAR), count(*), NULL
 FROM {samples.LABELLED_REVIEWS_SQL} f WHERE rating BETWEEN 1 AND 5 GROUP BY 2
UNION ALL SELECT 'view_delivery_sentiment', service_type, review_count, avg_rating FROM ({_service_sql(fv.DELIVERY_LIKE_PATTERNS)}) g""")
def _(spark, folder):
    """All seven views, read by another session of the catalog."""
    database = _lake(spark, folder)
    other = spark.newSession()
    read = lambda name, key, n, value="NULL": (
        f"SELECT '{name}' AS view, CAST({key} AS STRING) AS key, {n} AS n, CAST({value} AS DOUBLE) AS value FROM {database}.{name}"
    )
    return other.sql(" UNION ALL ".join([
        read("view_rating_by_district", "district", "total_count", "avg_rating"), read("view_top_districts", "district", "restaurant_count", "avg_rating"),
        read("view_cuisine_frequency", "category", "cnt"), read("view_cuisine_area", "area", "meal_count"),
        read("view_rating_histogram", "rating_group", "restaurant_count"), read("view_review_distribution", "stars", "cnt"),
        read("view_delivery_sentiment", "service_type", "review_count", "avg_rating"),
    ]))


@case("S3_external_tables", f"""SELECT 'restaurants' AS name, count(*) AS n, count(rating) AS filled FROM {samples.VENUES_SQL} v
UNION ALL SELECT 'nested_restaurants', count(*), count(rating) FROM {samples.VENUES_SQL} v
UNION ALL SELECT 'reviews', count(*), count(rating) FROM {samples.LABELLED_REVIEWS_SQL} r
UNION ALL SELECT 'nested_meals', count(*), count(name) FROM {samples.PARSED_RECIPES_SQL} m
UNION ALL SELECT 'meals', count(*), count(name) FROM {samples.PARSED_RECIPES_SQL} m WHERE name IS NOT NULL""")
def _(spark, folder):
    database = _lake(spark, folder)
    of = {
        "restaurants": (fv.RESTAURANTS_TABLE, "rating"), "nested_restaurants": (fv.NESTED_RESTAURANTS_TABLE, "rating"), "reviews": (fv.REVIEWS_TABLE, "rating"),
        "nested_meals": (fv.NESTED_MEALS_TABLE, "name"), "meals": (fv.MEALS_TABLE, "name"),
    }
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n, count({column}) AS filled FROM {database}.{stored}" for name, (stored, column) in of.items()
    ))


_RAW_FILES_SQL = f"""WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey % 4 AS kind, o_orderkey % 5 + 1 AS stars,
  o_orderkey % 3 AS said FROM orders)
SELECT 'rating_by_area' AS job, 'Quận ' || (o_custkey % 20 + 1) AS key,
  '{{"avg_rating":' || CAST(round_even(avg(stars + 0.5), 2) AS DOUBLE) || ',"restaurant_count":' || count(*) || '}}' AS value
 FROM r WHERE kind <> 2 GROUP BY 2
UNION ALL SELECT 'tag_count', tag, CAST(count(*) AS VARCHAR) FROM (
  SELECT category AS tag FROM {samples.PARSED_RECIPES_SQL} m UNION ALL SELECT area FROM {samples.PARSED_RECIPES_SQL} m) t
 WHERE tag <> '' GROUP BY 2
UNION ALL SELECT 'rating_bucket', CASE WHEN kind = 2 THEN 'Unknown' WHEN stars + 0.5 >= 4 THEN '4-5 Stars'
  WHEN stars + 0.5 >= 3 THEN '3 Stars' ELSE '1-2 Stars' END, CAST(count(*) AS VARCHAR) FROM r GROUP BY 2
UNION ALL SELECT 'lexicon_sentiment', 'Place ' || o_custkey, '{{"avg_sentiment_score":' ||
  CAST(round_even(avg(CASE said WHEN 0 THEN 1.0 WHEN 1 THEN -1.0 ELSE 0.0 END), 3) AS DOUBLE) || ',"reviews_analyzed":' || count(*) || '}}'
 FROM r WHERE kind <> 1 GROUP BY 2
UNION ALL SELECT 'term_match_count', CASE said WHEN 0 THEN 'beef' ELSE 'chicken' END, CAST(count(*) AS VARCHAR) FROM r WHERE said <> 1 GROUP BY 2
UNION ALL (SELECT 'top_reviewed', 'Place ' || o_custkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) FROM r WHERE kind = 0
 ORDER BY floor(o_totalprice) DESC, 2 LIMIT 10)
UNION ALL SELECT 'review_star_distribution', stars || CASE WHEN stars > 1 THEN ' Stars' ELSE ' Star' END, CAST(count(*) AS VARCHAR) FROM r GROUP BY 2
UNION ALL SELECT 'delivery_vs_dinein_venue', CASE said WHEN 1 THEN 'Delivery-Friendly' ELSE 'Dine-In-Only' END,
  '{{"avg_rating":' || CAST(round_even(avg(stars + 0.5), 2) AS DOUBLE) || ',"restaurant_count":' || count(*) || '}}'
 FROM r WHERE kind <> 2 GROUP BY 2"""


@case("A9_run_all", _RAW_FILES_SQL)
def _(spark, folder):
    """All eight jobs over lake files; comments hold words of every shipped list."""
    root = shared_dir(spark, "jobs")
    key = F.col("o_orderkey")
    comment = F.when(key % 3 == 0, F.lit("A good beef")).when(key % 3 == 1, F.lit("bad Delivery")).otherwise(F.lit("plain chicken!"))
    review = F.struct(F.lit("u").alias("user"), F.concat((key % 5 + 1).cast("string"), F.lit(" of 5 bubbles")).alias("rating"), comment.alias("comment"))
    raw = samples.raw_restaurants(spark, folder).withColumn("reviews", F.array(review))
    raw.select(*schemas.RESTAURANTS_RAW.fieldNames()).write.json(f"{root}/restaurants")
    normalize.parse_meals(samples.raw_recipes(spark, folder)).write.json(f"{root}/meals")
    runner.run_all(spark, f"{root}/restaurants", f"{root}/meals", f"{root}/out")
    results = [
        readers.read_results(spark, f"{root}/out/{job.name}").select(F.lit(job.name).alias("job"), "key", "value") for job in runner.JOBS
    ]
    return reduce(DataFrame.unionByName, results)


_NO_NAME = f"{samples.PARSED_RECIPES_SQL} m WHERE name IS NOT NULL"


@case("V13_R4_R8_R10_S11_S15_load", f"""SELECT 'restaurants' AS table_name, count(DISTINCT o_custkey) AS n FROM orders
UNION ALL SELECT 'reviews', 2 * count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'meals', count(*) FROM {_NO_NAME} AND length(id) <= 8
UNION ALL SELECT 'skipped', count(*) FROM {_NO_NAME} AND length(id) > 8
UNION ALL SELECT 'rejects', count(*) FROM {_NO_NAME} AND length(id) > 8
UNION ALL SELECT 'tables after the wipe', 0""")
def _(spark, folder):
    """Counters of a load with refused rows, the stored rejects, and what a wipe leaves."""
    database = "load_" + shared_dir(spark, "load")[-12:]
    meals = normalize.parse_meals(samples.raw_recipes(spark, folder))
    # An area too long for its column where the id is long.
    meals = meals.withColumn("area", F.when(F.length("id") > 8, F.repeat(F.lit("x"), F.lit(200))).otherwise(F.col("area")))
    counters = ingest.load_documents(spark, samples.raw_restaurants(spark, folder), meals, database, _ORDER, ())
    counters["rejects"] = spark.table(f"{database}.rejects").filter("table = 'meals' AND reason LIKE 'area longer%'").count()
    wipe(spark, database)
    counters["tables after the wipe"] = spark.sql(f"SHOW DATABASES LIKE '{database}'").count()
    return spark.createDataFrame(list(counters.items()), "table_name string, n bigint")
