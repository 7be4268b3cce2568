"""Some of the functions for users who write SQL.

They are SQL functions, not Python ones: the optimizer puts their bodies into
the query. The tests hold them against the column functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_PLAIN = r"^\s*([+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"
_NUMBER = f"nullif(regexp_extract(v, r'{_PLAIN}', 1), '')"

FUNCTIONS = {
    # N13
    "strict_float(v STRING) RETURNS DOUBLE": f"try_cast({_NUMBER} AS DOUBLE)",
    # N3
    "extract_float(v STRING) RETURNS DOUBLE": (
        f"try_cast(coalesce({_NUMBER}, nullif(regexp_extract(v, r'([0-9]+([.][0-9]+)?)', 1), '')) AS DOUBLE)"
    ),
    # N2
    "parse_review_rating(v STRING) RETURNS DOUBLE": (
        f"try_cast(coalesce({_NUMBER}, "
        r"nullif(regexp_extract(v, r'(?i)^\s*([0-9]+(?:[.][0-9]+)?)\s+of\s+[0-9]+', 1), '')) AS DOUBLE)"
    ),
    # N1
    "parse_review_count(v STRING) RETURNS BIGINT": (
        f"CASE WHEN v IS NULL THEN 0 WHEN {_NUMBER} RLIKE '^[+-]?[0-9]+$' THEN try_cast({_NUMBER} AS BIGINT) "
        f"WHEN {_NUMBER} IS NOT NULL THEN try_cast(try_cast({_NUMBER} AS DOUBLE) AS BIGINT) "
        "WHEN regexp_replace(v, '[^0-9]', '') = '' THEN 0 "
        "ELSE try_cast(regexp_replace(v, '[^0-9]', '') AS BIGINT) END"
    ),
    # N4
    "make_short_id(v STRING) RETURNS STRING": (
        "CASE WHEN v IS NULL THEN '' WHEN regexp_extract(v, '-(d[0-9]+)-', 1) <> '' "
        "THEN concat('rest_', regexp_extract(v, '-(d[0-9]+)-', 1)) ELSE v END"
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; they stay until it ends."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in FUNCTIONS]
