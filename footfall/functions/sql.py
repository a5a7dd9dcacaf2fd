"""The scalar functions under SQL names, as functions with a SQL body: they are inlined into a query's plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

BLANKS = r"' \t\r\n\f\u000B'"

# name: (parameters, result, body)
SQL_FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "safe_text": (
        "value STRING", "STRING",
        "nullif(replace(replace(regexp_replace(CASE WHEN lower(value) <> 'null' THEN"
        rf" btrim(value, {BLANKS}) END, r'(?s)\A([\x22\x27])(?:(.*)\1)?\z', '$2'), '\"\"', '\"'), '\'\'', '\''), '')",
    ),
    "safe_whole": ("value STRING", "BIGINT", r"TRY_CAST(btrim(value, '\"\'') AS BIGINT)"),
    "safe_number": (
        "value STRING", "DOUBLE",
        r"CASE WHEN NOT value RLIKE r'[0-9.][dDfF][\s\x22\x27]*$' THEN TRY_CAST(btrim(value, '\"\'') AS DOUBLE) END",
    ),
    "event_category": (
        "type STRING, title STRING", "STRING",
        "CASE WHEN type IN ('view', 'VIEW') THEN 'view' WHEN type IN ('click', 'CLICK') THEN 'click'"
        " WHEN contains(lower(title), 'view') THEN 'view' WHEN contains(lower(title), 'click') THEN 'click'"
        " ELSE 'other' END",
    ),
    "percent_of": (
        "part DOUBLE, whole DOUBLE", "DOUBLE", "coalesce(try_divide(part, whole) * 100.0D, 0.0D)",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Create the functions for this session; a second call replaces them by the same."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
