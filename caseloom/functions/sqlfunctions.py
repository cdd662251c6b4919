"""The library's scalar functions for SQL sessions, as SQL-defined temporary functions: no Python runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name -> (parameters, result type, body).
FUNCTIONS = {
    "hl7_segment": ("p STRING, name STRING", "STRING", r"nullif(regexp_extract(p, concat('(?:^|[\\r\\n])(', name, '\\|[^\\r\\n]*)'), 1), '')"),
    "hl7_field": ("seg STRING, i INT", "STRING", r"try_element_at(split(seg, '\\|', -1), i)"),
    "hl7_component": ("fld STRING, i INT", "STRING", r"try_element_at(split(fld, '\\^', -1), i)"),
    "strict_date": ("t STRING", "DATE", r"CASE WHEN t RLIKE '\\A[0-9]{8}\\z' THEN CAST(try_to_timestamp(t, 'yyyyMMdd') AS DATE) END"),
    "strict_moment": ("t STRING", "TIMESTAMP", r"CASE WHEN t RLIKE '\\A[0-9]{14}\\z' THEN try_to_timestamp(t, 'yyyyMMddHHmmss') END"),
    "age_band": ("a BIGINT", "STRING", "CASE WHEN a < 5 THEN '0-4' WHEN a < 18 THEN '5-17' WHEN a < 50 THEN '18-49' WHEN a < 65 THEN '50-64' ELSE '65+' END"),
    "days_between": ("a DATE, b DATE", "INT", "datediff(b, a)"),
}


def register(spark: SparkSession) -> list[str]:
    """Defines the functions in the session; returns their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
