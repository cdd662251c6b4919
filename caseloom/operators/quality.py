"""Checks on tables: each returns the rows, keys or counts that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """column_name, violations - in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns])
    return counts.select(F.inline(pairs))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. NULL is not a value."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("times")).where("times > 1")


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list, with their number of rows."""
    return df.where(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("times"))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values without a parent row, with their number of rows: combined before the join, so a hot key is one row."""
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("times"))
    return used.join(parent.select(F.col(key).alias("value")), "value", "left_anti")


def accepted_range(df: DataFrame, column: str, least=None, most=None) -> DataFrame:
    """Rows outside the range."""
    bad = [F.col(column) < least] if least is not None else []
    bad += [F.col(column) > most] if most is not None else []
    return df.where(reduce(lambda a, b: a | b, bad)) if bad else df.limit(0)


def reconcile(fact: DataFrame, stg: DataFrame, start: str, end: str) -> DataFrame:
    """One row if the fact's total differs from the cases within the calendar, else none."""
    gold = fact.agg(F.coalesce(F.sum("case_count"), F.lit(0)).alias("gold_cases"))
    silver = stg.where(F.col("report_date").between(start, end)).agg(F.count("*").alias("silver_cases"))
    return gold.join(silver, F.lit(True)).where("gold_cases <> silver_cases")  # one row each


def no_future_dates(stg: DataFrame) -> DataFrame:
    return stg.where("report_date > ingest_date")


def violations(name: str, broken: DataFrame) -> DataFrame:
    """check, violations: how many rows a check returned."""
    return broken.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def _not_null_rows(table: str, df: DataFrame, *columns: str) -> DataFrame:
    return not_null(df, *columns).select(F.concat(F.lit(f"not_null {table}."), "column_name").alias("check"), "violations")


def mart_checks(cases: DataFrame, stg: DataFrame, facilities: DataFrame, conditions: DataFrame, fact: DataFrame, rollup: DataFrame, spine: tuple[str, str]) -> DataFrame:
    """check, violations: the 24 checks of the built marts and their source; a healthy lake has none above 0.

    NULLs of a table are counted in one pass; keys are combined before they are compared."""
    checks = [
        _not_null_rows("ecr_cases", cases, "message_control_id", "report_date"),
        _not_null_rows("dim_facility", facilities, "facility_sk", "facility_id"),
        _not_null_rows("dim_condition", conditions, "condition_sk", "condition_code"),
        _not_null_rows("fct_case_daily", fact, "case_daily_sk", "report_date", "facility_id", "condition_code", "case_count"),
        _not_null_rows("agg_condition_daily_state", rollup, "report_date"),
        *[violations(f"unique {t}.{c}", unique(df, c)) for t, df, cs in (("dim_facility", facilities, ("facility_sk", "facility_id")), ("dim_condition", conditions, ("condition_sk", "condition_code")), ("fct_case_daily", fact, ("case_daily_sk",))) for c in cs],
        violations("accepted dim_facility.reporting_status", accepted_values(facilities, "reporting_status", ["active", "stale"])),
        violations("accepted dim_condition.condition_group", accepted_values(conditions, "condition_group", ["enteric", "respiratory", "other"])),
        violations("relationship fct_case_daily.facility_id", relationships(fact, "facility_id", facilities, "facility_id")),
        violations("relationship fct_case_daily.condition_code", relationships(fact, "condition_code", conditions, "condition_code")),
        violations("range fct_case_daily.case_count", accepted_range(fact, "case_count", least=0)),
        violations("gold reconciles silver", reconcile(fact, stg, *spine)),
        violations("no future report dates", no_future_dates(stg)),
    ]
    return reduce(DataFrame.unionByName, checks)
