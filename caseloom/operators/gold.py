"""Gold: staging view, two dimensions, the zero-filled daily fact with lagged baselines, and its rollup."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseloom.functions.keys import is_weekend, surrogate_key

#: Conditions with a playbook of their own; a parameter of :func:`dim_condition`.
GROUPS = {"enteric": ("Salmonellosis", "Shigellosis", "Hepatitis A"), "respiratory": ("Influenza", "COVID-19", "Pertussis")}
SPINE = ("2025-11-03", "2026-06-30")
STALE_AFTER_DAYS, BASELINE_MIN_DAYS = 14, 21
CONDITIONS_AT_ONCE = 10_000


def staging(cases: DataFrame) -> DataFrame:
    """Confirmed positives, renamed and cast. An unknown result drops out."""
    return cases.where("is_positive").select(
        F.col("message_control_id").alias("case_id"), "facility_id", "condition_code", F.col("condition_display").alias("condition_name"),
        "condition_system", F.col("report_date").cast("date").alias("report_date"),
        F.col("specimen_collection_date").cast("date").alias("specimen_collection_date"), "patient_key", "age_years", "age_band", "sex",
        "county", "state", "postal_code", "clinical_note", "retransmission_count", F.col("ingest_date").try_cast("date").alias("ingest_date"),
    )


def reporting_status(days: Column) -> Column:
    return F.when(days > STALE_AFTER_DAYS, "stale").otherwise("active")


def dim_facility(stg: DataFrame, spine_end: str = SPINE[1]) -> DataFrame:
    agg = stg.groupBy("facility_id").agg(
        F.max("county").alias("county"), F.max("state").alias("state"), F.min("report_date").alias("first_reported_on"),
        F.max("report_date").alias("last_reported_on"), F.count("*").alias("lifetime_case_count"),
        F.countDistinct("condition_code").alias("distinct_conditions_reported"), F.countDistinct("report_date").alias("reporting_days"),
    )
    days = F.datediff(F.lit(spine_end).cast("date"), F.col("last_reported_on")).cast("bigint")
    return agg.select(surrogate_key("facility_id").alias("facility_sk"), "*", days.alias("days_since_last_report"), reporting_status(days).alias("reporting_status"))


def dim_condition(stg: DataFrame, groups: dict[str, tuple[str, ...]] = GROUPS) -> DataFrame:
    agg = stg.groupBy("condition_code").agg(
        F.max("condition_name").alias("condition_name"), F.max("condition_system").alias("code_system"), F.count("*").alias("lifetime_case_count")
    )
    group = F.lit("other")
    for name, members in groups.items():
        group = F.when(F.col("condition_name").isin(*members), name).otherwise(group)
    return agg.select(surrogate_key("condition_code").alias("condition_sk"), "*", group.alias("condition_group"))


def daily_counts(stg: DataFrame) -> DataFrame:
    return stg.groupBy("report_date", "facility_id", "condition_code").agg(
        F.count("*").alias("case_count"), F.countDistinct("patient_key").alias("distinct_patients"),
        F.avg("age_years").alias("mean_age_years"), F.sum("retransmission_count").alias("retransmissions"),
    )


def fact_daily(stg: DataFrame, facilities: DataFrame, conditions: DataFrame, spine: tuple[str, str] = SPINE, min_days: int = BASELINE_MIN_DAYS) -> DataFrame:
    """One row per day, facility and condition of the calendar, silent ones with zeros.

    Conditions travel as one array, a single literal of the plan (of several, where there are more than
    ``CONDITIONS_AT_ONCE``), so that facilities and conditions are paired without a join.
    The days a series has cases are gathered as one map (no larger than the calendar), joined to the pairs
    of facility and condition, and only then is the calendar exploded: the dense panel is already
    partitioned by series, so the windows need a sort but no shuffle. A baseline never contains its own day.
    """
    codes = [r.asDict() for r in conditions.select("condition_code", "condition_name", "condition_group").orderBy("condition_code").collect()]
    kind = "array<struct<condition_code:string,condition_name:string,condition_group:string>>"
    parts = [codes[k : k + CONDITIONS_AT_ONCE] for k in range(0, len(codes), CONDITIONS_AT_ONCE)] or [[]]
    paired = reduce(DataFrame.unionByName, [facilities.select("facility_id", "county", F.inline(F.from_json(F.lit(json.dumps(p)), kind))) for p in parts])
    first, last = (F.lit(d).cast("date") for d in spine)
    figures = ["case_count", "distinct_patients", "mean_age_years", "retransmissions"]
    seen = daily_counts(stg).where(F.col("report_date").between(first, last))
    kept = seen.groupBy("facility_id", "condition_code").agg(F.map_from_entries(F.collect_list(F.struct("report_date", F.struct(*figures)))).alias("_seen"))
    pairs = paired.join(kept, ["facility_id", "condition_code"], "left")
    panel = pairs.select("*", F.explode(F.sequence(first, last)).alias("report_date")).withColumn("_day", F.col("_seen")[F.col("report_date")])
    filled = panel.select(
        "report_date", "facility_id", "county", "condition_code", "condition_name", "condition_group",
        *[F.coalesce(F.col(f"_day.{c}"), F.lit(0).cast("bigint")).alias(c) if c != "mean_age_years" else F.col(f"_day.{c}") for c in figures],
    )
    series = Window.partitionBy("facility_id", "condition_code").orderBy("report_date")
    week, month = series.rowsBetween(-6, 0), series.rowsBetween(-28, -1)
    windowed = filled.withColumns({
        "cases_trailing_7d": F.sum("case_count").over(week), "baseline_mean_28d": F.avg("case_count").over(month),
        "baseline_sd_28d": F.stddev_samp("case_count").over(month), "baseline_days": F.count("*").over(month),
    })
    z = F.when((F.col("baseline_days") >= min_days) & (F.col("baseline_sd_28d") > 0), (F.col("case_count") - F.col("baseline_mean_28d")) / F.col("baseline_sd_28d"))
    return windowed.select(
        surrogate_key("report_date", "facility_id", "condition_code").alias("case_daily_sk"), "report_date", "facility_id", "county",
        "condition_code", "condition_name", "condition_group", "case_count", "distinct_patients", "mean_age_years", "retransmissions",
        "cases_trailing_7d", "baseline_mean_28d", "baseline_sd_28d", "baseline_days", z.alias("baseline_z"),
        is_weekend(F.col("report_date")).alias("is_weekend"), F.weekofyear("report_date").alias("epi_week"),
    )


def daily_rollup(fact: DataFrame) -> DataFrame:
    """Statewide figures per day and condition. The fact has one row per facility, so facilities are counted, not deduplicated."""
    return fact.groupBy("report_date", "condition_code", "condition_name", "condition_group").agg(
        F.sum("case_count").alias("case_count"), F.sum("distinct_patients").alias("distinct_patients"),
        F.count("facility_id").alias("reporting_facilities"), F.count_if(F.col("case_count") > 0).alias("facilities_with_cases"),
        F.sum("cases_trailing_7d").alias("cases_trailing_7d"), F.max("baseline_z").alias("max_facility_z"),
    )
